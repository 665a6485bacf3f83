"""Mapping free-typed values to a canonical list by token repair and soft TF-IDF.

Every distinct typed value is cut into tokens; every distinct token is joined to the vocabulary of the
reference list by edit distance (through common deletion neighbours, an equi-join); the repaired tokens are
combined by soft TF-IDF to rank whole entries.  Values without an acceptable entry are reported.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from math import log, sqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import materialize

UNMATCHED = "UNMATCHED"
#: Up to so many entries the reference list is sent to every task; a larger list is joined, with the same result.
MAX_ENTRIES = 50_000
#: Short forms of words in names of states.
SHORT_FORMS = {
    "rep": ["republic"], "r": ["republic"], "dem": ["democratic"], "d": ["democratic"], "dr": ["democratic", "republic"],
    "fr": ["federal", "republic"], "f": ["federal"], "fed": ["federal"], "st": ["saint"], "n": ["north"], "s": ["south"],
    "e": ["east"], "w": ["west"], "is": ["islands"], "isl": ["islands"], "cwlth": ["commonwealth"], "k": ["kingdom"],
}
#: Words that carry no name by themselves, whatever list they occur in.
FILLERS = {"of", "the", "and", "de", "du", "des", "la", "le", "d", "et"}


def clean(text: str) -> str:
    """Unescaped, repaired and folded: lower case without accents, invisible marks and double spaces."""
    t = html.unescape(text)
    if re.search("[ÃÂ]", t):
        try:
            t = t.encode("latin-1").decode("utf-8")
        except UnicodeError:
            try:
                t = t.encode("cp1252").decode("utf-8")
            except UnicodeError:
                pass
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return re.sub(r"\s+", " ", t).strip().casefold()


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.replace("'", " ").replace("’", " "))


def readings(text: str) -> list[list[str]]:
    """Token lists a typed value may stand for: whole, and without a qualifier in brackets or after a dash."""
    t = clean(text)
    out = [words(t)]
    cut = re.sub(r"\([^)]*\)?", " ", t)
    cut = re.split(r"\s[-–—]\s", cut)
    for part in [cut[0], *([] if len(cut) < 2 else [cut[-1]])]:
        w = words(part)
        if w and w not in out:
            out.append(w)
    return out


def deletions(token: str, most: int) -> set[str]:
    """The token and what is left of it after up to ``most`` deletions."""
    level = out = {token}
    for _ in range(most):
        level = {x[:i] + x[i + 1 :] for x in level for i in range(len(x))}
        out = out | level
    return out


def allowed(length: int) -> int:
    """Edits that may lie between two words of which the longer has this length."""
    return 0 if length < 3 else 1 if length < 5 else 2


def edits(a: str, b: str) -> int:
    """Damerau-Levenshtein distance: insertions, deletions, substitutions and swaps, also of letters that
    became neighbours only by another edit."""
    last: dict[str, int] = {}
    far = len(a) + len(b)
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, ca in enumerate(a, 1):
        seen = 0
        for j, cb in enumerate(b, 1):
            k, m = last.get(cb, 0), seen
            if ca == cb:
                seen = j
            d[i + 1][j + 1] = min(
                d[i][j] + (ca != cb), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1)
            )
        last[ca] = i
    return d[-1][-1]


def scrap(token: str, word: str) -> float:
    """How well a scrap abbreviates a word: it begins it, or is its skeleton; else 0."""
    letters = iter(word)
    if len(word) > len(token) and word[0] == token[0] and all(c in letters for c in token):
        return 0.95 if word.startswith(token) else 0.85
    return 0.0


def entry_names(name: str | None, others: list[str] | None) -> list[list[str]]:
    """The token lists of an entry's names."""
    lists = [words(clean(n)) for n in [name or "", *[o for o in (others if others is not None else []) if o]]]
    return [tokens for tokens in lists if tokens]


class Reference:
    """The list with its names, codes, vocabulary and weights; or the part of it that a text may mean."""

    def __init__(self, entries: list[tuple[str, str, list[str], list[str]]]):
        """entries: (code returned, name, other names, codes that may be typed)."""
        names = [(code, tokens) for code, name, others, _ in entries for tokens in entry_names(name, others)]
        codes: dict[str, str] = {}
        for code, _, _, typed in entries:
            for c in typed:
                codes.setdefault(c.casefold(), code)
        holding = defaultdict(set)
        for code, tokens in names:
            for t in tokens:
                holding[t].add(code)
        self._fill(names, {t: len(c) for t, c in holding.items()}, len({c for c, _ in names}), codes)
        #: Telling words of names with another telling word: only these are told by a scrap.
        self.joined = sorted({t for _, n in self.names for t in n if sum(x in self.telling for x in set(n)) > 1 and t not in FILLERS})

    @classmethod
    def part(cls, names: list[tuple[str, list[str]]], holders: dict[str, int], total: int, codes: dict[str, str], scraps: dict[str, list[tuple[str, float]]]) -> Reference:
        """Some names of a list of ``total`` entries; ``holders``: how many of all its entries have a word."""
        self = cls.__new__(cls)
        self._fill(names, holders, total, codes)
        self.joined, self._short = [], scraps
        return self

    def _fill(self, names: list[tuple[str, list[str]]], holders: dict[str, int], total: int, codes: dict[str, str]) -> None:
        self.names, self.codes = names, codes
        total = max(1, total)
        self.idf = {t: 0.05 if t in FILLERS else log(1 + total / n) / log(1 + total) for t, n in holders.items()}
        #: Words of several entries ("republic") don't tell entries apart on their own.
        self.telling = {t for t, n in holders.items() if n <= 2 and t not in FILLERS}
        self._short: dict[str, list[tuple[str, float]]] = {}
        #: Names by the words that lead to them, and the words that must be typed for a name to be meant: the telling ones.
        #: A name without any is told by all its words together.
        self.by_key: dict[str, list[int]] = defaultdict(list)
        self.needed: list[set[str]] = []
        for k, (_, tokens) in enumerate(names):
            keys = {t for t in tokens if t in self.telling}
            if keys:
                self.needed.append({t for t in keys if self.weight(t) > 0.3})
            else:
                self.needed.append({t for t in tokens if t not in FILLERS} or set(tokens))
                keys = {min(self.needed[k], key=lambda t: (holders[t], t))}
            for t in keys:
                self.by_key[t].append(k)

    def weight(self, token: str) -> float:
        """Unknown words weigh as much as the most telling ones; scraps of one or two letters as little as fillers."""
        return self.idf.get(token, 0.05 if token in FILLERS or len(token) < 3 else 1.0)

    def short_for(self, token: str) -> list[tuple[str, float]]:
        """Words that a scrap of two to four letters may abbreviate: it begins them or is their skeleton."""
        if token not in self._short:
            hits = []
            if 2 <= len(token) <= 4 and token not in self.idf:
                hits = [(v, how) for v in self.joined if (how := scrap(token, v))]
            self._short[token] = hits
        return self._short[token]

    def rank(self, tokens: list[str], repairs: dict[str, list[tuple[str, float]]]) -> tuple[float, str | None, float]:
        """(score, code, score of the best other entry) of the entry that the tokens mean; soft TF-IDF cosine."""
        spelled: list[tuple[str, list[tuple[str, float]]]] = []
        for t in tokens:
            if t not in self.idf and t in SHORT_FORMS:
                spelled += [(full, [(full, 0.97)]) for full in SHORT_FORMS[t] if full in self.idf or len(SHORT_FORMS[t]) > 1]
            else:
                spelled.append((t, [*repairs.get(t, []), *self.short_for(t)]))
        spelled = [(t, r) for t, r in spelled if not (t in FILLERS and not r)]
        if not spelled:
            return 0.0, None, 0.0
        best: dict[str, float] = {}
        for k in {k for _, r in spelled for v, _ in r for k in self.by_key.get(v, ())}:
            code, name = self.names[k]
            left, dot, mine, exact_telling = list(name), 0.0, 0.0, 0.0
            for t, r in spelled:
                hit = max(((s, v) for v, s in r if v in left), default=None)
                w = self.weight(hit[1]) if hit else self.weight(t)
                mine += w * w
                if hit:
                    left.remove(hit[1])
                    dot += hit[0] * w * w
                    exact_telling += hit[0]
            theirs = sum(self.weight(t) ** 2 for t in name)
            if any(t in self.needed[k] for t in left) or not exact_telling:
                continue  # a word that tells the name was not typed
            score = dot / sqrt(mine * theirs)
            best[code] = max(best.get(code, 0.0), score)
        if not best:
            return 0.0, None, 0.0
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))
        return ranked[0][1], ranked[0][0], ranked[1][1] if len(ranked) > 1 else 0.0


def _token_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        tokens = [sorted({t for r in readings(v) for t in r}) for v in b["typed"]]
        yield pd.DataFrame({"typed": b["typed"], "tokens": tokens})


def _neighbours(longest: int):
    """Deletion neighbours of the tokens that may be within two slips of a word of ``longest`` letters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, d) for t in b["token"] if len(t) <= longest + 2 for d in deletions(t, 0 if len(t) < 2 else 1 if len(t) < 4 else 2)]
            yield pd.DataFrame(rows, columns=["token", "part"])

    return run


def token_repairs(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, word, similarity): each distinct token with the vocabulary words it may be a slip of.

    Both sides are expanded to their deletion neighbours and joined on equality, so no pair is compared
    that shares no neighbour; the distance is then verified.  Tokens more than two letters longer than every
    word are no slip of one and have no neighbours made.
    """
    longest = vocabulary.agg(F.max(F.length("word"))).first()[0] or 0
    parts = tokens.select("token").mapInPandas(_neighbours(longest), "token string, part string")
    known = vocabulary.select(F.col("word").alias("token")).mapInPandas(_neighbours(longest), "token string, part string").withColumnRenamed("token", "word")
    near = parts.join(known, "part").select("token", "word").distinct()

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([edits(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")

    longest = F.greatest(F.length("token"), F.length("word"))
    most = F.when(longest < 3, 0).when(longest < 5, 1).otherwise(2)
    slips = near.withColumn("d", distance("token", "word")).where(F.col("d") <= most)
    exact = tokens.join(vocabulary.select(F.col("word").alias("token")).distinct(), "token", "left_semi").select("token", F.col("token").alias("word"), F.lit(1.0).alias("similarity"))
    return exact.unionByName(slips.where("d > 0").select("token", "word", (1 - 0.6 * F.col("d") / longest).alias("similarity")))


def _typed(rows: DataFrame, value: str) -> DataFrame:
    return rows.where(F.trim(F.regexp_replace(F.col(value), r"(?U)[\s​﻿]+", " ")) != "").groupBy(F.col(value).alias("typed")).count().select("typed")


def map_values(
    rows: DataFrame,
    reference: DataFrame,
    *,
    value: str = "country",
    code: str = "iso3",
    name: str = "country_name",
    others: str = "alt_names",
    typed_codes: tuple[str, ...] = ("iso2", "iso3"),
    accept: float = 0.72,
) -> DataFrame:
    """(typed, canon_code, score): every distinct typed value with its entry, or ``UNMATCHED``.

    Null and blank values are no values and get no row.  A value equal to a name maps to it with score 1.
    A value that is a code of the list maps to that entry.  Ties between entries go to the smaller code.
    Work is over distinct values and distinct tokens.  A list of up to ``MAX_ENTRIES`` goes to every task, a larger one is joined.
    """
    cols = [code, name, others, *typed_codes]
    listed = reference.select(*dict.fromkeys(cols)).limit(MAX_ENTRIES + 1).collect()
    if len(listed) > MAX_ENTRIES:
        return _map_joined(rows, reference, value, code, name, others, typed_codes, accept)
    ref = Reference([(r[code], r[name] or "", [o for o in r[others] or [] if o], [r[c] for c in typed_codes if r[c]]) for r in listed if r[code]])
    spark = rows.sparkSession
    typed = _typed(rows, value)
    cut = typed.mapInPandas(_token_batches, "typed string, tokens array<string>")
    tokens = cut.select(F.explode("tokens").alias("token")).distinct()
    vocabulary = spark.createDataFrame([(w,) for w in sorted(ref.idf)] or [("",)], "word string")
    repairs = token_repairs(tokens, vocabulary).groupBy("token").agg(F.collect_list(F.struct("word", "similarity")).alias("words"))
    held = (
        cut.select("typed", F.explode_outer("tokens").alias("token"))
        .join(repairs, "token", "left")
        .groupBy("typed")
        .agg(F.collect_list(F.struct("token", "words")).alias("repairs"))
    )

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, found in zip(b["typed"], b["repairs"], strict=True):
                fixes = {f["token"]: [(w["word"], w["similarity"]) for w in f["words"]] for f in found if f["words"] is not None}
                out.append((text, *_decide(ref, text, fixes, accept)))
            yield pd.DataFrame(out, columns=["typed", "canon_code", "score"])

    return held.mapInPandas(decide, "typed string, canon_code string, score double")


def _map_joined(rows: DataFrame, reference: DataFrame, value: str, code: str, name: str, others: str, typed_codes: tuple[str, ...], accept: float) -> DataFrame:
    """:func:`map_values` for a list of any length: each text meets only the names that its words lead to."""
    spark = rows.sparkSession
    entries = reference.where(F.col(code) != "").select(F.col(code).alias("code"), F.col(name).alias("name"), F.col(others).alias("others"), F.array(*typed_codes).alias("typed_codes"))
    entries = materialize(entries.withColumn("at", F.monotonically_increasing_id()))

    def name_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(c, t) for c, n, o in zip(b["code"], b["name"], b["others"], strict=True) for t in entry_names(n, o)], columns=["code", "tokens"])

    def code_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(t.casefold(), c, at, i) for c, typed, at in zip(b["code"], b["typed_codes"], b["at"], strict=True) for i, t in enumerate(typed) if t], columns=["text", "code", "at", "i"])

    def text_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            plain = [clean(v).strip(" .") for v in b["typed"]]
            yield pd.DataFrame({"typed": b["typed"], "plain": plain, "tokens": [sorted({t for r in readings(v) for t in r}) for v in b["typed"]]})

    def second_letters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(w, w[0], c) for w in b["word"] for c in set(w[1:])], columns=["word", "one", "two"])

    @F.pandas_udf("double")
    def scraps_of(tokens: pd.Series, full: pd.Series) -> pd.Series:
        return pd.Series([scrap(t, w) for t, w in zip(tokens, full, strict=True)], dtype="float64")

    codes = entries.mapInPandas(code_batches, "text string, code string, at long, i int").groupBy("text").agg(F.min_by("code", F.struct("at", "i")).alias("of_code"))
    names = materialize(entries.select("code", "name", "others").mapInPandas(name_batches, "code string, tokens array<string>").distinct().withColumn("k", F.monotonically_increasing_id()))
    total = names.select("code").distinct().count()
    each = names.select("k", "code", F.posexplode("tokens").alias("pos", "word"))
    vocabulary = materialize(each.groupBy("word").agg(F.countDistinct("code").cast("int").alias("n")))
    filler = lambda f: f["word"].isin(sorted(FILLERS))
    facts = F.array_sort(F.collect_list(F.struct("pos", "word", "n"))).alias("facts")
    told = each.join(vocabulary, "word").groupBy("k", "code").agg(facts).withColumn("tell", F.array_distinct(F.transform(F.filter("facts", lambda f: (f["n"] <= 2) & ~filler(f)), lambda f: f["word"])))
    rest = F.filter("facts", lambda f: ~filler(f))
    rarest = F.array_min(F.transform(F.when(F.size(rest) > 0, rest).otherwise(F.col("facts")), lambda f: F.struct(f["n"], f["word"])))["word"]
    told = materialize(told.withColumn("keys", F.when(F.size("tell") > 0, F.col("tell")).otherwise(F.array(rarest))))
    joined = told.where(F.size("tell") > 1).select(F.explode("facts").alias("f")).where(~filler(F.col("f"))).select("f.word").distinct()

    texts = materialize(_typed(rows, value).mapInPandas(text_batches, "typed string, plain string, tokens array<string>"))
    tokens = materialize(texts.select(F.explode("tokens").alias("token")).distinct())
    repairs = materialize(token_repairs(tokens, vocabulary.select("word")))
    short = tokens.where(F.length("token").between(2, 4)).join(vocabulary.select(F.col("word").alias("token")), "token", "left_anti")
    short = short.withColumn("one", F.substring("token", 1, 1)).withColumn("two", F.substring("token", 2, 1)).join(joined.mapInPandas(second_letters, "word string, one string, two string"), ["one", "two"])
    scraps = materialize(short.withColumn("similarity", scraps_of("token", "word")).where("similarity > 0").select("token", "word", "similarity"))

    full = sorted({(t, w) for t, fulls in SHORT_FORMS.items() for w in fulls})
    leads = repairs.select("token", "word").unionByName(scraps.select("token", "word")).unionByName(spark.createDataFrame(full, "token string, word string")).distinct()
    by_key = told.select(F.explode("keys").alias("word"), "k", "code", "facts")
    typed_tokens = texts.select("typed", F.explode("tokens").alias("token"))
    meant = typed_tokens.join(leads, "token").join(by_key, "word").groupBy("typed", "k").agg(F.first("code").alias("code"), F.first("facts").alias("facts"))
    meant = meant.groupBy("typed").agg(F.collect_list(F.struct("code", "facts")).alias("meant"))
    listed = lambda df, as_name: df.groupBy("token").agg(F.collect_list(F.struct("word", "similarity")).alias(as_name))
    about = (
        tokens.join(vocabulary.withColumnRenamed("word", "token"), "token", "left").join(codes.withColumnRenamed("text", "token"), "token", "left")
        .join(listed(repairs, "repairs"), "token", "left").join(listed(scraps, "scraps"), "token", "left")
    )
    held = typed_tokens.join(about, "token").groupBy("typed").agg(F.collect_list(F.struct("token", "n", "of_code", "repairs", "scraps")).alias("about"))
    whole = texts.drop("tokens").join(codes.withColumnRenamed("text", "plain"), "plain", "left").join(held, "typed", "left").join(meant, "typed", "left")
    forms = {r["word"]: r["n"] for r in vocabulary.where(F.col("word").isin(sorted({w for _, w in full}))).collect()}

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows_of = lambda x: [] if x is None else x
        pairs = lambda x: [(w["word"], w["similarity"]) for w in rows_of(x)]
        for b in batches:
            out = []
            for text, plain, of_code, about, meant in zip(b["typed"], b["plain"], b["of_code"], b["about"], b["meant"], strict=True):
                about = rows_of(about)
                holders = forms | {a["token"]: a["n"] for a in about if a["n"] is not None and a["n"] == a["n"]}
                holders |= {f["word"]: f["n"] for m in rows_of(meant) for f in m["facts"]}
                known = {a["token"]: a["of_code"] for a in about if a["of_code"] is not None} | ({plain: of_code} if of_code is not None else {})
                ref = Reference.part([(m["code"], [f["word"] for f in m["facts"]]) for m in rows_of(meant)], holders, total, known, {a["token"]: pairs(a["scraps"]) for a in about})
                out.append((text, *_decide(ref, text, {a["token"]: pairs(a["repairs"]) for a in about}, accept)))
            yield pd.DataFrame(out, columns=["typed", "canon_code", "score"])

    return whole.select("typed", "plain", "of_code", "about", "meant").mapInPandas(decide, "typed string, canon_code string, score double")


def _decide(ref: Reference, text: str, fixes: dict[str, list[tuple[str, float]]], accept: float) -> tuple[str, float]:
    by_code = ref.codes.get(clean(text).strip(" ."))
    if by_code:
        return by_code, 1.0
    best = (0.0, None, 0.0)
    for tokens in readings(text):
        bare = [t for t in tokens if len(t) < 3 or t not in ref.codes or t in ref.idf] or tokens  # a code beside the name
        for reading in (tokens, bare):
            best = max(best, ref.rank(reading, fixes), key=lambda x: x[0])
    if best[1] is None or best[0] < accept:
        return UNMATCHED, round(best[0], 6)
    return best[1], round(best[0], 6)
