"""Matching entities across sources without keys: heuristic votes and a generative label model.

Candidates come from equi-joins: a rare word of the name (up to one slip) together with the country, the
size of the amount or the year; for a place with many names, and for rows without such a word, two of these.
Matching functions vote on each candidate with a level (agree, close, differ, ...) or abstain.  A generative model - a mixture of match and non-match whose factors are the
functions' levels, with the most dependent functions modelled jointly - learns from the unlabelled vote
patterns how often each function says what; its posterior is the confidence.  A one-to-one assignment by
mutual best follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect, materialize
from fundlens.llm.canon import clean, deletions, edits, words

#: A word in more than this share of the names describes kinds of projects, not single ones.
GENERIC_SHARE = 0.002
GENERIC_LEAST = 20
#: Words of form and order that say nothing of a project's purpose.
FORM_WORDS = frozenset(
    "project projet programme program proj prog operation facility facilite mecanisme sector sectoriel loan pret investment "
    "investissement inv phase ph i ii iii iv 1 2 3 4 in for of the and de du des la le les l d en a".split()
)
STAGES = {"1": 1, "2": 2, "3": 3, "4": 4, "i": 1, "ii": 2, "iii": 3, "iv": 4}
#: The matching functions: level by level whether it speaks for (1), against (-1) or neither (0).
FUNCTIONS: dict[str, list[int]] = {
    "place": [1, 0, -1],  # the rare word: as typed, one slip, more
    "purpose": [-1, 0, 1],  # other words of the name, translated: few, some, all
    "country": [-1, 1],
    "year": [1, 0, -1],  # same, next, further
    "amount": [1, 1, 0, -1],  # within 2 %, 6 %, 15 %, further
    "stage": [-1, 1],
}
ABSTAIN = -1
MAX_TRANSLATIONS = 200_000


def stage_of(tokens: list[str]) -> int:
    """The stage a name states, 0 for none: the number after "phase", or a closing number."""
    for k, t in enumerate(tokens[:-1]):
        if t in ("phase", "ph") and tokens[k + 1] in STAGES:
            return STAGES[tokens[k + 1]]
    return STAGES.get(tokens[-1], 0) if tokens else 0


def named(df: DataFrame, name: str) -> DataFrame:
    """Add ``tokens`` and ``stage`` of a name; in place, no shuffle."""

    @F.pandas_udf("struct<tokens array<string>, stage int>")
    def read(batch: pd.Series) -> pd.DataFrame:
        tokens = [words(clean(n)) if n else [] for n in batch]
        return pd.DataFrame({"tokens": tokens, "stage": [stage_of(t) for t in tokens]})

    return df.withColumn("__n", read(F.col(name))).select("*", F.col("__n.tokens").alias("tokens"), F.col("__n.stage").alias("stage")).drop("__n")


def frequent_words(left: DataFrame, right: DataFrame, listed: list[str]) -> tuple[list[str], list[str]]:
    """(generic, hot): words of kind with the words of country names, and places with many names.

    Frequency counts a name once per country, however often it is copied.  A frequent word that lies mostly in
    one country, far above that country's share of the names, is a place; words of kind spread over countries.
    """
    spread, local = set(listed), set()
    for side in (left, right):
        names = materialize(side.select(F.array_distinct("tokens").alias("t"), "country").distinct())
        n, known = names.count(), names.where("country IS NOT NULL").groupBy("country").count()
        base = known.agg(F.max("count") / F.sum("count")).first()[0] or 0.0
        per = names.select(F.explode("t").alias("t"), "country").groupBy("t", "country").count()
        there = F.when(F.col("country").isNotNull(), F.col("count"))
        rows = per.groupBy("t").agg(F.sum("count").alias("n"), (F.max(there) / F.sum(there)).alias("share")).where(F.col("n") > max(GENERIC_LEAST, GENERIC_SHARE * n))
        # at most (words per name) / GENERIC_SHARE of them, whatever the size of the data
        for r in bounded_collect(rows, 100_000, "frequent words"):
            (local if (r["share"] or 0.0) > (1 + base) / 2 else spread).add(r["t"])
    return sorted(spread), sorted(local - spread)


def near_words(left: DataFrame, right: DataFrame) -> DataFrame:
    """(lw, rw, d): distinct words of both sides at most one slip apart, or two with a common neighbour."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(t, d) for t in b["w"] for d in (deletions(t, 1) if len(t) <= 40 else {t})], columns=["w", "part"])

    lw = left.mapInPandas(parts, "w string, part string").withColumnRenamed("w", "lw")
    rw = right.mapInPandas(parts, "w string, part string").withColumnRenamed("w", "rw")

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([0 if x == y else edits(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")

    return lw.join(rw, "part").select("lw", "rw").distinct().withColumn("d", distance("lw", "rw")).where("d <= 2")


def candidates(left: DataFrame, right: DataFrame, generic: list[str], hot: list[str] = ()) -> DataFrame:
    """(lid, rid, d): pairs that share a rare word up to slips and one of country, amount or year.

    ``left``/``right``: id, tokens, country, year, usd.  A pair needs the same country, or amounts in
    neighbouring buckets of 10 %, or - where either amount is missing - years at most one apart.  With a hot
    word two of country, amount and year must agree, or the only one that both sides have.  A row without a
    rare or hot word over 3 letters is compared so by any of its words; ``d`` is null if that is one of kind.
    """
    distinct = F.array_distinct("tokens")
    rare = F.filter(distinct, lambda t: (F.length(t) > 3) & ~t.isin(generic))

    def by(df: DataFrame, which: Column) -> DataFrame:
        return df.select("id", "country", "year", "usd", F.explode(which).alias("w"))

    ll, rr = by(left, rare), by(right, rare)
    near = near_words(ll.select("w").distinct(), rr.select("w").distinct())
    if hot:
        near = materialize(near.withColumn("hot", F.col("lw").isin(*hot) | F.col("rw").isin(*hot)))
    bucket = F.floor(F.log("usd") / 0.1).cast("int")
    year, country = F.col("year"), F.col("country")

    def key(prefix: str, *values: Column) -> list[Column]:
        return [F.concat(F.lit(prefix), v.cast("string")) for v in values]

    lkeys = F.array_compact(F.array(*key("c", country), *key("a", bucket), *key("y", year), *key("z", F.when(F.col("usd").isNull(), year))))
    rkeys = F.array_compact(
        F.array(
            *key("c", country),
            *key("a", bucket - 1, bucket, bucket + 1),
            *[F.when(F.col("usd").isNull(), k) for k in key("y", year - 1, year, year + 1)],
            *key("z", year - 1, year, year + 1),
        )
    )
    # keys of two attributes, and of one with what the left side knows of the others: the right side takes all it shares none with
    own = {"c": [country], "a": [bucket], "y": [year]}
    wide = {"c": [country], "a": [bucket - 1, bucket, bucket + 1], "y": [year - 1, year, year + 1]}

    def strict(values: dict[str, list[Column]], is_left: bool) -> Column:
        keys = [F.concat(F.lit(f"{f}{g}|"), v.cast("string"), F.lit("|"), u.cast("string")) for f, g in ("ca", "cy", "ay") for v in values[f] for u in values[g]]
        for f, g, h in ("cay", "acy", "yca"):
            has_g, has_h = own[g][0].isNotNull(), own[h][0].isNotNull()
            for x in (False, True):
                for y in (False, True):
                    fits = ((has_g == F.lit(x)) & (has_h == F.lit(y))) if is_left else ~((has_g & F.lit(x)) | (has_h & F.lit(y)))
                    keys += [F.when(fits, k) for k in key(f"{f}{int(x)}{int(y)}|", *values[f])]
        return F.array_compact(F.array(*keys))

    def met(lw: DataFrame, lk: Column, rw: DataFrame, rk: Column, words: DataFrame) -> DataFrame:
        a = lw.select(F.col("id").alias("lid"), F.col("w").alias("lw"), F.explode(lk).alias("key"))
        b = rw.select(F.col("id").alias("rid"), F.col("w").alias("rw"), F.explode(rk).alias("key")).join(words, "rw")
        return a.join(b, ["lw", "key"]).select("lid", "rid", "d")

    found = met(ll, lkeys, rr, rkeys, near.where("NOT hot").drop("hot") if hot else near)
    if hot:
        near = near.where("hot").drop("hot")
        found = found.unionByName(met(ll.join(near.select(F.col("lw").alias("w")).distinct(), "w", "left_semi"), strict(own, True), rr, strict(wide, False), near))
    # rows that no word above leads to
    said = F.filter(distinct, lambda t: ~t.isin(sorted(FORM_WORDS)))
    said = F.when(F.size(said) > 0, said).otherwise(distinct)
    bare = (F.size(rare) == 0) & (F.size(distinct) > 0)
    meant = F.when(~F.col("w").isin(sorted({*generic, *FORM_WORDS})), 0)
    for a, b in ((left.where(bare), right), (left, right.where(bare))):
        if not (a if b is right else b).select("id").isEmpty():
            a = by(a, said).select(F.col("id").alias("lid"), "w", F.explode(strict(own, True)).alias("key"))
            b = by(b, said).select(F.col("id").alias("rid"), "w", F.explode(strict(wide, False)).alias("key"))
            found = found.unionByName(a.join(b, ["w", "key"]).select("lid", "rid", meant.alias("d")))
    return found.groupBy("lid", "rid").agg(F.min("d").alias("d"))


def translations(pairs: DataFrame, generic: list[str]) -> dict[str, set[str]]:
    """What the generic words of one side stand for on the other, learnt from sure candidates."""
    sure = pairs.where("place = 0 AND country = 1 AND amount = 0 AND stage = 1 AND year IN (0, 1)")
    sure = sure.select(*[F.filter(F.array_distinct(f"{x}tokens"), lambda t: t.isin(generic)).alias(f"{x}t") for x in "lr"], (F.col("lcopies").cast("long") * F.col("rcopies")).alias("w"))
    both = sure.select(F.explode("rt").alias("r"), "lt", "w").select("r", F.explode("lt").alias("l"), "w").groupBy("r", "l").agg(F.sum("w").alias("n"))
    alone = sure.select(F.explode("rt").alias("r"), "w").groupBy("r").agg(F.sum("w").alias("nr"))
    left = sure.select(F.explode("lt").alias("l"), "w").groupBy("l").agg(F.sum("w").alias("nl"))
    dice = both.join(alone, "r").join(left, "l").where((F.col("n") >= 3) & (F.col("n") / F.col("nr") >= 0.5) & (2 * F.col("n") / (F.col("nr") + F.col("nl")) >= 0.15))
    out: dict[str, set[str]] = {}
    for r in bounded_collect(dice.select("r", "l"), MAX_TRANSLATIONS, "translations"):
        out.setdefault(r["r"], set()).add(r["l"])
    return out


@lru_cache(maxsize=1 << 20)
def _alike(w: str, h: str) -> bool:
    """Whether a word is the same as, begins with or is a slip of a word of kind; there are few of those."""
    return w == h or (len(h) >= 3 and w.startswith(h)) or (len(w) > 4 and abs(len(w) - len(h)) < 3 and edits(w, h) <= 2)


def purpose_levels(generic: list[str], meaning: dict[str, set[str]], skip: list[str]):
    """Level of the words of purpose: how many of the record's are found in the line, as such or translated."""
    kind = frozenset(generic) - FORM_WORDS - frozenset(skip)

    @F.pandas_udf("int")
    def level(lt: pd.Series, rt: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(lt, rt, strict=True):
            want = [t for t in a if t in kind]
            have = [t for t in b if t not in FORM_WORDS]
            if not want or not have:
                out.append(ABSTAIN)
                continue
            said = {x for t in have for x in meaning.get(t, ())}
            hits = 0
            for w in want:
                hits += w in said or any(_alike(w, h) for h in have)
            share = hits / len(want)
            out.append(2 if share > 0.99 else 1 if share >= 0.5 else 0)
        return pd.Series(out, dtype="int32")

    return level


class LabelModel:
    """Two-class mixture over vote patterns; factors are functions or, where dependent, pairs of them."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, votes: list[list[int]], joint: int = 2, dependence: float = 0.02):
        self.x, self.n, self.votes = patterns, counts.astype(float), votes
        self.groups: list[tuple[int, ...]] = [(k,) for k in range(len(votes))]
        lean = np.zeros(len(self.x))
        for k, v in enumerate(votes):
            lean += np.where(self.x[:, k] >= 0, np.asarray(v)[np.clip(self.x[:, k], 0, None)], 0)
        start = 1 / (1 + np.exp(-2.0 * (lean - len(votes) + 2.5)))
        # a pair may be so dependent that a first fit would take it for the class: looked for under the votes' lean, then after each fit
        self.p = start
        for _ in range(joint + 1):
            pair = self._most_dependent(dependence if self.p is not start else 4 * dependence)
            if pair is not None:
                self.groups = [g for g in self.groups if g not in pair] + [pair[0] + pair[1]]
            elif self.p is not start:
                break
            self.p = self._fit(start)

    def _codes(self, group: tuple[int, ...]) -> np.ndarray:
        """Level of a factor per pattern; -1 where every function in it abstains."""
        code = np.zeros(len(self.x), dtype=int)
        for k in group:
            code = code * (len(self.votes[k]) + 1) + self.x[:, k] + 1
        return np.where((self.x[:, list(group)] < 0).all(axis=1), -1, code)

    def _fit(self, p: np.ndarray, rounds: int = 200) -> np.ndarray:
        for _ in range(rounds):
            share = np.clip((self.n * p).sum() / max(self.n.sum(), 1e-9), 1e-6, 1 - 1e-6)
            log_odds = np.full(len(self.x), np.log(share / (1 - share)))
            for g in self.groups:
                code = self._codes(g)
                seen = code >= 0
                levels = np.unique(code[seen])
                table = np.zeros((2, (levels.max() if len(levels) else 0) + 1))
                for y, w in enumerate((self.n * (1 - p), self.n * p)):
                    np.add.at(table[y], code[seen], w[seen])
                    table[y][levels] += 0.5
                    table[y] /= max(table[y].sum(), 1e-9)
                log_odds[seen] += np.log(table[1][code[seen]] / table[0][code[seen]])
            new = 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))
            done = np.abs(new - p).max(initial=0) < 1e-6
            p = new
            if done:
                break
        return p

    def _most_dependent(self, least: float) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """The two factors with the largest mutual information given the class."""
        best = (least, None)
        singles = [g for g in self.groups if len(g) == 1]
        for i, a in enumerate(singles):
            for b in singles[i + 1 :]:
                ca, cb = self._codes(a), self._codes(b)
                ok = (ca >= 0) & (cb >= 0)
                info = 0.0
                for w in (self.n * (1 - self.p), self.n * self.p):
                    t = np.zeros((ca.max(initial=0) + 1, cb.max(initial=0) + 1))
                    np.add.at(t, (ca[ok], cb[ok]), w[ok])
                    total = t.sum()
                    if total < 1:
                        continue
                    q = t / total
                    e = q.sum(1, keepdims=True) * q.sum(0, keepdims=True)
                    nz = q > 0
                    info += (q[nz] * np.log(q[nz] / e[nz])).sum() * total / self.n.sum()
                if info > best[0]:
                    best = (info, (a, b))
        return best[1]


def assign(scored: DataFrame) -> DataFrame:
    """One-to-one pairs by mutual best: (lid, rid, confidence, n, lfrom, rfrom).

    In each round a pair is taken if it is the best of both its sides, ties by the smaller ids; pairs with a
    side used up drop out, until none is left.  ``ln`` and ``rn``, if there, are the copies that a side stands
    for: a pair takes as many as both have left, ``n`` of them from the copies ``lfrom`` and ``rfrom`` on.
    """
    best = F.struct("confidence", "closeness", (-F.col("lid")).alias("a"), (-F.col("rid")).alias("b"))
    copies = [F.col(c) if c in scored.columns else F.lit(1).alias(c) for c in ("ln", "rn")]
    rest, taken = scored.select("lid", "rid", best.alias("__s"), *copies, F.lit(0).alias("lfrom"), F.lit(0).alias("rfrom")), None
    while True:
        top_l = rest.groupBy("lid").agg(F.max("__s").alias("__s"))
        top_r = rest.groupBy("rid").agg(F.max("__s").alias("__s"))
        won = rest.join(top_l, ["lid", "__s"], "left_semi").join(top_r, ["rid", "__s"], "left_semi")
        won = materialize(won.select("lid", "rid", F.col("__s.confidence").alias("confidence"), F.least("ln", "rn").alias("n"), "lfrom", "rfrom"))
        taken = won if taken is None else taken.unionByName(won)
        if won.isEmpty():
            return taken
        rest = rest.join(won.select("lid", F.col("n").alias("__l")), "lid", "left").join(won.select("rid", F.col("n").alias("__r")), "rid", "left").fillna(0, ["__l", "__r"])
        left = {"ln": F.col("ln") - F.col("__l"), "rn": F.col("rn") - F.col("__r"), "lfrom": F.col("lfrom") + F.col("__l"), "rfrom": F.col("rfrom") + F.col("__r")}
        rest = materialize(rest.withColumns(left).drop("__l", "__r").where("ln > 0 AND rn > 0"))


def numbered(rows: DataFrame, of: DataFrame, cols: list[str]) -> DataFrame:
    """(one, copy, id): every row with the smallest id of its equals and its place among them, from 0.

    ``of`` has the equals once, with ``id`` and the number of them.  Places are counted inside blocks of ids, so that rows
    with very many equals are not ranked in one task.
    """
    same = [F.col(f"__r.{c}").eqNullSafe(F.col(f"__o.{c}")) for c in cols]
    ids = rows.alias("__r").join(of.alias("__o"), same).select(F.col("__o.id").alias("one"), F.col("__r.id").alias("id"))
    ids = ids.withColumn("__block", F.floor(F.col("id") / 10_000))
    sizes = ids.groupBy("one", "__block").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("one").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("one", "__block").orderBy("id")) - 1
    ids = ids.withColumn("__p", place).join(sizes.withColumn("__before", before), ["one", "__block"])
    return ids.select("one", (F.col("__p") + F.col("__before")).cast("int").alias("copy"), "id")


def link(left: DataFrame, right: DataFrame, country_words: list[str], least: float = 0.8) -> DataFrame:
    """(lid, rid, confidence) of the pairs that are the same thing, each side at most once.

    ``left`` and ``right`` have ``id, name, country, year, usd``; any but the id may be null: a null name
    has no candidates, a null attribute makes its function abstain.  Rows equal in all of this are compared
    once and paired in the order of their ids.  Empty tables give no pair.
    """
    alike = ["tokens", "stage", "country", "year", "usd"]
    cols = ["id", *alike, "copies"]
    # equal rows by a hash of 128 bits, nulls told apart by their places
    said = [*[F.col(c).isNotNull() for c in alike], *alike]
    same = F.struct(F.xxhash64(*said), F.xxhash64(F.lit("other"), *said)).alias("same")
    lrows, rrows = (materialize(named(side, "name").select("id", *alike).withColumn("same", same)) for side in (left, right))
    ll, rr = (
        materialize(rows.groupBy("same").agg(F.min("id").alias("id"), F.count(F.lit(1)).cast("int").alias("copies"), *[F.first(c).alias(c) for c in alike]).select(*cols, "same"))
        for rows in (lrows, rrows)
    )
    lones, rones = ll, rr
    generic, hot = frequent_words(ll, rr, country_words)
    pairs = candidates(ll, rr, generic, hot)
    # only the words of purpose travel with the pairs
    kind, idle = sorted(set(generic) - FORM_WORDS - set(country_words)), sorted(FORM_WORDS | set(country_words))
    ll = ll.withColumn("tokens", F.filter(F.array_distinct("tokens"), lambda t: t.isin(kind)))
    rr = rr.withColumn("tokens", F.filter(F.array_distinct("tokens"), lambda t: ~t.isin(idle)))
    pairs = pairs.join(ll.select(*[F.col(c).alias(f"l{c}") for c in cols]), "lid").join(rr.select(*[F.col(c).alias(f"r{c}") for c in cols]), "rid")
    gap = F.abs(F.log(F.col("rusd") / F.col("lusd")))
    years = F.abs(F.col("lyear") - F.col("ryear"))
    other = F.lit(ABSTAIN)
    pairs = pairs.withColumns(
        {
            "place": F.coalesce(F.least("d", F.when(F.col("d").isNotNull(), 2)), other),
            "country": F.when(F.col("lcountry").isNull() | F.col("rcountry").isNull(), other).otherwise((F.col("lcountry") == F.col("rcountry")).cast("int")),
            "year": F.when(years.isNull(), other).otherwise(F.least(years, F.lit(2))),
            "amount": F.when(gap.isNull(), other).when(gap <= 0.02, 0).when(gap <= 0.06, 1).when(gap <= 0.15, 2).otherwise(3),
            "stage": (F.col("lstage") == F.col("rstage")).cast("int"),
            "closeness": -F.coalesce(gap, F.lit(0.05)) - 0.1 * F.coalesce("d", F.lit(2)),
        }
    )
    pairs = materialize(pairs.select("lid", "rid", "ltokens", "rtokens", "lcopies", "rcopies", "closeness", *[f for f in FUNCTIONS if f != "purpose"]))
    meaning = translations(pairs, generic)
    pairs = pairs.withColumn("purpose", purpose_levels(generic, meaning, country_words)("ltokens", "rtokens")).drop("ltokens", "rtokens")
    pairs = materialize(pairs)
    names = list(FUNCTIONS)
    # at most the product of the numbers of levels: a few thousand patterns, whatever the data
    seen = bounded_collect(pairs.groupBy(*names).agg(F.sum(F.col("lcopies").cast("long") * F.col("rcopies")).alias("count")), 10_000, "vote patterns")
    if not seen:
        return pairs.select("lid", "rid", F.lit(0.0).alias("confidence"))
    x = np.array([[r[f] for f in names] for r in seen])
    model = LabelModel(x, np.array([r["count"] for r in seen]), list(FUNCTIONS.values()))
    table = [(*map(int, row), float(p)) for row, p in zip(x, model.p, strict=True) if p >= least]
    posterior = pairs.sparkSession.createDataFrame(table, ", ".join(f"{f} int" for f in names) + ", confidence double")
    scored = pairs.join(posterior, names).select("lid", "rid", "confidence", "closeness", F.col("lcopies").alias("ln"), F.col("rcopies").alias("rn"))
    won = assign(materialize(scored))
    won = won.select("lid", "rid", "confidence", "lfrom", "rfrom", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("__k"))
    won = won.withColumns({"__l": F.col("lfrom") + F.col("__k"), "__r": F.col("rfrom") + F.col("__k")})
    for side, rows, ones in (("l", lrows, lones), ("r", rrows, rones)):
        taken = ones.select("id", "same").join(won.select(F.col(f"{side}id").alias("id")).distinct(), "id", "left_semi")
        ids = numbered(rows.select("id", "same"), taken, ["same"]).select(F.col("one").alias(f"{side}id"), F.col("copy").alias(f"__{side}"), F.col("id").alias(f"{side}row"))
        won = won.join(ids, [f"{side}id", f"__{side}"])
    return won.select(F.col("lrow").alias("lid"), F.col("rrow").alias("rid"), "confidence")
