"""Languages of documents and paragraphs by hyperdimensional profiles.

Every letter is a random vector of +1 and -1; a letter n-gram is the product of its letters' vectors, each
rolled by its place; a text is the sum (bundle) of its n-grams.  Languages have prototypes - bundles of
texts with a readable label - and a text has the language whose prototype has the largest cosine.  The texts
of a batch are folded one by one and coded, counted and compared together.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect

DIMENSIONS = 4096
NGRAM = 3
SEED = 20_011
#: Labelled texts per language that the prototypes are bundled from: a bounded sample, chosen by hash.
SAMPLE_PER_LANGUAGE = 2_000
#: Texts that are coded together: what bounds a task's memory beside the longest text.
TOGETHER = 256
#: Codes of letters: folded Latin letters, the apostrophe and the blank.
ALPHABET = " abcdefghijklmnopqrstuvwxyz'"
#: Cyrillic letters in Latin ones, so that a language has one profile in either script.
LATIN = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяё", "a b v g d e zh z i y k l m n o p r s t u f kh ts ch sh shch  y  e yu ya yo".split(" "), strict=True))
# English names of languages, beside those of the list.
ENGLISH = {"en": "english", "fr": "french", "es": "spanish", "pt": "portuguese", "it": "italian", "de": "german", "id": "indonesian", "ru": "russian"}
#: Scanners read l as 1 and o as 0 inside words.
_SCANNED = re.compile(r"(?<=[^\W\d_])[10](?![\d/])|(?<![\d/])[10](?=[^\W\d_])")
#: What has no language - quotations, references, addresses, numbers - and a piece of text that every one of them holds.
_MARKS = [
    ("«", re.compile(r"«[^»\n]*»")), ("“", re.compile(r"“[^”\n]*”")), ("[", re.compile(r"\[[^\]\n]*\]")), ("(ref", re.compile(r"\(ref[^)\n]*\)")),
    ("://", re.compile(r"https?://\S+")), ("www.", re.compile(r"www\.\S+")), ("@", re.compile(r"[^\s@]++@\S+")),
]
_NUMBER = re.compile(r"[^\s\d]*+\d\S*")
_DIGIT = re.compile(r"\d")


class _Folded(dict):
    """Per letter the Latin letters it stands for, without accents; filled as letters are met."""

    def __missing__(self, point: int) -> str:
        t = unicodedata.normalize("NFKD", LATIN.get(chr(point), chr(point)))
        self[point] = t = "".join(c for c in t if not unicodedata.combining(c))
        return t


_FOLDED = _Folded()
_CODE = np.zeros(0x3000, dtype=np.int64)
for _k, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _k
#: Stands between the texts of a batch.
_BETWEEN = "\x02"
_CODE[ord(_BETWEEN)] = -1


class Names:
    """Whole words and phrases to leave out, found together in one scan."""

    def __init__(self, names: list[str]):
        self.scan = ahocorasick.Automaton()
        for n in {x.casefold() for x in names if x and x.strip()}:
            self.scan.add_word(n, len(n))
        self.any = len(self.scan) > 0
        if self.any:
            self.scan.make_automaton()

    def blank(self, t: str) -> str:
        """The text with a blank for every name; the longest of those that begin at a place counts."""
        if not self.any:
            return t
        spans: dict[int, int] = {}
        for last, n in self.scan.iter(t):
            a, b = last + 1 - n, last + 1
            if (a == 0 or not _word(t[a - 1])) and (b == len(t) or not _word(t[b])):
                spans[a] = max(spans.get(a, 0), b)
        if not spans:
            return t
        out, at = [], 0
        for a, b in sorted(spans.items()):
            if a >= at:
                out += [t[at:a], " "]
                at = b
        return "".join([*out, t[at:]])


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def fold(text: str, ignore: Names | None = None) -> str:
    """Unescaped, lower case, in Latin letters without accents, references and numbers: what a language is read from."""
    t = (html.unescape(text) if "&" in text else text).casefold()
    digits = _DIGIT.search(t) is not None
    if digits and ("1" in t or "0" in t):
        t = _SCANNED.sub(lambda m: "l" if m[0] == "1" else "o", t)
    for sign, pattern in _MARKS:
        if sign in t:
            t = pattern.sub(" ", t)
    if digits:
        t = _NUMBER.sub(" ", t)
    if ignore:
        t = ignore.blank(t)
    return t if t.isascii() else t.translate(_FOLDED)


def ngram_counts(texts: list[str], n: int = NGRAM, ignore: Names | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, count) of the letter n-grams inside and across words, in order of text and code.

    A text without letters has none.  ``text`` is the place in the list.
    """
    joined = " " + f" {_BETWEEN} ".join(fold(t, ignore).replace(_BETWEEN, " ") for t in texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = _CODE[np.where(points < len(_CODE), points, 32)]
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # single blanks
    size, length = len(ALPHABET), max(0, len(codes) - n + 1)
    text = np.cumsum(codes == -1)[:length]
    out, inside = np.zeros(length, dtype=np.int64), np.ones(length, dtype=bool)
    for k in range(n):
        part = codes[k : length + k]
        inside &= part >= 0
        out = out * size + part
    key, count = np.unique(text[inside] * size**n + out[inside], return_counts=True)
    return key // size**n, key % size**n, count


class Space:
    """The random letters and the n-gram vectors bound from them."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.n, self.dimensions = n, dimensions
        letters = rng.choice(np.array([-1, 1], dtype=np.int8), (len(ALPHABET), dimensions))
        self.rolled = [np.roll(letters, k, axis=1) for k in range(n)]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row of products per n-gram code."""
        out = np.ones((len(codes), self.dimensions), dtype=np.int8)
        rest = codes.copy()
        for k in reversed(range(self.n)):
            out *= self.rolled[k][rest % len(ALPHABET)]
            rest //= len(ALPHABET)
        return out.astype(np.float32)


class Profiles:
    """Language prototypes, and the dot product of every n-gram vector with every prototype.

    A bundle is a weighted sum of n-gram vectors, so its dot product with a prototype is the same sum of
    the n-grams' products; with these in a table, a text costs a look-up per n-gram.  Its length follows
    from the n-gram vectors being nearly orthogonal.  The weight of an n-gram is how unevenly the languages
    use it: one minus the normalised entropy over languages; names in every language's texts weigh little.
    """

    def __init__(self, langs: list[str], bundled: np.ndarray, present: np.ndarray, space: Space):
        """``bundled``: per language the sum of the texts' unit-length n-gram counts; ``present``: share of
        its texts that hold the n-gram."""
        self.langs = langs
        p = present + 1e-3
        p = p / p.sum(axis=0)
        entropy = -(p * np.log(p)).sum(axis=0) / max(np.log(len(langs)), 1e-9)
        self.weight = np.clip(1 - entropy, 0, 1).astype(np.float32) if len(langs) > 1 else np.ones(p.shape[1], dtype=np.float32)
        self.dimensions = space.dimensions
        protos = np.zeros((len(langs), space.dimensions), dtype=np.float32)
        used = np.flatnonzero(bundled.any(axis=0))
        for a in range(0, len(used), 2048):
            part = used[a : a + 2048]
            protos += (bundled[:, part] * self.weight[part]).astype(np.float32) @ space.vectors(part)
        protos /= np.linalg.norm(protos, axis=1, keepdims=True) + 1e-9
        self.product = np.zeros((bundled.shape[1], len(langs)), dtype=np.float32)
        for a in range(0, bundled.shape[1], 2048):
            part = np.arange(a, min(a + 2048, bundled.shape[1]))
            self.product[part] = self.weight[part, None] * (space.vectors(part) @ protos.T)

    def cosines(self, n_texts: int, text: np.ndarray, code: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Cosine of every text, given by its n-gram counts in order of text, with every prototype; 0 for a text without any.

        The order of the prototypes, and with it every decision and confidence, does not depend on the length.
        """
        out = np.zeros((n_texts, len(self.langs)), dtype=np.float32)
        if len(text):
            there, start = np.unique(text, return_index=True)
            length = np.sqrt(self.dimensions * np.add.reduceat((count * self.weight[code]) ** 2, start))
            dot = np.add.reduceat(count[:, None].astype(np.float32) * self.product[code], start, axis=0)
            out[there] = dot / np.maximum(length, 1e-6)[:, None]
        return out


def label_language(label: Column, langs: list[tuple[str, str, str]]) -> Column:
    """The code that a label means, in any of the spellings of a code or name; null if it names no language."""
    plain = F.lower(F.trim(label))
    plain = F.regexp_replace(plain, r"[-_](xx|latn|cyrl|[a-z]{2})$", "")
    out = F.lit(None).cast("string")
    for lang, iso3, name in langs:
        names = sorted({lang.lower(), (iso3 or lang).lower(), (name or lang).lower(), ENGLISH.get(lang, lang)})
        out = F.when(plain.isin(names), F.lit(lang)).otherwise(out)
    return out


def train(labelled: DataFrame, text: str, lang: str, key: str) -> Profiles | None:
    """Profiles from a bounded, hash-chosen sample of labelled texts; None without labelled texts.

    The sample's share per language follows from its count, so it has about ``SAMPLE_PER_LANGUAGE`` whole
    texts at any size of the data.  The cluster sums n-gram counts per language - at most languages x
    n-grams numbers - and the driver binds and bundles them.  A second round leaves out the sampled texts
    that the first profiles assign to another language: some labels are wrong.
    """
    counts = {r[lang]: r["count"] for r in bounded_collect(labelled.where(F.col(lang).isNotNull()).groupBy(lang).count(), 1000, "languages")}
    if not counts:
        return None
    share = F.lit(0.0)
    for code, n in counts.items():
        share = F.when(F.col(lang) == code, F.lit(min(1.0, SAMPLE_PER_LANGUAGE / n))).otherwise(share)
    chosen = F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(1_000_000)) < share * 1_000_000
    sample = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & chosen).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    langs, width = sorted(counts), len(ALPHABET) ** NGRAM
    place = {c: k for k, c in enumerate(langs)}

    def partial(first: Profiles | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums, texts = np.zeros((2, len(langs) * width)), np.zeros(len(langs))
            for whole in batches:
                for a in range(0, len(whole), TOGETHER):
                    b = whole.iloc[a : a + TOGETHER]
                    own = np.array([place[c] for c in b["lang"]])
                    text, code, count = ngram_counts(b["text"].tolist())
                    keep = np.bincount(text, minlength=len(b)) > 0
                    if first:
                        keep &= np.array([place[c] for c in first.langs])[first.cosines(len(b), text, code, count).argmax(axis=1)] == own
                    norm = np.sqrt(np.bincount(text, weights=count.astype(float) ** 2, minlength=len(b)))
                    used = keep[text]
                    at = own[text[used]] * width + code[used]
                    sums[0] += np.bincount(at, weights=count[used] / norm[text[used]], minlength=sums.shape[1])
                    sums[1] += np.bincount(at, minlength=sums.shape[1])
                    texts += np.bincount(own[keep], minlength=len(langs))
            for k, c in enumerate(langs):
                mine = sums[:, k * width : (k + 1) * width]
                used = np.flatnonzero(mine[1])
                yield pd.DataFrame({"lang": c, "code": np.append(used, -1), "bundled": np.append(mine[0][used], 0.0), "present": np.append(mine[1][used], texts[k])})

        return run

    profiles = None
    for _ in range(2):
        rows = sample.mapInPandas(partial(profiles), "lang string, code long, bundled double, present double")
        summed = rows.groupBy("lang", "code").agg(F.sum("bundled").alias("bundled"), F.sum("present").alias("present"))
        got = pd.DataFrame(bounded_collect(summed, len(langs) * (width + 1), "n-grams of languages"), columns=summed.columns)
        bundled, present = np.zeros((len(langs), width)), np.zeros((len(langs), width))
        for k, c in enumerate(langs):
            own = got[(got["lang"] == c) & (got["code"] >= 0)]
            total = got[(got["lang"] == c) & (got["code"] < 0)]["present"].sum()
            bundled[k, own["code"].to_numpy()] = own["bundled"]
            present[k, own["code"].to_numpy()] = own["present"] / max(total, 1)
        profiles = Profiles(langs, bundled, present, Space())
    return profiles


def segments(documents: DataFrame, profiles: Profiles | None, *, key: str = "doc_id", text: str = "text", names: list[str] | None = None) -> DataFrame:
    """(key, para_no, n_chars, lang, confidence): every paragraph from 1, and para_no 0 for the whole text.

    Paragraphs are the non-blank pieces between line breaks.  A paragraph has the language of the nearest
    prototype; its confidence is that cosine's share over the runner-up, from 0 to 1.  Paragraphs without
    letters take the language of the text.  The whole text has the language of most characters, with their
    share as confidence.  Null and blank texts give no row; a text without any letter has a null language.
    ``names`` (a bounded list) are left out of the texts: names of countries have no language.  Whole texts
    are read, in place, without a shuffle.
    """
    listed = list(names or [])
    langs = profiles.langs if profiles else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ignore = Names(listed)
        for whole in batches:
            for a in range(0, len(whole), TOGETHER):
                b = whole.iloc[a : a + TOGETHER]
                held = [[p.strip() for p in re.split(r"[\r\n]+", t) if p.strip()] if t else [] for t in b["text"]]
                pieces = [p for paras in held for p in paras]
                text, code, count = ngram_counts(pieces, ignore=ignore)
                enough = np.bincount(text, weights=count, minlength=len(pieces)) >= 3
                cos = profiles.cosines(len(pieces), text, code, count) if profiles else np.zeros((len(pieces), 0))
                top = cos.argmax(axis=1).tolist() if langs else [0] * len(pieces)
                high = np.sort(cos, axis=1)[:, ::-1]
                second = np.clip(high[:, 1], 0, None) if len(langs) > 1 else 0.0
                sure = np.clip((high[:, 0] - second) / np.maximum(high[:, 0], 1e-6), 0, 1).round(4).tolist() if langs else [0.0] * len(pieces)
                told, at, out = (enough & bool(langs)).tolist(), 0, []
                for doc, paras in zip(b["key"].tolist(), held, strict=True):
                    if not paras:
                        continue
                    chars: dict[str, int] = {}
                    for k, p in enumerate(paras, at):
                        if told[k]:
                            chars[langs[top[k]]] = chars.get(langs[top[k]], 0) + len(p)
                    most = max(sorted(chars), key=lambda c: chars[c]) if chars else None
                    out.append((doc, 0, sum(map(len, paras)), most, round(chars[most] / sum(chars.values()), 4) if most else 0.0))
                    out += [(doc, k - at + 1, len(p), langs[top[k]] if told[k] else most, sure[k] if told[k] else 0.0) for k, p in enumerate(paras, at)]
                    at += len(paras)
                yield pd.DataFrame(out, columns=["key", "para_no", "n_chars", "lang", "confidence"])

    return (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInPandas(run, "key long, para_no int, n_chars long, lang string, confidence double")
        .withColumnRenamed("key", key)
    )
