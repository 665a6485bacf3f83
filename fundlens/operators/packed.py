"""Several values packed in one cell: dictionary-guided segmentation.

Whole values that are known - because they stand alone in some cell, are quoted, or are cut off by a
separator that no name contains - form a dictionary.  A multi-pattern automaton finds their occurrences in
a cell in one scan, and dynamic programming picks the cover of the cell with the least cost, so that a
separator inside a known value ("Ministry of Finance, Velmora") does not cut it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect, materialize

#: Separators that cut wherever they stand outside quotes and known values; so does a slash between spaces.
STRONG = ";|\n\r\t；"
#: Separators of more than one kind of sign: a comma cuts only if the cell separates values by nothing else.
COMMA_OR_SLASH = re.compile(r",| / ")
#: A name needs this many cells or quotations to enter the dictionary: one misread cell must not make a name.
MIN_SUPPORT = 2
#: Names with separators up to which the dictionary is sent to every task (some 20 MB); beyond, stretches of
#: the cells are joined to it.
MAX_DICTIONARY = 200_000


def known_names(cells: DataFrame, column: str) -> DataFrame:
    """(item): the names known as whole values in all cells. One pass with map-side aggregation."""
    cell = F.col(column)
    quoted = F.transform(F.regexp_extract_all(cell, F.lit(r'(?s)"((?:[^"]|"")*)"'), F.lit(1)), lambda x: F.replace(x, F.lit('""'), F.lit('"')))
    bare = F.regexp_replace(cell, r'(?s)"(?:[^"]|"")*"', "")
    pieces = F.split(bare, f"[{STRONG}]")
    strong = F.size(pieces) > 1
    whole = F.when(strong, pieces).when(~F.contains(bare, F.lit(",")) & ~F.contains(bare, F.lit("/")) & ~F.contains(cell, F.lit('"')), pieces)
    return (
        cells.where(cell.isNotNull())
        .select(F.explode(F.array_distinct(F.concat(quoted, F.coalesce(whole, F.array().cast("array<string>"))))).alias("item"))
        .select(F.trim(F.regexp_replace("item", r"(?U)^[\s\h]+|[\s\h]+$", "")).alias("item"))
        .where("item <> ''")
        .groupBy("item")
        .count()
        .where(F.col("count") >= MIN_SUPPORT)
        .select("item")
    )


def learn_dictionary(cells: DataFrame, column: str, most: int = MAX_DICTIONARY) -> list[str]:
    """:func:`known_names` as a list, for one's own :class:`Segmenter`; more than ``most`` are an error."""
    return sorted(r[0] for r in bounded_collect(known_names(cells, column), most, "known names"))


def _protected(names: DataFrame) -> DataFrame:
    """The names that hold a separator: the only ones a cover needs, as the others have no place to be cut at."""
    return names.where(F.col("item").rlike(f"[,/{STRONG}]"))


def stretches(cell: str, most: int) -> list[str]:
    """The stretches of a cell that may be a known value: from a separator to one of the next ``most`` after it."""
    cuts, _ = Segmenter._cuts(cell)
    edges = [(0, 0), *[(a, b) for a, b, _ in cuts], (len(cell), len(cell))]
    out = {cell[edges[i][1] : edges[j][0]].strip(" \xa0") for i in range(len(edges)) for j in range(i + 2, min(i + most + 2, len(edges)))}
    return sorted(out - {""})


class Segmenter:
    """Splits one cell after another by the dictionary."""

    def __init__(self, names: list[str]):
        self.names = set(names)
        self.automaton = ahocorasick.Automaton()
        for n in names:
            self.automaton.add_word(n, len(n))
        if names:
            self.automaton.make_automaton()

    @staticmethod
    def _cuts(cell: str) -> tuple[list[tuple[int, int, bool]], list[tuple[int, int]]]:
        """Separators outside quotes as (start, end, strong), and the quoted stretches."""
        cuts, quotes, i, fresh = [], [], 0, True
        while i < len(cell):
            ch = cell[i]
            if fresh and ch == '"':
                j = i + 1
                while j < len(cell):
                    if cell[j] == '"':
                        if cell[j + 1 : j + 2] == '"':
                            j += 2
                            continue
                        break
                    j += 1
                rest = cell[j + 1 :].lstrip(" \xa0")[:1]
                if j < len(cell) and (not rest or rest in STRONG or rest in ",/"):
                    quotes.append((i, j + 1))
                    i, fresh = j + 1, False
                    continue
            if ch in STRONG:
                cuts.append((i, i + 1, True))
                fresh = True
            elif m := COMMA_OR_SLASH.match(cell, i):
                cuts.append((m.start(), m.end(), m[0] != ","))
                fresh, i = True, m.end()
                continue
            elif not ch.isspace():
                fresh = False
            i += 1
        return cuts, quotes

    def split(self, cell: str | None) -> list[str]:
        """The values of a cell in order; none for a null or blank cell."""
        if cell is None or not cell.strip():
            return []
        cuts, quotes = self._cuts(cell)
        if not cuts:
            return self._clean([cell])
        edges = [(0, 0, True), *cuts, (len(cell), len(cell), True)]
        starts = {end: k for k, (_, end, _) in enumerate(edges[:-1])}
        ends = {start: k for k, (start, _, _) in enumerate(edges) if k}
        # known values that stand between two separators
        known: dict[int, list[int]] = {}
        if self.names:
            for last, length in self.automaton.iter(cell):
                a, b = last + 1 - length, last + 1
                while a > 0 and cell[a - 1] in " \xa0" and a not in starts:
                    a -= 1
                while b < len(cell) and cell[b] in " \xa0" and b not in ends:
                    b += 1
                if a in starts and b in ends and starts[a] < ends[b]:
                    known.setdefault(starts[a], []).append(ends[b])
        inside = {k for i, js in known.items() for j in js for k in range(i + 1, j)}
        separated = any(strong and k not in inside for k, (_, _, strong) in enumerate(edges[1:-1], 1))
        # least cost from each separator to the end; fewer and known values are cheaper
        n = len(edges) - 1
        best: list[tuple[float, int]] = [(0.0, n)] * (n + 1)
        following, nxt = n, [n] * (n + 1)  # the next strong separator
        for k in range(n, -1, -1):
            nxt[k] = following
            if edges[k][2]:
                following = k
        for i in range(n - 1, -1, -1):
            options = [(1.0 + best[i + 1][0], i + 1)]
            if separated and nxt[i] > i + 1:  # a comma belongs to the name where the cell separates otherwise
                options.append((1.0 + 0.01 * (nxt[i] - i) + best[nxt[i]][0], nxt[i]))
            if not cell[edges[i][1] : edges[i + 1][0]].strip():
                options.append((best[i + 1][0], i + 1))  # nothing between two separators
            options += [(0.1 + best[j][0], j) for j in known.get(i, ())]
            best[i] = min(options)
        out, i = [], 0
        while i < n:
            j = best[i][1]
            out.append(cell[edges[i][1] : edges[j][0]])
            i = j
        return self._clean(out)

    @staticmethod
    def _clean(items: list[str]) -> list[str]:
        out = []
        for x in items:
            x = x.strip().strip("​﻿").strip()
            if len(x) > 1 and x[0] in "[(" and x[-1] == {"[": "]", "(": ")"}[x[0]]:
                x = x[1:-1].strip()
            if len(x) > 1 and x[0] == x[-1] == '"':
                x = x[1:-1].replace('""', '"').strip()
            elif len(x) > 1 and x[0] == x[-1] == "'":
                x = x[1:-1].strip()
            if x:
                out.append(x)
        return out


def _pieces(split: DataFrame) -> DataFrame:
    """(row_key, pos, n_items, item) of (row_key, __items)."""
    return split.select("row_key", F.size("__items").alias("n_items"), F.posexplode("__items").alias("__p", "item")).select(
        "row_key", (F.col("__p") + 1).alias("pos"), "n_items", "item"
    )


def split_cells(cells: DataFrame, key: str, column: str, names: list[str] | None = None, most: int = MAX_DICTIONARY) -> DataFrame:
    """One row per value of ``column`` with its place in the cell: (row_key, pos, n_items, item).

    Null and blank cells give no row; a cell with one value gives one; a value repeated in a cell is kept
    each time.  ``names`` is a known list of whole values; left out, it is learnt from all cells.  Up to
    ``most`` learnt names with separators go to every task and the cells are split in place; beyond, the
    distinct cells' stretches are joined to the names, and each cell is split by the names it holds - with
    the same result.
    """
    df = cells.where(F.col(column).isNotNull()).select(F.col(key).alias("row_key"), F.col(column).alias("__cell"))
    if names is None:
        learnt = _protected(known_names(cells, column))
        got = [r[0] for r in learnt.limit(most + 1).collect()]
        if len(got) > most:
            return _split_by_join(df, materialize(learnt))
        names = sorted(got)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seg = Segmenter(names)
        for b in batches:
            yield b.map(seg.split)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return _pieces(df.select("row_key", F.pandas_udf(run, "array<string>")("__cell").alias("__items")))


def _split_by_join(df: DataFrame, names: DataFrame) -> DataFrame:
    """The cells of (row_key, __cell) split by the names that an equi-join finds among their stretches."""
    longest = names.agg(F.max(F.regexp_count("item", F.lit(f"[,/{STRONG}]")))).first()[0] or 0  # separators in a name

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(c, s) for c in b["__cell"] for s in stretches(c, longest)], columns=["__cell", "item"])

    held = df.select("__cell").distinct().mapInPandas(cut, "__cell string, item string").join(names, "item").groupBy("__cell").agg(F.collect_set("item").alias("__names"))

    @F.pandas_udf("array<string>")
    def split(cell: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([Segmenter([] if k is None else sorted(k)).split(c) for c, k in zip(cell, known, strict=True)])

    return _pieces(df.join(held, "__cell", "left").select("row_key", split("__cell", "__names").alias("__items")))


class CodeCover:
    """Cuts runs of letters and digits into known codes, by the cover with the fewest codes; of equal ones that with the shorter code last."""

    def __init__(self, codes: list[str]):
        self.automaton = ahocorasick.Automaton()
        for c in codes:
            self.automaton.add_word(c, len(c))
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def cut(self, run: str) -> list[str]:
        """The codes that make up the run; the run itself where no sequence of known codes does."""
        ends: dict[int, list[int]] = {}
        if self.any:
            for last, n in self.automaton.iter(run):
                ends.setdefault(last + 1, []).append(n)
        best: list[tuple[int, int] | None] = [(0, 0), *[None] * len(run)]
        for at in range(1, len(run) + 1):
            options = [(best[at - n][0] + 1, n) for n in ends.get(at, ()) if best[at - n] is not None]
            best[at] = min(options, default=None)
        if best[-1] is None:
            return [run]
        out, at = [], len(run)
        while at:
            out.append(run[at - best[at][1] : at])
            at -= best[at][1]
        return out[::-1]


def split_codes(cells: DataFrame, key: str, column: str, codes: DataFrame, null_word: str = "None") -> DataFrame:
    """As :func:`split_cells`, for cells of short codes in upper case, packed with any separator or none.

    The dictionary is the reference list and, as group codes are lawful, what stands alone between separators
    in at least ``MIN_SUPPORT`` cells and is as long as a listed code.  A run of letters and digits is cut by
    the cover of fewest known codes; a run that no codes make up is a value of its own.  ``null_word`` means
    null, in a cell or between separators.
    """
    listed = sorted({r[0].upper() for r in bounded_collect(codes.where(codes[0].isNotNull()).distinct(), MAX_DICTIONARY, "codes") if r[0].strip()})
    lengths = sorted({len(c) for c in listed})
    cell = F.col(column)
    alone = F.explode(F.array_distinct(F.split(F.upper(cell), r"[^\p{L}\p{N}]+"))).alias("item")
    seen = cells.where(cell.isNotNull()).select(alone).where(F.length("item").isin(lengths) & (F.col("item") != null_word.upper())).groupBy("item").count().where(F.col("count") >= MIN_SUPPORT)
    # as many as there are codes of these lengths, whatever the number of cells
    known = sorted({*listed, *(r[0] for r in bounded_collect(seen.select("item"), MAX_DICTIONARY, "codes in use"))}) if listed else []

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cover = CodeCover(known)

        def split(text: str) -> list[str]:
            runs = re.findall(r"[^\W_]+", text.upper())
            return [c for r in runs if r != null_word.upper() for c in cover.cut(r)]

        for b in batches:
            yield b.map(split)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    df = cells.where(cell.isNotNull()).select(F.col(key).alias("row_key"), cell.alias("__cell"))
    return _pieces(df.select("row_key", F.pandas_udf(run, "array<string>")("__cell").alias("__items")))
