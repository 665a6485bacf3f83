"""Mixing sources to target weights: exact token budgets by subset sums over text lengths."""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect, materialize

SEED = 7_001
#: Tokens that the knapsack decides first; the rest of a budget is taken in proportion to the lengths.  Where the
#: budget isn't met to the token, the knapsack decides over more and more, at most over this many (4 bytes each).
EXACT_WINDOW, MAX_WINDOW = 30_000, 1 << 28
MAX_SOURCES = 10_000
_BUCKETS = 64


def budgets(targets: list[tuple[int, str, float, int]], totals: dict[str, int], size: int | None = None) -> list[dict]:
    """Token budget of every source of every recipe.

    Without ``size`` the mixture is the largest in which every source that has texts can keep its share without
    any text being used more than ``max_repeats`` times.  With it, a source too small for its share gives what
    its repeats allow; ``wanted`` says what it should have given.  A source without texts gets 0, and its share
    falls to the others in proportion.
    """
    out = []
    for recipe in sorted({t[0] for t in targets}):
        own = [t for t in targets if t[0] == recipe]
        there = sum(share for _, s, share, _ in own if totals.get(s, 0) > 0 and share > 0)
        largest = min((most * totals[s] * there / share for _, s, share, most in own if totals.get(s, 0) > 0 and share > 0), default=0.0)
        for _, source, share, most in own:
            total = totals.get(source, 0)
            wanted = round((largest if size is None else size) * share / there) if total and there and share > 0 else 0
            budget = min(wanted, most * total)
            out.append({"recipe_id": recipe, "source": source, "target_share": share, "max_repeats": most, "source_tokens": total, "wanted": wanted, "budget": budget, "full_repeats": budget // total if total else 0, "rest": budget % total if total else 0})
    return out


def subset(lengths: list[int], counts: list[int], rest: int, window: int = EXACT_WINDOW) -> list[int]:
    """How many texts of each length to take so that their lengths add up to ``rest``, or next below it.

    Each length first gives its proportional number, rounding errors carried on; the last ``window`` tokens are
    decided by a bounded knapsack over what is left of every length.  If that doesn't meet ``rest``, the window
    grows until it does or holds all of ``rest``, which is the exact optimum (up to ``MAX_WINDOW`` tokens).
    """
    unit = gcd(*[n for n, c in zip(lengths, counts, strict=True) if c]) or 1
    lengths, rest = [n // unit for n in lengths], min(rest // unit, sum(n // unit * c for n, c in zip(lengths, counts, strict=True)))
    while True:
        take = _fit(lengths, counts, rest, window)
        if sum(n * t for n, t in zip(lengths, take, strict=True)) >= rest or window >= min(rest, MAX_WINDOW):
            return take
        window *= 8


def _fit(lengths: list[int], counts: list[int], rest: int, window: int) -> list[int]:
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    take = [0] * len(lengths)
    if rest <= 0 or not total:
        return take
    order = sorted((k for k in range(len(lengths)) if counts[k]), key=lambda k: -lengths[k])
    share, carry = max(0, rest - window) / total, 0.0
    for k in order:
        want = lengths[k] * counts[k] * share + carry
        take[k] = min(counts[k], int(want // lengths[k]))
        carry = want - take[k] * lengths[k]
    left = rest - sum(n * t for n, t in zip(lengths, take, strict=True))
    # the carried error may exceed the window where long texts ran out
    for k in order:
        while left > window and take[k] < counts[k] and lengths[k] <= left:
            more = min(counts[k] - take[k], max(1, (left - window) // lengths[k]))
            take[k] += more
            left -= more * lengths[k]
    parts = []  # binary splitting: any number of texts of a length is a sum of its parts
    for k in order:
        free, chunk = min(counts[k] - take[k], left // lengths[k]), 1
        while free > 0:
            m = min(chunk, free)
            parts.append((k, m, m * lengths[k]))
            free, chunk = free - m, chunk * 2
    # per sum the part that first reached it, from a sum that earlier parts had reached
    first = np.full(left + 1, -1, dtype=np.int32)
    first[0] = len(parts)
    for i, (_, _, n) in enumerate(parts):
        fresh = np.flatnonzero((first[:-n] >= 0) & (first[:-n] != i) & (first[n:] < 0)) if n else []
        first[np.asarray(fresh, dtype=np.int64) + n] = i
        if first[left] >= 0:
            break
    at = int(np.flatnonzero(first >= 0)[-1])
    while at:
        k, m, n = parts[first[at]]
        take[k] += m
        at -= n
    return take


def mix(sizes: DataFrame, targets: DataFrame, *, key: str = "doc_id", source: str = "source", size: str = "n_tokens", seed: int = SEED, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The mixture (recipe_id, source, key, n_tokens, repeats) and the shares reached.

    Every text of a source is used ``full_repeats`` times, and the texts that fill the rest once more: by
    count per exact length, within a length by seeded hash.  Texts without a source or tokens are in no
    mixture.  ``total`` is the size of every mixture in tokens, see :func:`budgets`.  Histograms by length stay in the cluster, one task per source - bounded by the number of
    distinct lengths.  Ranking is over (length, hash bucket), so a hot length is split.
    """
    listed = [(r["recipe_id"], r["source"], float(r["target_share"]), int(r["max_repeats"])) for r in bounded_collect(targets, MAX_SOURCES, "targets") if r["source"] is not None]
    wanted = sorted({s for _, s, _, _ in listed})
    docs = sizes.where(F.col(source).isin(wanted) & (F.col(size) > 0)).select(F.col(key).alias("__key"), F.col(source).alias("source"), F.col(size).alias("n_tokens"))
    hist = materialize(docs.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n")))
    totals = {r["source"]: r["t"] for r in bounded_collect(hist.groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("t")), MAX_SOURCES, "sources")}
    plan = budgets(listed, totals, total)

    def decide(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens")
        lengths, counts = pdf["n_tokens"].tolist(), pdf["n"].tolist()
        out = []
        for b in plan:
            if b["source"] == group[0] and b["budget"]:
                take = subset(lengths, counts, b["rest"])
                out += [(b["recipe_id"], b["source"], n, c, t, b["full_repeats"]) for n, c, t in zip(lengths, counts, take, strict=True) if t or b["full_repeats"]]
        return pd.DataFrame(out, columns=["recipe_id", "source", "n_tokens", "n", "take", "full_repeats"])

    takes = materialize(hist.groupBy("source").applyInPandas(decide, "recipe_id int, source string, n_tokens long, n long, take long, full_repeats int"))
    cell = ["recipe_id", "source", "n_tokens"]
    rows = docs.join(takes, ["source", "n_tokens"])
    plain = rows.where("take = 0 OR take = n").withColumn("repeats", F.col("full_repeats") + (F.col("take") > 0).cast("int"))
    order = F.xxhash64("__key", "recipe_id", F.lit(seed))
    partial = rows.where("take > 0 AND take < n").withColumn("__h", order).withColumn("__b", F.expr(f"pmod(shiftright(__h, 40), {_BUCKETS})"))
    before = (
        partial.groupBy(*cell, "__b").agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__before", F.coalesce(F.sum("__c").over(W.partitionBy(*cell).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .drop("__c")
    )
    ranked = partial.join(before, [*cell, "__b"]).withColumn("__r", F.col("__before") + F.row_number().over(W.partitionBy(*cell, "__b").orderBy("__h", "__key")))
    ranked = ranked.withColumn("repeats", F.col("full_repeats") + (F.col("__r") <= F.col("take")).cast("int"))
    cols = ["recipe_id", "source", F.col("__key").alias(key), "n_tokens", "repeats"]
    chosen = plain.select(*cols).unionByName(ranked.select(*cols)).where("repeats > 0")
    spark = sizes.sparkSession
    schema = "recipe_id int, source string, target_share double, max_repeats int, source_tokens long, wanted long, budget long, full_repeats int, rest long"
    asked = spark.createDataFrame([tuple(b.values()) for b in plan], schema)
    got = takes.groupBy("recipe_id", "source").agg(F.sum(F.col("n_tokens") * (F.col("n") * F.col("full_repeats") + F.col("take"))).alias("tokens"))
    shares = (
        asked.join(got, ["recipe_id", "source"], "left")
        .withColumn("tokens", F.coalesce("tokens", F.lit(0)))
        .withColumn("actual_share", F.round(F.try_divide(F.col("tokens"), F.sum("tokens").over(W.partitionBy("recipe_id"))), 8))
        .select("recipe_id", "source", "target_share", "actual_share", "tokens", "wanted", "budget", "source_tokens", "max_repeats")
    )
    return chosen, shares
