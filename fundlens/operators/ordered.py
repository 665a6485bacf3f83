"""First, last and occurrence semantics over an explicit order column, and layout-checked unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions.text import fingerprint, strip


def first_by(df: DataFrame, keys: list[Column], order: Column) -> DataFrame:
    """One row per key, the first in order: an aggregate with map-side combine, so a hot key is no hot task."""
    names = [f"__k{i}" for i in range(len(keys))]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    picked = df.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.min_by(row, order).alias("__row"))
    return picked.select("__row.*")


def dedupe(df: DataFrame, bank: str, ident: str, order: str) -> DataFrame:
    """One row per bank and id without case, the first in order; ids are compared inside their bank only."""
    return first_by(df, [F.lower(F.concat_ws(":", F.col(bank), F.col(ident)))], F.col(order))


def newest_snapshot(live: DataFrame, archives: list[DataFrame], ident: str, order: str) -> DataFrame:
    """Live rows, and from each archive - newest first - the ids not seen before."""
    parts = [d.withColumn("__p", F.lit(k)) for k, d in enumerate([live, *archives])]
    both = reduce(lambda a, b: a.unionByName(b), parts)
    return first_by(both, [F.lower(strip(F.col(ident)))], F.struct("__p", order)).drop("__p")


def labels(df: DataFrame, keys: list[str], label: str, order: str, last: bool = False) -> DataFrame:
    """The first (or last) label seen per key; an empty label counts."""
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.coalesce(F.col(label), F.lit("")), F.col(order)).alias(label))


def first_filled(df: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """Per key and field the first value that is not null."""
    return df.groupBy(*keys).agg(*[F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields])


def occurrence_ids(df: DataFrame, parts: list[str], order: str, prefix: str, length: int = 12) -> DataFrame:
    """Add ``record_id``: a fingerprint of the parts, repeats with -2, -3 in order.

    Ranking runs inside (fingerprint, bucket of the order column's hash) would change the numbers, so one
    fingerprint is ranked in one task; only exact repeats share one.
    """
    df = df.withColumn("__f", F.concat(F.lit(prefix), fingerprint([F.col(p) for p in parts], length)))
    n = F.row_number().over(W.partitionBy("__f").orderBy(order))
    return df.withColumn("record_id", F.when(n == 1, F.col("__f")).otherwise(F.concat_ws("-", "__f", n.cast("string")))).drop("__f")


def ordered_concat(df: DataFrame, keys: list[str], value: str, order: str, separator: str = "; ") -> DataFrame:
    """Distinct values without case, in order of first appearance, joined. Values are reduced before they are gathered."""
    first = df.where(F.trim(value) != "").groupBy(*keys, F.lower(F.trim(value)).alias("__l")).agg(F.min(F.struct(F.col(order).alias("o"), F.trim(value).alias("v"))).alias("__s"))
    return first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("__s")), lambda s: s["v"]), separator).alias(value))


def union_checked(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of outputs whose columns must agree in names and order, with their input order."""
    want = frames[0].columns
    for k, f in enumerate(frames):
        if f.columns != want:
            missing, extra = [c for c in want if c not in f.columns], [c for c in f.columns if c not in want]
            raise ValueError(f"input {k}: missing columns {missing}, unexpected columns {extra}" if missing or extra else f"input {k}: columns in another order")
    return reduce(lambda a, b: a.unionByName(b), [f.withColumn("__input", F.lit(k)) for k, f in enumerate(frames)])
