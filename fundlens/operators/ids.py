"""Canonical project ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shape(key: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(key, r"\p{L}", "A"), r"\p{N}", "9")


def canonical_ids(rows: DataFrame, bank: str = "bank_id", ident: str = "project_id") -> DataFrame:
    """Add ``project_key``: the id without case, separators and publisher prefix.

    A bank writes its ids in one shape (letters and digits); an id that only ends in its bank's commonest
    shape carries a prefix, which is cut.  The shapes are counted over all rows - one small count per bank
    and shape.  Null or blank ids get a null key and belong to no group.
    """
    plain = F.regexp_replace(F.lower(F.col(ident)), r"[^\p{L}\p{N}]", "")
    df = rows.withColumn("__plain", F.when(plain != "", plain)).withColumn("__shape", _shape(F.col("__plain")))
    common = (
        df.where("__plain IS NOT NULL")
        .groupBy(F.col(bank).alias("__bank"), "__shape")
        .agg(F.count(F.lit(1)).alias("__n"))
        .groupBy("__bank")
        .agg(F.max(F.struct("__n", F.col("__shape").alias("s")))["s"].alias("__usual"))
    )
    # one row per bank: broadcast by its measured size
    df = df.join(common, F.col(bank).eqNullSafe(F.col("__bank")), "left")
    tail = F.col("__shape").endswith(F.col("__usual"))
    key = F.when(tail, F.expr("right(__plain, length(__usual))")).otherwise(F.col("__plain"))
    return df.withColumn("project_key", key).drop("__plain", "__shape", "__bank", "__usual")
