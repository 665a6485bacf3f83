"""Code lists: values by code or name in tiers, over lists that come as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.text import ascii_fold, normalize_text


def list_key(c: Column) -> Column:
    """How list entries are compared: folded, lower case, letters and digits with single blanks."""
    return F.trim(F.regexp_replace(F.lower(ascii_fold(c)), "[^a-z0-9]+", " "))


def tiered_lookup(rows: DataFrame, value: str, tiers: list[DataFrame], out: str) -> DataFrame:
    """Add ``out``: the value of the first tier with an entry for the text, for the whole text before its first
    part (up to ``;`` or ``,``); null where none has.

    Each tier is a list (key, value); of a repeated key the smallest value counts.  The lists are joined one
    after the other as small sides that the optimiser broadcasts by their measured size.
    """
    df = rows.withColumn("__whole", list_key(F.col(value))).withColumn("__part", list_key(F.regexp_extract(normalize_text(F.col(value)), r"^([^;,]*)", 1)))
    found: list[Column] = []
    for which in ("__whole", "__part"):
        for k, tier in enumerate(tiers):
            name = f"{which}{k}"
            one = tier.select(list_key(F.col("key")).alias(f"{name}k"), F.col("value").alias(f"{name}v")).where(F.col(f"{name}k") != "").groupBy(f"{name}k").agg(F.min(f"{name}v").alias(f"{name}v"))
            df = df.join(one, F.col(which) == F.col(f"{name}k"), "left")
            found.append(F.col(f"{name}v"))
    return df.withColumn(out, F.coalesce(*found)).select(*[c for c in rows.columns if c != out], out)


def country_tiers(ref: DataFrame) -> list[DataFrame]:
    """Codes first, then names, then other names of a country list (iso2, iso3, country_name, alt_names)."""
    return [
        ref.select(F.col("iso3").alias("key"), F.col("iso3").alias("value")).unionByName(ref.select(F.col("iso2").alias("key"), F.col("iso3").alias("value"))),
        ref.select(F.col("country_name").alias("key"), F.col("iso3").alias("value")),
        ref.select(F.explode("alt_names").alias("key"), F.col("iso3").alias("value")),
    ]
