"""Joins on containment and prefixes, and the profile built on them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.text import number_key


def contained_keys(keys: DataFrame, ids: DataFrame, group: str, least: int = 4) -> DataFrame:
    """(group, key): the distinct keys that occur inside some id of the same group.

    A key of length n occurs in an id exactly if it equals one of the id's substrings of length n.  Ids are
    cut only into the lengths that keys of their group have, so the join is on equality and no pair is
    compared.  Keys shorter than ``least`` occur almost everywhere and go by the same path.
    """
    k = keys.select(group, number_key(F.col("key")).alias("k")).where("k <> ''").distinct()
    lengths = k.groupBy(group).agg(F.collect_set(F.length("k")).alias("lens"))  # lengths of numbers: a handful
    own = ids.select(group, number_key(F.col("id")).alias("s")).where("s <> ''").distinct().join(lengths, group)
    one = F.transform(F.filter("lens", lambda n: n <= F.length("s")), lambda n: F.transform(F.sequence(F.lit(1), F.length("s") - n + 1), lambda i: F.substring(F.col("s"), i, n)))
    parts = own.select(group, F.explode(F.array_distinct(F.flatten(one))).alias("k")).distinct()
    return k.join(parts, [group, "k"], "left_semi").withColumnRenamed("k", "key")


def first_prefix(rows: DataFrame, text: str, prefixes: list[tuple[str, str]]) -> DataFrame:
    """Add ``owner``: the first in list order whose prefix the text starts with, null if none. One expression, no join."""
    t: Column = F.lower(F.trim(text))
    return rows.withColumn("owner", F.coalesce(*[F.when(t.startswith(p.lower()), F.lit(o)) for o, p in prefixes]))


def single_member(rows: DataFrame, ident: str, text: str, names: list[tuple[str, str]]) -> DataFrame:
    """(ident, member): the canonical name that a free text mentions as a whole word, if it is exactly one.

    ``names``: (spelling, canonical name), a bounded list; a spelling of several members tells none.  One
    pattern finds every mention in one pass, the longest spelling at a place; a spelling found is looked up in
    a map.  Texts without a mention, null texts and an empty list give no row.
    """
    owners: dict[str, set[str]] = {}
    for spelling, member in names:
        if spelling and spelling.strip() and member is not None:
            owners.setdefault(spelling.lower(), set()).add(member)
    told = {s: next(iter(m)) for s, m in owners.items() if len(m) == 1}
    if not told:
        return rows.select(ident, F.lit(None).cast("string").alias("member")).limit(0)
    pattern = r"(?U)(?<!\w)(" + "|".join(re.escape(s) for s in sorted(told, key=lambda s: (-len(s), s))) + r")(?!\w)"
    lookup = F.create_map(*[F.lit(x) for kv in sorted(told.items()) for x in kv])
    hits = F.array_distinct(F.transform(F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(1)), lambda m: lookup[m]))
    return rows.select(ident, hits.alias("__h")).where(F.size("__h") == 1).select(ident, F.get("__h", 0).alias("member"))


def donor_profile(rows: DataFrame, ids: DataFrame, group: str = "bank_id") -> DataFrame:
    """Rows, rows with money, exact distinct numbers, dollars, soft share and matched numbers per group and year.

    ``rows``: group, year, number, commitment, soft (boolean).  ``ids``: group, id.
    """
    money = F.col("commitment") > 0
    number = F.when(money & (F.trim("number") != ""), F.col("number"))
    hit = contained_keys(rows.select(group, F.col("number").alias("key")), ids, group).withColumn("__hit", F.lit(1))
    df = rows.withColumn("__k", number_key(F.col("number"))).join(hit.withColumnRenamed("key", "__k"), [group, "__k"], "left")
    total, soft = F.sum(F.when(money, F.col("commitment"))), F.sum(F.when(money & F.col("soft"), F.col("commitment")))
    return df.groupBy(group, "year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(money).alias("n_with_commitment"), F.countDistinct(number).alias("n_projects"),
        F.coalesce(total, F.lit(0)).cast("double").alias("commitment"), F.bround(F.try_divide(F.coalesce(soft, F.lit(0)).cast("double"), total.cast("double")), 3).alias("soft_share"),
        F.countDistinct(F.when(F.col("__hit") == 1, number)).alias("n_matching"),
    )
