"""Entity x country x year panels with control totals, balanced spines and invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.text import INSTRUMENTS

BUCKETS = [*INSTRUMENTS, "unspecified"]
TERMS = ["yes", "no", "blended", "unknown"]


def _usd(cents: Column) -> Column:
    return F.coalesce(F.sum(cents), F.lit(0)).cast("double") / 100.0


def measures() -> list[Column]:
    """Counts and dollar sums of a cell, by instrument and by terms; missing amounts count in no sum."""
    bucket = F.coalesce(F.col("instrument"), F.lit("unspecified"))
    terms = F.coalesce(F.when(F.col("concessional").isin("Yes", "No", "Blended"), F.lower("concessional")), F.lit("unknown"))
    n = F.col("conversion")
    out = [
        F.count(F.lit(1)).alias("n_operations"),
        F.count_if(n != "no-amount").alias("n_with_amount"),
        F.count_if(n.isin("unconverted", "excluded-currency-suspect")).alias("n_unconverted"),
        _usd(F.col("nominal_cents")).alias("usd_nominal_total"),
        _usd(F.col("constant_cents")).alias("usd_2025_total"),
        F.count_if(F.col("constant_cents").isNotNull() & F.col("ppp_constant_cents").isNull()).alias("n_ppp_unpriced"),
        _usd(F.when(F.col("constant_cents").isNotNull(), F.col("ppp_constant_cents"))).alias("ppp_2025_total"),
    ]
    out += [F.count_if(bucket == b).alias(f"n_{b}") for b in BUCKETS]
    out += [_usd(F.when(bucket == b, F.col("constant_cents"))).alias(f"usd_2025_{b}") for b in BUCKETS]
    return out + [_usd(F.when(terms == t, F.col("constant_cents"))).alias(f"usd_2025_concessional_{t}") for t in TERMS]


def panel(ops: DataFrame, first: int, last: int) -> DataFrame:
    """Allocated cells (bank, code, year) inside the scope; rows without a code are in :func:`unallocated`."""
    return scoped(ops, first, last).where("code IS NOT NULL").groupBy("bank_id", "code", F.col("analysis_year").alias("year")).agg(*measures())


def scoped(ops: DataFrame, first: int, last: int) -> DataFrame:
    """Rows whose year is known and inside the scope."""
    return ops.where(F.col("analysis_year").between(first, last))


def unallocated(ops: DataFrame, first: int, last: int) -> DataFrame:
    """Cells (bank, year) of the rows without a code, with the country texts they give."""
    texts = F.array_join(F.array_sort(F.collect_set(F.when(F.trim("country") != "", F.trim("country")))), "; ")
    return scoped(ops, first, last).where("code IS NULL").groupBy("bank_id", F.col("analysis_year").alias("year")).agg(*measures(), texts.alias("countries"))


def control(ops: DataFrame, first: int, last: int) -> DataFrame:
    """Totals of everything in scope by (bank, year)."""
    return scoped(ops, first, last).groupBy("bank_id", F.col("analysis_year").alias("year")).agg(F.count(F.lit(1)).alias("n_operations"), _usd(F.col("constant_cents")).alias("usd_2025_total"))


def with_totals(ops: DataFrame, first: int, last: int) -> DataFrame:
    """Panel cells, unallocated cells and control totals from one shuffle, told apart by ``level``."""
    cells = scoped(ops, first, last).withColumnRenamed("analysis_year", "year")
    g = cells.groupingSets([["bank_id", "code", "year"], ["bank_id", "year"]], "bank_id", "code", "year")
    level = F.when(F.grouping("code") == 1, "control").when(F.col("code").isNull(), "unallocated").otherwise("panel")
    return g.agg(F.count(F.lit(1)).alias("n_operations"), _usd(F.col("constant_cents")).alias("usd_2025_total"), level.alias("level"))


def broken(cells: DataFrame, left_over: DataFrame, totals: DataFrame) -> DataFrame:
    """(bank, year) whose panel and unallocated cells do not add up to the control total; empty if all hold."""
    parts = cells.select("bank_id", "year", "n_operations", "usd_2025_total").unionByName(left_over.select("bank_id", "year", "n_operations", "usd_2025_total"))
    got = parts.groupBy("bank_id", "year").agg(F.sum("n_operations").alias("got_n"), F.sum("usd_2025_total").alias("got_usd"))
    both = got.join(totals, ["bank_id", "year"], "full_outer")
    same = (F.col("got_n") == F.col("n_operations")) & (F.abs(F.col("got_usd") - F.col("usd_2025_total")) < 0.01)
    return both.where(~F.coalesce(same, F.lit(False)))


def balanced(cells: DataFrame, windows: DataFrame, first: int, last: int) -> DataFrame:
    """Every bank x its countries x every year: zeros only inside the coverage window, null outside.

    ``windows``: bank_id, start_year, end_year; a missing bound is open, an open end closes with the last
    year observed.  Observed cells outside the window stay, with ``in_coverage`` 0.
    """
    pairs = cells.select("bank_id", "code").distinct()
    seen = cells.groupBy("bank_id").agg(F.max("year").alias("__seen"))
    spine = pairs.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    df = spine.join(cells, ["bank_id", "code", "year"], "left").join(seen, "bank_id").join(windows, "bank_id", "left")
    lo = F.greatest(F.lit(first), F.coalesce("start_year", F.lit(first)))
    hi = F.least(F.lit(last), F.coalesce("end_year", "__seen"))
    inside = F.col("year").between(lo, hi)
    values = [c for c in cells.columns if c not in ("bank_id", "code", "year")]
    return df.select(
        "bank_id", "code", "year", F.col("n_operations").isNotNull().cast("int").alias("observed"), inside.cast("int").alias("in_coverage"),
        *[F.coalesce(F.col(c), F.when(inside, F.lit(0).cast(dict(cells.dtypes)[c]))).alias(c) for c in values],
    )


def with_outer(cells: DataFrame, other: DataFrame) -> DataFrame:
    """Panel and another panel's totals side by side, keys of either kept."""
    return cells.join(other, ["bank_id", "code", "year"], "full_outer")


def private_totals(rows: DataFrame) -> DataFrame:
    """Totals per key; one amount that cannot be priced makes the key's priced sum null.

    ``rows``: bank_id, code, year, n, nominal_cents, constant_cents.
    """
    unpriced = F.max(F.when(F.col("nominal_cents").isNotNull() & F.col("constant_cents").isNull(), 1))
    return rows.groupBy("bank_id", "code", "year").agg(
        F.sum("n").alias("private_n"), _usd(F.col("nominal_cents")).alias("private_usd_nominal"), F.when(unpriced.isNull(), _usd(F.col("constant_cents"))).alias("private_usd_2025")
    )


def conversion_tally(ops: DataFrame) -> DataFrame:
    """Rows with an amount by conversion status."""
    return ops.where("conversion <> 'no-amount'").groupBy("conversion").agg(F.count(F.lit(1)).alias("n"))


def ppp_missing(ops: DataFrame) -> DataFrame:
    """Countries of priced rows without a purchasing-power level, the most frequent first."""
    lacking = ops.where("nominal_cents IS NOT NULL AND ppp_cents IS NULL AND code IS NOT NULL")
    return lacking.groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "code")


def top(ops: DataFrame, n: int = 10, order: str = "row_id") -> DataFrame:
    """The largest operations in constant dollars, ties in input order."""
    return ops.where("constant_cents IS NOT NULL").orderBy(F.desc("constant_cents"), order).limit(n)
