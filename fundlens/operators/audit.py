"""Audits: coverage by year, fill rates, and backstop checks against official rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIVE_WORDS = ["cancel", "drop", "terminat", "withdrawn", "reject"]


def filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")


def coverage(rows: DataFrame, windows: DataFrame, first: int, last: int, today: str, low: float = 0.3, stale_days: int = 274) -> DataFrame:
    """Bank x year: operations, active and priced ones, the bank's median year and a flag.

    The median is over the covered years before today's, zero years included; a covered past year under
    ``low`` of it is ``low``; a bank whose newest date is old is ``stale`` in the last year; a year outside
    the window is ``not_covered``.  The newest date is taken over all rows, in scope or out.
    """
    this = int(today[:4])
    y = F.coalesce("approval_year", "commitment_year")
    known = rows.where(y.isNotNull()).withColumn("year", y)
    newest = known.groupBy("bank_id").agg(F.max(F.coalesce("approval_date", "commitment_date")).alias("latest_date"), F.max("year").alias("__seen"))
    inactive = F.coalesce(F.lower("status").rlike("|".join(ACTIVE_WORDS)), F.lit(False))
    counts = known.where(F.col("year").between(first, last)).groupBy("bank_id", "year").agg(
        F.count(F.lit(1)).alias("operations"), F.count_if(inactive).alias("not_active"), F.count("loan_amount").alias("with_amount"),
        F.coalesce(F.sum("loan_amount_usd"), F.lit(0)).cast("double").alias("usd_total"),
    )
    spine = newest.join(windows, "bank_id", "left").withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    lo = F.greatest(F.lit(first), F.coalesce("start_year", F.lit(first)))
    hi = F.least(F.lit(last), F.coalesce("end_year", "__seen", F.lit(last)))
    grid = spine.join(counts, ["bank_id", "year"], "left").na.fill(0, ["operations", "not_active", "with_amount"]).na.fill(0.0, ["usd_total"])
    grid = grid.withColumn("covered", F.col("year").between(lo, hi).cast("int"))
    middle = grid.groupBy("bank_id").agg(F.coalesce(F.median(F.when((F.col("covered") == 1) & (F.col("year") < this), F.col("operations"))), F.lit(0.0)).alias("bank_median"))
    g = grid.join(middle, "bank_id")
    old = (F.datediff(F.lit(today).cast("date"), F.col("latest_date")) > stale_days) & (F.col("__seen") < this)
    flag = F.when(F.col("covered") == 0, "not_covered").when((F.col("year") < this) & (F.col("operations") < F.col("bank_median") * low), "low")
    flag = F.concat_ws("; ", flag, F.when(F.coalesce(old, F.lit(False)) & (F.col("year") == last), "stale"))
    return g.select("bank_id", "year", "covered", "operations", "not_active", "with_amount", "usd_total", "bank_median", flag.alias("flag"))


def flag_rollup(grid: DataFrame) -> DataFrame:
    """Years listed per bank and flag (low and stale)."""
    flags = grid.select("bank_id", "year", F.explode(F.split("flag", "; ")).alias("flag")).where("flag IN ('low', 'stale')")
    return flags.groupBy("bank_id", "flag").agg(F.array_join(F.array_sort(F.collect_list("year")).cast("array<string>"), ",").alias("years"))


def fill_rates(rows: DataFrame, key: str, fields: list[str], either: dict[str, list[str]] | None = None, zero: str | None = None) -> DataFrame:
    """Rows per key, filled rows per field, per group of alternatives, and zeros of one field: one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(filled(f)).alias(f"n_{f}") for f in fields]]
    for name, cols in (either or {}).items():
        test = F.lit(False)
        for c in cols:
            test = test | filled(c)
        aggs.append(F.count_if(test).alias(f"n_{name}"))
    if zero:
        aggs.append(F.count_if(F.col(zero) == 0).alias(f"zero_{zero}"))
    return rows.groupBy(key).agg(*aggs)


def note_frequency(rows: DataFrame, column: str, order: str) -> DataFrame:
    """Whole notes by frequency, ties by first appearance."""
    return rows.where(filled(column)).groupBy(F.col(column).alias("note")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_row")).orderBy(F.desc("n"), "first_row")


def count_checks(official: DataFrame, ours: DataFrame, first: int, last: int, threshold: float) -> DataFrame:
    """Per bank and year: official and own rows, their ratio and whether it reaches the threshold."""
    a = official.where(F.col("year").between(first, last)).groupBy("bank_id", "year").agg(F.count(F.lit(1)).alias("official"))
    b = ours.groupBy("bank_id", "year").agg(F.count(F.lit(1)).alias("ours"))
    spine = official.select("bank_id").distinct().withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    df = spine.join(a, ["bank_id", "year"], "left").join(b, ["bank_id", "year"], "left").na.fill(0, ["official", "ours"])
    ratio = F.try_divide(F.col("ours").cast("double"), F.col("official"))
    return df.select("bank_id", "year", "official", "ours", F.bround(ratio, 3).alias("ratio"), F.when(ratio.isNull() | (ratio >= threshold), "pass").otherwise("fail").alias("status"))


def visibility_checks(official: DataFrame, ours: DataFrame, fields: list[str], tolerance: float = 0.05) -> DataFrame:
    """Fill share of each field, official against own rows.

    Own rows are those with an official id where these are at least half as many as the official rows,
    else all own rows; both sums come from one pass, the choice is made on the sums.
    """
    ids = official.select("bank_id", F.lower("project_id").alias("__id")).distinct().withColumn("__m", F.lit(1))
    marked = ours.withColumn("__id", F.lower("project_id")).join(ids, ["bank_id", "__id"], "left")
    sums = [F.count_if(filled(f)).alias(f"a_{f}") for f in fields] + [F.count_if(filled(f) & (F.col("__m") == 1)).alias(f"m_{f}") for f in fields]
    own = marked.groupBy("bank_id").agg(F.count(F.lit(1)).alias("a"), F.count("__m").alias("m"), *sums)
    off = official.groupBy("bank_id").agg(F.count(F.lit(1)).alias("o"), *[F.count_if(filled(f)).alias(f"o_{f}") for f in fields])
    half = F.col("m") * 2 >= F.col("o")
    rows = F.array(*[F.struct(F.lit(f).alias("field"), (F.col(f"o_{f}") / F.col("o")).alias("x"), F.when(half, F.col(f"m_{f}") / F.col("m")).otherwise(F.col(f"a_{f}") / F.col("a")).alias("y")) for f in fields])
    df = off.join(own, "bank_id").select("bank_id", F.explode(rows).alias("c")).select("bank_id", "c.*")
    return df.select("bank_id", "field", F.bround("x", 3).alias("official"), F.bround("y", 3).alias("ours"), F.when(F.col("y") >= F.col("x") - tolerance, "pass").otherwise("fail").alias("status"))


def amount_checks(official: DataFrame, ours: DataFrame, first: int, last: int, share: float = 0.98) -> DataFrame:
    """Per bank, year and currency: official total against ours."""

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("loan_amount").isNotNull() & filled("loan_currency")).groupBy("bank_id", "year", "loan_currency").agg(F.sum("loan_amount").alias(name))

    df = totals(official, "__o").where(F.col("year").between(first, last) & (F.col("__o") != 0)).join(totals(ours, "__u"), ["bank_id", "year", "loan_currency"], "left")
    o, u = F.col("__o").cast("double"), F.coalesce(F.col("__u").cast("double"), F.lit(0.0))
    return df.select("bank_id", "year", "loan_currency", F.round(o, 0).alias("official"), F.round(u, 0).alias("ours"), F.bround(u / o, 3).alias("ratio"), F.when(u / o >= share, "pass").otherwise("fail").alias("status"))


def status_pivot(checks: DataFrame) -> DataFrame:
    """Statuses counted per bank, one column each."""
    return checks.groupBy("bank_id").pivot("status", ["pass", "fail"]).count().na.fill(0)


def conflicting_totals(a: DataFrame, b: DataFrame, value: str, tolerance: float = 0.01) -> DataFrame:
    """Keys (bank_id, year) whose sums differ between two tables: a full outer check that nothing was lost."""
    x = a.groupBy("bank_id", "year").agg(F.sum(value).alias("left_sum"))
    y = b.groupBy("bank_id", "year").agg(F.sum(value).alias("right_sum"))
    return x.join(y, ["bank_id", "year"], "full_outer").where(~F.coalesce(F.abs(F.col("left_sum") - F.col("right_sum")) <= tolerance, F.lit(False)))
