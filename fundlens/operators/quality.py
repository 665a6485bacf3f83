"""Column quality from maintained value-count tables.

A load contributes, per column, how often each value occurs.  These counts are signed deltas: adding a load
adds them, withdrawing or replacing one subtracts them.  Every metric - null share, distinct values, range,
exact median, pattern violations, entropy - is derived from the counts, never from the rows again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.core.tables import listed

#: Names of places hold letters, space, point, apostrophe and hyphen, and at least one letter.
PLACE_PATTERN = r"^(?=.*\p{L})[\p{L} .'\-]*$"
#: Buckets of an amount by its logarithm: the median is located by bucket and then ranked inside one bucket.
BUCKETS_PER_E = 200


def value_counts(rows: DataFrame, load: str, columns: dict[str, str], sign: int = 1) -> DataFrame:
    """The delta of each load: (``load``, column_name, value, n), counted with map-side aggregation.

    ``columns`` gives each column's kind, ``amount`` or ``text``.  A blank text counts as null.  A hot load
    or value is one partial count per task, so nothing is skewed.
    """
    pairs = []
    for name, kind in columns.items():
        v = F.col(name)
        text = F.when(F.trim(F.regexp_replace(v, r"[\s ]+", " ")) != "", v) if kind == "text" else v.cast("decimal(32,4)").cast("string")
        pairs.append(F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("kind"), text.alias("value")))
    long = rows.select(F.col(load), F.explode(F.array(*pairs)).alias("__c")).select(load, "__c.*")
    return long.groupBy(load, "column_name", "kind", "value").agg((F.count(F.lit(1)) * sign).alias("n"))


class ValueCountStore:
    """The persistent value-count tables: a folder of numbered deltas and states, partitioned by column.

    A delta has a row per load, column and value, as :func:`value_counts` gives; deltas of loads that arrive
    together may be one.  A delta is written whole under its number before it counts, and again over itself if
    the same number is applied twice, so a lost executor or a repeated job leaves the same table.
    """

    def __init__(self, spark: SparkSession, path: str, load: str = "load_no", load_type: str = "int"):
        self.spark, self.path, self.load = spark, path, load
        self.schema = f"`{load}` {load_type}, kind string, value string, n long, column_name string"

    def _parts(self) -> list[str]:
        return [n for n in listed(self.spark, self.path) if n.endswith(("-delta", "-state")) and "_SUCCESS" in listed(self.spark, f"{self.path}/{n}")]

    def _write(self, counts: DataFrame, kind: str, number: int | None) -> None:
        parts = self._parts()
        number = int(parts[-1].split("-")[0]) + 1 if number is None and parts else number or 0
        counts.select(self.load, "kind", "value", F.col("n").cast("long").alias("n"), "column_name").write.mode("overwrite").partitionBy("column_name").parquet(f"{self.path}/{number:09d}-{kind}")

    def apply(self, delta: DataFrame, number: int | None = None) -> None:
        """Keep a delta; a withdrawn load is the same delta with ``sign=-1``. ``number``: its place, the next if left out."""
        self._write(delta, "delta", number)

    def state(self) -> DataFrame:
        """Counts per load, column and value after all deltas; values that cancelled out are gone.

        What came before the last kept state isn't read; a single part needs no aggregation.
        """
        parts = self._parts()
        since = max([k for k, n in enumerate(parts) if n.endswith("-state")], default=0)
        frames = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{n}") for n in parts[since:]]
        if not frames:
            return self.spark.createDataFrame([], self.schema)
        counts = reduce(DataFrame.unionByName, frames)
        if len(frames) > 1:
            counts = counts.groupBy(self.load, "column_name", "kind", "value").agg(F.sum("n").alias("n"))
        return counts.where("n > 0").select(self.load, "column_name", "kind", "value", "n")

    def fold(self) -> "ValueCountStore":
        """Keep the state of now, so that later readers start from it."""
        self._write(self.state(), "state", None)
        return self

    def compact(self, path: str) -> "ValueCountStore":
        """The state as the first state of a store in another folder."""
        other = ValueCountStore(self.spark, path, self.load)
        other.schema = self.schema
        other._write(self.state(), "state", 0)
        return other


def _median(counts: DataFrame, key: list[str]) -> DataFrame:
    """Exact median of the values above zero per key, (key, median).

    Counts are summed by logarithmic bucket first; only the one or two buckets that hold the middle ranks
    are ranked value by value, so that no task sorts all values of a hot load.
    """
    positive = counts.where("kind = 'amount' AND x > 0").withColumn("__b", F.floor(F.log("x") * BUCKETS_PER_E))
    by = W.partitionBy(*key)
    buckets = (
        positive.groupBy(*key, "__b")
        .agg(F.sum("n").alias("__m"))
        .withColumn("__before", F.sum("__m").over(by.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("__before", F.coalesce("__before", F.lit(0)))
        .withColumn("__all", F.sum("__m").over(by))
        .withColumn("__lo", F.expr("(__all + 1) div 2"))
        .withColumn("__hi", F.expr("(__all + 2) div 2"))
        .where("__before < __hi AND __before + __m >= __lo")
    )
    inside = positive.join(buckets, [*key, "__b"]).groupBy(*key, "__b", "x", "__before", "__lo", "__hi").agg(F.sum("n").alias("n"))
    ranked = inside.withColumn("__last", F.col("__before") + F.sum("n").over(W.partitionBy(*key, "__b").orderBy("x").rowsBetween(W.unboundedPreceding, 0)))
    first = F.col("__last") - F.col("n") + 1
    lo = F.max(F.when((first <= F.col("__lo")) & (F.col("__last") >= F.col("__lo")), F.col("x")))
    hi = F.max(F.when((first <= F.col("__hi")) & (F.col("__last") >= F.col("__hi")), F.col("x")))
    return ranked.groupBy(*key).agg(((lo.cast("double") + hi.cast("double")) / 2).alias("median_positive"))


def profile(counts: DataFrame, load: str, pattern: str = PLACE_PATTERN) -> DataFrame:
    """One row of exact metrics per load and column, derived from value counts.

    A load whose column is all null has distinct 0, null range, median and entropy 0.  An empty table gives
    no row.
    """
    key = [load, "column_name"]
    counts = counts.withColumn("x", F.when(F.col("kind") == "amount", F.expr("try_cast(value AS decimal(32,4))")))
    filled: Column = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    bad = F.when((F.col("kind") == "text") & F.col("value").isNotNull() & ~F.col("value").rlike(pattern), F.col("n")).otherwise(0)
    plain = counts.groupBy(*key).agg(
        F.first("kind").alias("kind"),
        F.sum("n").alias("n_rows"),
        F.sum(filled).alias("n_filled"),
        F.count("value").alias("n_distinct"),
        F.min("x").alias("min_value"),
        F.max("x").alias("max_value"),
        F.sum(bad).alias("n_pattern"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n") * F.log2(F.col("n").cast("double")))).alias("__nlogn"),
    )
    entropy = F.when(F.col("n_filled") > 0, F.greatest(F.lit(0.0), F.log2(F.col("n_filled").cast("double")) - F.col("__nlogn") / F.col("n_filled")))
    return (
        plain.join(_median(counts, key), key, "left")
        .withColumn("null_share", 1 - F.col("n_filled") / F.col("n_rows"))
        .withColumn("distinct_per_row", F.col("n_distinct") / F.col("n_rows"))
        .withColumn("pattern_share", F.try_divide(F.col("n_pattern").cast("double"), F.col("n_filled")))
        .withColumn("entropy_bits", F.round(F.coalesce(entropy, F.lit(0.0)), 6))
        .drop("__nlogn")
    )


def findings(
    metrics: DataFrame,
    load: str,
    *,
    null_rate: float = 0.2,
    distinct: float = 2.0,
    shift: float = 3.0,
    high: float = 9e13,
    pattern: float = 0.02,
    not_negative: tuple[str, ...] = ("loan_amount",),
) -> DataFrame:
    """The loads that stand out, (``load``, column_name, finding), each against the next smaller load.

    The window runs over one row per load and column, not over data.  The first load is compared with
    nothing, but its range and pattern are still judged.
    """
    w = W.partitionBy("column_name").orderBy(load)
    m = metrics
    for c in ("null_share", "distinct_per_row", "median_positive"):
        m = m.withColumn(f"__{c}", F.lag(c).over(w))
    amount = F.col("kind") == "amount"
    tests = {
        "null_rate": F.abs(F.col("null_share") - F.col("__null_share")) > null_rate,
        "distinct": (F.col("distinct_per_row") * distinct < F.col("__distinct_per_row")) | (F.col("distinct_per_row") > distinct * F.col("__distinct_per_row")),
        "shift": amount & ((F.col("median_positive") > shift * F.col("__median_positive")) | (F.col("__median_positive") > shift * F.col("median_positive"))),
        "range": amount & ((F.col("max_value") > high) | (F.col("column_name").isin(*not_negative) & (F.col("min_value") < 0))),
        "pattern": F.col("pattern_share") > pattern,
    }
    found = F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))
    return m.select(F.col(load), "column_name", F.explode(found).alias("finding"))
