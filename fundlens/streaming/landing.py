"""Streams, an extension: landed files into an upserted table, and windowed event counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.core.tables import listed
from fundlens.operators.ordered import first_by


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their value per window and kind; late ones are dropped after the watermark."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    g = events.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("w.start").alias("start"), kind, "n", "total")


def upsert(store: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the newest row per key after each batch, as a new version of the table.

    A batch is merged into the newest whole version before it, whatever its number, so batches without rows may
    be left out; a repeated batch writes its version again from the same one.  A version of a later batch means
    that the stream's checkpoint and the table don't belong together, which is an error.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        whole = sorted(int(n[2:]) for n in listed(spark, store) if n.startswith("v=") and "_SUCCESS" in listed(spark, f"{store}/{n}"))
        if whole and whole[-1] > epoch:
            raise ValueError(f"{store} holds batch {whole[-1]}, later than {epoch}: was the checkpoint reset?")
        before = [v for v in whole if v < epoch]
        if before:
            batch = spark.read.parquet(f"{store}/v={before[-1]}").unionByName(batch)
        first_by(batch, [F.col(k) for k in keys], F.struct((-F.unix_micros(F.col(order).cast("timestamp"))).alias("o"))).write.mode("overwrite").parquet(f"{store}/v={epoch}")

    return apply


def landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
