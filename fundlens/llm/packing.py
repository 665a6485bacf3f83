"""Filling fixed-capacity containers: bounded-space online best fit, then a merge of leftovers."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect, materialize

#: Open windows per partition and capacity.
OPEN_WINDOWS = 64
#: Partitions whose leftovers are merged by one task.
MERGED_PARTITIONS = 64
_ROW = "spec_id int, container_id long, {key} long, piece_no int, start_token long, n_tokens long, is_open boolean"


class BestFit:
    """Windows of one capacity: an item goes where the least room is left; at most ``limit`` stay open."""

    def __init__(self, capacity: int, limit: int | None):
        self.capacity, self.limit = capacity, limit
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.items: dict[int, list[tuple]] = {}
        self.made = 0

    def place(self, size: int, item: tuple) -> list[tuple]:
        """Put an item in; returns the items of a window that had to be closed for it."""
        closed: list[tuple] = []
        k = bisect_left(self.room, (size, -1))
        if k < len(self.room):
            room, window = self.room.pop(k)
        else:
            if self.limit is not None and len(self.room) >= self.limit:
                _, full = self.room.pop(0)
                closed = [(full, *i) for i in self.items.pop(full)]
            room, window, self.made = self.capacity, self.made, self.made + 1
            self.items[window] = []
        self.items[window].append(item)
        if room > size:
            insort(self.room, (room - size, window))
        else:
            closed += [(window, *i) for i in self.items.pop(window)]
        return closed

    def rest(self) -> list[tuple]:
        return [(w, *i) for w, items in sorted(self.items.items()) for i in items]


def pack(sizes: DataFrame, specs: DataFrame, *, key: str = "doc_id", size: str = "n_tokens", windows: int = OPEN_WINDOWS) -> DataFrame:
    """(spec_id, container_id, key, piece_no, start_token, n_tokens): where every item goes, per capacity.

    An item up to the capacity is one piece; a larger one is cut into pieces of the capacity and a rest.
    Each partition packs its items online with a fixed number of open windows: an item goes to the window
    with the least sufficient room; when none has room and all are open, the fullest is emitted.  The
    windows left open are taken apart and their pieces packed again, largest first, by one task for every
    ``MERGED_PARTITIONS`` partitions - a number of pieces bounded by windows x partitions x pieces a window
    - so the room lost does not grow with the data.  Items of size null or 0 take no room and get no row;
    repeated rows are packed each time.
    """
    listed = sorted((r["spec_id"], r["capacity_tokens"]) for r in bounded_collect(specs, 1000, "capacities") if (r["capacity_tokens"] or 0) > 0)
    schema = _ROW.format(key=key)
    names = ["spec_id", "container_id", key, "piece_no", "start_token", "n_tokens", "is_open"]

    def online(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        fits = {s: BestFit(c, windows) for s, c in listed}
        for b in batches:
            out: list[tuple] = []
            for doc, n in zip(b[key].tolist(), b[size].tolist(), strict=True):
                for s, c in listed:
                    fit = fits[s]
                    for piece, at in enumerate(range(0, n, c)):
                        m = min(c, n - at)
                        out += [(s, (part << 32) + w, *i, False) for w, *i in fit.place(m, (doc, piece, at, m))]
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame([(s, (part << 32) + w, *i, True) for s, _ in listed for w, *i in fits[s].rest()], columns=names)

    # null and 0 are left out by the packer: a filter here would have the sizes computed twice
    items = sizes.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(size))
    placed = materialize(items.mapInPandas(online, schema))

    def merge(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        spec, block = int(group[0]), int(group[1])
        fit = BestFit(dict(listed)[spec], None)
        out: list[tuple] = []
        pdf = pdf.sort_values(["n_tokens", key, "piece_no"], ascending=[False, True, True])
        for doc, piece, at, n in zip(pdf[key].tolist(), pdf["piece_no"].tolist(), pdf["start_token"].tolist(), pdf["n_tokens"].tolist(), strict=True):
            out += fit.place(n, (doc, piece, at, n))
        out += fit.rest()
        return pd.DataFrame([(spec, -1 - ((block << 32) + w), *i, False) for w, *i in out], columns=names)

    block = F.expr(f"shiftright(container_id, 32) div {MERGED_PARTITIONS}")
    left = placed.where("is_open").withColumn("__block", block).groupBy("spec_id", "__block").applyInPandas(merge, schema)
    return placed.where("NOT is_open").unionByName(left).drop("is_open")


def fill_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, capacity_tokens, n_containers, n_tokens, fill): how full the containers are."""
    per = packed.groupBy("spec_id").agg(F.countDistinct("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return per.join(specs, "spec_id").select(
        "spec_id", "capacity_tokens", "n_containers", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("fill")
    )
