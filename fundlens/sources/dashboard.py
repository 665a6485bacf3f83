"""Dashboard payloads: length-prefixed JSON segments with dictionary-encoded columns."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def segments(text: str) -> list[dict]:
    """The JSON documents of a ``<length>;<json>`` stream."""
    out, at = [], 0
    while at < len(text):
        mark = text.find(";", at)
        if mark < 0:
            break
        n = int(text[at:mark])
        out.append(json.loads(text[mark + 1 : mark + 1 + n]))
        at = mark + 1 + n
    return out


def decode_column(indices: Column, values: Column, alternates: Column) -> Column:
    """Values by index; a negative index -k is the k-th of the alternate pool; out of range is null."""
    return F.transform(indices, lambda i: F.when(i >= 0, F.get(values, i.cast("int"))).otherwise(F.get(alternates, (-i - 1).cast("int"))))


def zip_rows(columns: dict[str, Column]) -> Column:
    """One struct per row from decoded columns."""
    return F.arrays_zip(*[c.alias(n) for n, c in columns.items()])
