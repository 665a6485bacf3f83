"""Activity files: transactions, dates, funders and counterparts from nested columns, without Python.

``ACTIVITY`` is the schema for ``spark.read.format("xml").option("rowTag", "iati-activity")``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ACTIVITY = """
`_default-currency` string, `iati-identifier` string,
`reporting-org` struct<_ref: string, narrative: string>,
`title` struct<narrative: string>,
`participating-org` array<struct<_role: string, _ref: string, _type: string, narrative: string>>,
`recipient-country` array<struct<_code: string>>,
`activity-status` struct<_code: string>,
`activity-date` array<struct<`_iso-date`: string, _type: string>>,
`transaction` array<struct<`transaction-type`: struct<_code: string>, `transaction-date`: struct<`_iso-date`: string>, value: struct<_VALUE: string, _currency: string>>>
"""
# Codes of transaction, date and role types, and organisation types by sector.
COMMITMENT, DISBURSEMENT = "2", "3"
START_DATES, END_DATES = ["2", "1"], ["4", "3"]
FUNDING, IMPLEMENTING = "1", "4"
PUBLIC_TYPES, PRIVATE_TYPES = ["10", "11", "15"], ["70", "71", "72", "73"]


def read_activities(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "iati-activity").schema(ACTIVITY).load(path)


def transactions(df: DataFrame) -> DataFrame:
    """Add commitment (first), disbursed (positive sum), corrections (negative sum), currency and dates."""
    amount = lambda t: F.trim(t["value"]["_VALUE"]).try_cast("decimal(28,4)")
    stated = F.filter("transaction", lambda t: F.coalesce(F.trim(t["value"]["_VALUE"]) != "", F.lit(False)))
    kind = lambda code: F.filter(stated, lambda t: t["transaction-type"]["_code"] == code)
    currency = lambda t: F.coalesce(F.nullif(t["value"]["_currency"], F.lit("")), F.col("`_default-currency`"))
    first = F.get(kind(COMMITMENT), 0)
    paid = F.filter(kind(DISBURSEMENT), lambda t: F.coalesce(amount(t) >= 0, F.lit(False)))
    back = F.filter(kind(DISBURSEMENT), lambda t: amount(t) < 0)
    total = lambda ts: F.aggregate(ts, F.lit(0).cast("decimal(28,4)"), lambda acc, t: (acc + amount(t)).cast("decimal(28,4)"))
    days = F.filter(F.transform(paid, lambda t: t["transaction-date"]["_iso-date"]), lambda d: F.coalesce(d != "", F.lit(False)))
    return df.withColumns(
        {
            "commitment": amount(first),
            "commitment_currency": F.when(first.isNotNull(), currency(first)),
            "commitment_date": first["transaction-date"]["_iso-date"],
            "disbursed": F.when(F.size(paid) > 0, total(paid)),
            "disbursed_currency": F.get(F.array_compact(F.transform(paid, currency)), 0),
            "corrections": F.when(F.size(back) > 0, total(back)),
            "first_disbursement": F.array_min(days),
            "last_disbursement": F.array_max(days),
        }
    )


def _date(codes: list[str]) -> Column:
    def of(code: str) -> Column:
        return F.get(F.filter("activity-date", lambda d: (d["_type"] == code) & (d["_iso-date"] != "")), 0)["_iso-date"]

    found = [of(c) for c in codes]
    planned = found[0].isNull() & found[1].isNotNull()
    return F.struct(F.coalesce(*found).alias("day"), planned.cast("int").alias("planned"))


def dates(df: DataFrame) -> DataFrame:
    """Add start and end: the actual day, else the planned one, with a flag for planned."""
    return df.withColumns({"start": _date(START_DATES), "end": _date(END_DATES)}).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("start.day").alias("start_date"), F.col("start.planned").alias("start_planned"), F.col("end.day").alias("end_date"), F.col("end.planned").alias("end_planned"),
    )


def funders(df: DataFrame, own_windows: list[str]) -> DataFrame:
    """Add partners (external funders in order) and windows (the bank's own, sorted).

    A funder whose reference is a known window is one, even if it is the reporting bank's own reference;
    a funder under the bank's reference with another name is a window too; the bank itself is neither.
    """
    me, ref = F.lower(F.trim(F.col("`reporting-org`.narrative"))), F.trim(F.col("`reporting-org`._ref"))
    name = lambda o: F.coalesce(F.nullif(F.trim(o["narrative"]), F.lit("")), F.nullif(F.trim(o["_ref"]), F.lit("")))
    orgs = F.filter("participating-org", lambda o: (o["_role"] == FUNDING) & name(o).isNotNull())
    known = lambda o: F.coalesce(F.trim(o["_ref"]).isin(own_windows), F.lit(False)) if own_windows else F.lit(False)
    by_ref = lambda o: F.coalesce((F.trim(o["_ref"]) == ref) & (ref != ""), F.lit(False))
    by_name = lambda o: F.coalesce(F.lower(name(o)) == me, F.lit(False))
    window = lambda o: known(o) | (by_ref(o) & ~by_name(o))
    return df.withColumns(
        {
            "partners": F.array_distinct(F.transform(F.filter(orgs, lambda o: ~window(o) & ~by_ref(o) & ~by_name(o)), name)),
            "windows": F.array_sort(F.array_distinct(F.transform(F.filter(orgs, window), name))),
        }
    )


def counterpart(df: DataFrame) -> DataFrame:
    """Add the sector of the first implementing organisation whose type tells it."""
    told = F.filter("participating-org", lambda o: (o["_role"] == IMPLEMENTING) & o["_type"].isin(PUBLIC_TYPES + PRIVATE_TYPES))
    first = F.get(told, 0)["_type"]
    return df.withColumn("counterpart", F.when(first.isin(PUBLIC_TYPES), "Government").when(first.isin(PRIVATE_TYPES), "Private Sector"))
