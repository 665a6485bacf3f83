"""Canonical records: defaults, scope, notes and constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.text import fingerprint

NOT_NEGATIVE = ["loan_amount", "loan_amount_usd", "total_commitment", "cofinancing_amount"]


def problems(df: DataFrame, instruments: list[str] | None = None) -> Column:
    """An array of what is wrong with a record; empty if nothing. Negative disbursements are lawful refunds."""

    def bad(test: Column, message: str) -> Column:
        return F.when(F.coalesce(test, F.lit(False)), F.lit(message))

    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    tests = [bad(blank(c), f"{c} is missing") for c in ("bank_id", "project_id", "project_name", "project_url") if c in df.columns]
    tests += [bad(~F.col(c).between(1900, 2200), f"{c} is out of range") for c in ("approval_year", "commitment_year") if c in df.columns]
    tests += [bad(~F.col("latitude").between(-90, 90), "latitude is out of range"), bad(~F.col("longitude").between(-180, 180), "longitude is out of range")]
    tests += [bad(F.col(c) < 0, f"{c} is negative") for c in NOT_NEGATIVE if c in df.columns]
    if instruments and "instrument" in df.columns:
        tests.append(bad(~F.col("instrument").isin(instruments), "instrument is unknown"))
    return F.array_compact(F.array(*tests))


def split_valid(df: DataFrame, instruments: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid records, and rejects with their ``problems``; one scan each, both from the same expression."""
    marked = df.withColumn("problems", problems(df, instruments))
    return marked.where(F.size("problems") == 0).drop("problems"), marked.where(F.size("problems") > 0)


def require(df: DataFrame, instruments: list[str] | None = None) -> DataFrame:
    """The records; the first bad one fails the job with its problems."""
    p = problems(df, instruments)
    return df.where(F.when(F.size(p) > 0, F.raise_error(F.array_join(p, "; ")).cast("boolean")).otherwise(F.lit(True)))


def not_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def finalize(df: DataFrame, first: int | None = None, last: int | None = None, pipeline: tuple[str, ...] = ("pipeline", "proposed", "under appraisal", "planned")) -> DataFrame:
    """Ids where missing, years from dates, commitment from the loan, pipeline flag, scope of years and notes.

    A row without a year stays in a scope that has a first year, with a note.
    """
    year = F.coalesce("approval_year", F.year(F.col("approval_date").try_cast("date")), "commitment_year")
    no_id = F.col("project_id").isNull() | (F.trim("project_id") == "")
    copied = F.col("total_commitment").isNull() & F.col("loan_amount").isNotNull()
    notes = F.array_compact(
        F.array(
            F.when(F.trim("data_quality_notes") != "", F.col("data_quality_notes")),
            F.when(copied, F.lit("commitment copied from loan amount")),
            F.when(no_id, F.lit("id made from name, country and year")),
            F.when(year.isNull() & F.lit(first is not None), F.lit("year unknown, kept")),
        )
    )
    out = df.withColumns(
        {
            "project_id": F.when(no_id, F.concat(F.lit("made-"), fingerprint([F.col("bank_id"), F.col("project_name"), F.col("country"), year]))).otherwise(F.col("project_id")),
            "approval_year": year,
            "total_commitment": F.coalesce("total_commitment", "loan_amount"),
            "commitment_currency": F.when(copied, F.col("loan_currency")).otherwise(F.col("commitment_currency")),
            "pipeline_stage": F.coalesce("pipeline_stage", F.lower("status").isin(*pipeline).cast("tinyint")),
            "data_quality_notes": F.nullif(F.array_join(F.array_distinct(notes), "; "), F.lit("")),
        }
    )
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col("approval_year").isNull() | (F.col("approval_year") >= first))
    if last is not None:
        keep = keep & (F.col("approval_year").isNull() | (F.col("approval_year") <= last))
    return out.where(keep)


def credible(score: list[Column], url_fits: Column) -> Column:
    """Whether enough tests speak for a record: two, or one if its address looks like a project's."""
    total = sum((F.coalesce(s, F.lit(False)).cast("int") for s in score), F.lit(0))
    return (total >= 2) | ((total >= 1) & F.coalesce(url_fits, F.lit(False)))
