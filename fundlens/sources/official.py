"""Readers of official lists: each turns a delivered layout into canonical columns with expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.dates import extract_year, parse_date, pivot_date
from fundlens.functions.numbers import parse_decimal
from fundlens.functions.text import mojibake, normalize_text
from fundlens.operators.ordered import occurrence_ids

_MONEY = "decimal(22,4)"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def sovereign_projects(df: DataFrame) -> DataFrame:
    """Government-backed projects: a list of approval numbers in one column, dollars with grouping commas."""
    number = F.regexp_extract(_c("Project Number"), r"(\d{5}-\d{3})", 1)
    return df.select(
        "_ord", F.nullif(number, F.lit("")).alias("project_id"), mojibake(normalize_text(_c("Project Name"))).alias("project_name"), normalize_text(_c("Country")).alias("country"),
        parse_date(_c("Approval Date"), day_first=False).alias("approval_date"), parse_decimal(_c("ADB Financing")).cast(_MONEY).alias("loan_amount"), F.lit("USD").alias("loan_currency"),
        normalize_text(_c("Status")).alias("status"),
        # digits only, and not padded with zeros: padded ones are of another series
        F.filter(F.regexp_extract_all(F.coalesce(_c("Approval Number"), F.lit("")), F.lit(r"(?<!\d)(\d+)(?!\d)"), F.lit(1)), lambda n: ~n.startswith("0")).alias("numbers"),
    )


def loan_statement(df: DataFrame) -> DataFrame:
    """A ledger of loans in thousands with two-digit years from 1960 on."""
    return df.select(
        "_ord", F.regexp_extract(_c("Loan No."), r"(\d+)", 1).alias("number"), normalize_text(_c("Title")).alias("project_name"), _c("ISO Country Code").alias("country_code"),
        pivot_date(_c("Approval Date")).alias("approval_date"), (parse_decimal(_c("Amount")) * 1000).cast(_MONEY).alias("loan_amount"), normalize_text(_c("Fund")).alias("window"),
        normalize_text(_c("Interest Rate")).alias("interest_rate"), pivot_date(_c("Last Repayment")).alias("last_date"),
    )


# What a window means for terms.
WINDOW_TERMS = {"ADB": "No", "ADF": "Yes", "BLEND": "Blended"}


def group_list(df: DataFrame) -> DataFrame:
    """The list in the layout of ``afdb_projects``; the word None means null; a single code is the country's.

    Codes are read from the cell as it is: ``NA`` is a lawful code, not a word for nothing.
    """
    word = lambda name: F.when(F.trim(_c(name)) != "None", normalize_text(_c(name)))
    codes = F.regexp_extract_all(F.upper(F.coalesce(F.when(F.trim(_c("country_codes")) != "None", _c("country_codes")), F.lit(""))), F.lit(r"([A-Z0-9]{2})"), F.lit(1))
    window = F.upper(word("afdb_status"))
    terms = F.lit(None).cast("string")
    for w, t in WINDOW_TERMS.items():
        terms = F.when(window == w, F.lit(t)).otherwise(terms)
    return df.select(
        "rec_no", F.regexp_extract(F.upper(F.coalesce(word("afdb_identifier"), F.lit(""))), r"(P-[A-Z0-9]{2}-[A-Z0-9]{3}-\d{3})", 1).alias("project_id"), word("title").alias("project_name"),
        F.when(F.size(codes) == 1, F.get(codes, 0)).alias("country_code"), word("country").alias("country"), parse_date(word("approval_date"), day_first=False).alias("approval_date"),
        parse_decimal(word("total_commitments_usd")).cast(_MONEY).alias("loan_amount"), F.lit("USD").alias("loan_currency"), parse_decimal(word("total_disbursements_usd")).cast(_MONEY).alias("total_disbursement"),
        word("activity_status").alias("status"), terms.alias("concessional"), word("afdb_sector").alias("sector"),
    )


def approvals(df: DataFrame, order: str = "list_id") -> DataFrame:
    """A list without ids, in millions: ids from a fingerprint, repeats numbered."""
    out = df.select(
        order, normalize_text(F.col("economy")).alias("country"), normalize_text(F.col("project_name")).alias("project_name"),
        (F.col("us_million").cast("decimal(18,6)") * 1_000_000).cast(_MONEY).alias("loan_amount"), F.lit("USD").alias("loan_currency"), extract_year(F.col("approval_year")).alias("approval_year"), F.col("mode_of_finance").alias("financing_instrument"),
    )
    return occurrence_ids(out, ["country", "project_name", "approval_year", "loan_amount"], order, "approval-")


def export_arms(projects: DataFrame, locations: DataFrame) -> DataFrame:
    """A dashboard export of two sheets: coordinates only where a project has exactly one location, and one row
    per lending arm with a positive amount; dropped and pipeline projects are left out."""
    place = locations.groupBy("project_id").agg(F.count(F.lit(1)).alias("n"), F.first("latitude").alias("latitude"), F.first("longitude").alias("longitude")).where("n = 1").drop("n")
    kept = projects.where(~F.coalesce(F.lower("status").rlike("drop|pipeline"), F.lit(False)))
    arms = kept.unpivot([c for c in kept.columns if c not in ("ibrd_amount", "ida_amount")], ["ibrd_amount", "ida_amount"], "arm", "loan_amount")
    return arms.withColumn("arm", F.regexp_replace("arm", "_amount$", "")).where("loan_amount > 0").join(place, "project_id", "left")


def cards(text: DataFrame, column: str = "value") -> DataFrame:
    """Project cards of a printed list, landed as text: (name, country, amount) blocks between blank lines."""
    block = F.explode(F.split(F.regexp_replace(column, "\r\n?", "\n"), r"\n\s*\n")).alias("card")
    got = text.select(block).select(
        F.trim(F.regexp_extract("card", r"^\s*([^\n]+)", 1)).alias("project_name"), F.trim(F.regexp_extract("card", r"(?i)(?:member|country):\s*([^\n]+)", 1)).alias("country"),
        parse_decimal(F.regexp_extract("card", r"(?i)(?:amount|financing):\s*([^\n]+)", 1)).cast(_MONEY).alias("loan_amount"), F.trim(F.regexp_extract("card", r"(?i)status:\s*([^\n]+)", 1)).alias("status"),
    )
    return got.where("country <> ''")


def positional(df: DataFrame, column: str) -> DataFrame:
    """[status, day, approved, signed] by position: the approved amount unless zero or missing, else the signed one."""
    at = lambda k: F.get(F.col(column), k)
    amount = lambda k: F.nullif(at(k).try_cast(_MONEY), F.lit(0).cast(_MONEY))
    return df.withColumns({"status": at(0), "approval_date": parse_date(at(1), day_first=True), "loan_amount": F.coalesce(amount(2), amount(3))})
