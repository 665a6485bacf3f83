"""Queries p2-p5: units, packed cells, quality profile, schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.core.tables import load, shared_path
from fundlens.operators import drift, packed, quality, units


def p2_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's amount in single units of one currency, with what told the scale."""
    rows = load(spark, sf_dir, "project_records").select(
        "row_id", "loan_amount", "loan_currency", "data_quality_notes", "official_source_id", "loan_amount_usd",
        "total_commitment", "commitment_currency", "approval_year", "commitment_year",
    )
    return units.to_single_units(rows, load(spark, sf_dir, "fx_rates"), load(spark, sf_dir, "official_sources")).select(
        "row_id", "loan_amount", "exp10", "currency", "single_amount", "unit_basis"
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_converted(spark, sf_dir).where("exp10 <> 0").select("row_id", "exp10", "currency")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    partners = packed.split_cells(
        load(spark, sf_dir, "project_records").select("row_id", "cofinancing_partners"), "row_id", "cofinancing_partners"
    ).where("n_items >= 2")
    codes = packed.split_codes(
        load(spark, sf_dir, "afdb_projects").select("rec_no", "country_codes"),
        "rec_no",
        "country_codes",
        load(spark, sf_dir, "ref_countries").select("iso2"),
    ).where("n_items >= 2")
    cols = ["row_key", "pos", "item"]
    return (
        partners.select(F.lit("cofinancing_partners").alias("field_name"), *cols)
        .unionByName(codes.select(F.lit("country_codes").alias("field_name"), *cols))
    )


_P4_COLUMNS = {"loan_amount": "amount", "province": "text", "total_disbursement": "amount"}


def _p4_store(spark: SparkSession, sf_dir: str) -> quality.ValueCountStore:
    """Value-count tables in the shared folder, with the delta of every load applied."""
    rows = load(spark, sf_dir, "project_records").select("load_no", *_P4_COLUMNS)
    store = quality.ValueCountStore(spark, shared_path(spark, "value-counts"), "load_no")
    store.apply(quality.value_counts(rows, "load_no", _P4_COLUMNS))
    return store


def p4_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact metrics and entropy of every load and column, from the kept counts."""
    return quality.profile(_p4_store(spark, sf_dir).state(), "load_no")


def p4_withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile after the newest load was taken back by a delta of the other sign."""
    store = _p4_store(spark, sf_dir)
    rows = load(spark, sf_dir, "project_records").select("load_no", *_P4_COLUMNS)
    newest = rows.agg(F.max("load_no").alias("load_no"))
    store.apply(quality.value_counts(rows.join(newest, "load_no", "left_semi"), "load_no", _P4_COLUMNS, sign=-1))
    return quality.profile(store.fold().state(), "load_no")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.findings(p4_profile(spark, sf_dir), "load_no")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(load(spark, sf_dir, "raw_rows"), load(spark, sf_dir, "raw_files"))


def p5_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files as one typed table, with the fields that could not be cast."""
    return drift.consistent_table(load(spark, sf_dir, "raw_rows"), load(spark, sf_dir, "raw_files"))


QUERIES = {
    "p2_found": p2_found,
    "p2_converted": p2_converted,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_profile": p4_profile,
    "p4_withdrawn": p4_withdrawn,
    "p5_found": p5_found,
    "p5_table": p5_table,
}
