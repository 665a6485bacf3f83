"""Queries of the domain tables on small tables of their own."""

from pyspark.sql import functions as F

from fundlens.operators import theta
from fundlens.plans import domain
from fundlens.sources import official

SOURCES = [("kl", ["kdb"], ["backbone"]), ("ks", ["kdb"], ["supplement"]), ("ws", ["wes"], ["supplement", "extra-fields"])]
COLUMNS = "row_id long, bank_id string, project_id string, official_source_id string, country_code string, approval_year int, province string, completion_date string, financing_instrument string"


def _tables(monkeypatch, spark, rows):
    tables = {
        "project_records": spark.createDataFrame([(*r, *[None] * (9 - len(r))) for r in rows], COLUMNS),
        "official_sources": spark.createDataFrame(SOURCES, "source_id string, bank_ids array<string>, roles array<string>"),
    }
    monkeypatch.setattr(domain, "load", lambda spark, sf_dir, name: tables[name])


def test_supplement_by_whole_ids(spark, monkeypatch):
    rows = [
        (1, "kdb", "11111-001", "kl", "AAA", 2010), (2, "kdb", "22222-001", "kl", "AAA", 2010), (3, "kdb", "33333-002", None, "AAA", 2010),
        (10, "kdb", "22222001", "ks", "AAA", 2010), (11, "kdb", "33333/002", "ks", "AAA", 2012), (12, "kdb", "99999-001", "ks", "AAA", 2010),
        (20, "wes", "P11111111", None, "BBB", 2010), (21, "wes", "p 11111111", "ws", "BBB", 2010), (22, "wes", "22222-001", "ws", "AAA", 2010),
        (23, "kdb", None, "ks", "AAA", 2010), (24, "kdb", "11111-001", "ks", "ZZZ", 2010),
    ]
    _tables(monkeypatch, spark, rows)
    got = {r["id"]: r["project_id"] for r in domain.supplement_attach(spark, "").collect()}
    assert got == {10: 2, 11: 3, 12: None, 21: 20, 22: None, 23: None, 24: None}


def test_extra_fields_by_role(spark, monkeypatch):
    rows = [(1, "wes", "P11111111", None), (2, "wes", "P22222222", None), (3, "wes", "p-11111111", "ws", None, None, "North"), (4, "kdb", "11111111", None)]
    _tables(monkeypatch, spark, rows)
    got = {(r["id"], r["province"], r["matched"]) for r in domain.extra_fields_fill(spark, "").collect()}
    assert got == {(1, "North", 1), (2, None, 0)}


def test_group_by_number_keeps_rows_without(spark, monkeypatch):
    rows = [(1, "kdb", "11111-001", None, None, 2010), (2, "kdb", "11111_001", None, None, 2008), (3, "esc", "11111-001", None, None, 2011), (4, "wes", "P12345678", None, None, 2012), (5, "wes", None, None, None, None)]
    _tables(monkeypatch, spark, rows)
    more = {c: F.lit(None).cast(t) for c, t in {"approval_date": "string", "commitment_date": "string", "loan_amount": "decimal(18,2)", "loan_currency": "string", "total_disbursement": "decimal(18,2)", "disbursement_currency": "string"}.items()}
    wide = domain.load(spark, "", "project_records").withColumns(more)
    monkeypatch.setattr(domain, "load", lambda spark, sf_dir, name: wide)
    got = {(r["bank_id"], r["number"], r["ord"], r["n_records"], r["approval_year"]) for r in domain.group_by_number(spark, "").collect()}
    assert got == {("kdb", "11111-001", 1, 2, 2008), ("esc", "11111-001", 3, 1, 2011), ("wes", None, 4, 1, 2012), ("wes", None, 5, 1, None)}


def test_panel_counts_rows_without_loan_type(spark, monkeypatch):
    kinds = [("AAA", "Non-sovereign"), ("AAA", "Sovereign"), ("AAA", None), ("AAA", None)]
    ops = spark.createDataFrame([("kdb", c, 2010, t, "no-amount", None, None, None, "loan", "Yes") for c, t in kinds], "bank_id string, code string, analysis_year int, loan_type string, conversion string, nominal_cents long, constant_cents long, ppp_constant_cents long, instrument string, concessional string")
    monkeypatch.setattr(domain, "operations", lambda spark, sf_dir: ops)
    got = domain.panel_private_outer(spark, "").collect()
    assert [(r["n_operations"], r["private_n"]) for r in got] == [(3, 1)]


def test_scalars_over_all_rows(spark, monkeypatch):
    amounts = {1: 5.5, 2: 2e9, 3: 0.0, 4: None, 5: 9e14}
    rows = spark.createDataFrame(list(amounts.items()), "row_id long, x double").select("row_id", F.col("x").cast("decimal(20,4)").alias("loan_amount"), F.lit("Caf&eacute; &amp; Road").alias("project_name"))
    monkeypatch.setattr(domain, "load", lambda spark, sf_dir, name: rows)
    got = domain.scalar_amount(spark, "").collect()
    assert {r["row_id"]: r["amount"] for r in got if r["notation"] == "worded"} == {k: None if v is None else (int(v) + 0.25) * 1e6 for k, v in amounts.items()}
    assert len(got) == 6 * len(amounts) and {r["currency"] for r in got if r["row_id"] == 4} == {None}
    assert {r["notation"]: (r["amount"], r["currency"]) for r in got if r["row_id"] == 2} == {
        "worded": (2_000_000_000.25e6, "EUR"), "grouped": (2_000_000_000.5, "USD"), "spanish": (2_000_000_000.5e6, "EUR"),
        "bracketed": (-2e9, "USD"), "unit of account": (2e15, "XDR"), "blanks": (2e9, "GBP"),
    }
    assert {r["folded"] for r in domain.fold_names(spark, "").collect()} == {"cafe & road"}


def test_country_codes_resolve_references(spark, monkeypatch):
    ref = spark.createDataFrame([("CIV", "CI", "Côte d'Amarel", []), ("COL", "CO", "Colmira", [])], "iso3 string, iso2 string, country_name string, alt_names array<string>")
    rows = spark.createDataFrame([(1, "C&ocirc;te d'Amarel"), (2, "C&ocirc;te d'Amarel; Colmira"), (3, None), (4, "A & B")], "row_id long, country string")
    monkeypatch.setattr(domain, "load", lambda spark, sf_dir, name: ref if name == "ref_countries" else rows)
    assert {r["row_id"]: r["code"] for r in domain.country_codes(spark, "").collect()} == {1: "CIV", 2: "CIV", 3: None, 4: None}


def test_single_member(spark):
    names = [("Torvia", "TOR"), ("North Torvia", "NTO"), ("Maluna", "MAL"), ("Both", "A"), ("Both", "B"), ("", "X"), (None, "Y")]
    rows = [(1, "Roads in torvia"), (2, "Roads in North Torvia"), (3, "Maluna and Torvia link"), (4, "Torvian roads"), (5, None), (6, ""), (7, "Both banks"), (8, "Torvia-Torvia"), (9, "x " * 50_000 + "Maluna")]
    got = theta.single_member(spark.createDataFrame(rows, "id int, name string"), "id", "name", names)
    assert {r["id"]: r["member"] for r in got.collect()} == {1: "TOR", 2: "NTO", 8: "TOR", 9: "MAL"}
    assert theta.single_member(spark.createDataFrame(rows, "id int, name string"), "id", "name", []).count() == 0


def test_list_keeps_codes_that_look_like_nothing(spark):
    cols = "rec_no afdb_identifier title country country_codes activity_status approval_date total_commitments_usd total_disbursements_usd afdb_sector afdb_status".split()
    row = ["1", "P-AA-BBB-001", "T", "C", "NA", "Open", "2020-01-02", "5.5", "None", "Roads", "ADF"]
    (got,) = official.group_list(spark.createDataFrame([row], cols)).collect()
    assert (got["country_code"], got["concessional"], got["total_disbursement"]) == ("NA", "Yes", None)
