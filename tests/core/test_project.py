"""Projection of delivered rows to canonical records."""

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from fundlens.operators import project

COUNTRIES = [("AA", "AAX", "Aland", ["Aa Land"]), ("BB", "BBX", "Bland", [])]


def _lists(spark):
    return project.CodeLists(
        countries=spark.createDataFrame(COUNTRIES, "iso2 string, iso3 string, country_name string, alt_names array<string>"),
        regions=spark.createDataFrame([("298", "Africa"), ("298", "Zfrica")], "code string, name string"),
        statuses=spark.createDataFrame([("2", "Implementation")], "code string, name string"),
        finance_types=spark.createDataFrame([("421", "Standard loan")], "code string, name string"),
        sector_names=spark.createDataFrame([("21020", "Road transport")], "code string, name string"),
        sectors=(spark.createDataFrame([("Road transport", "Transport")], "key string, value string"),),
    )


def test_fields_fall_back_per_row(spark):
    rows = spark.createDataFrame(
        [
            ("1", "n/a", "Road", "Aa land", None, "12.5 million", "EUR", "x; BNK;y", "31/12/2020", "own"),
            ("2", "Bridge", "other", None, "bb", "7", None, "BNK", "2019", None),
            (None, None, "", None, None, None, None, None, None, None),
        ],
        "id string, project_name string, title string, country string, country_code string, loan_amount_x string, currency string, partners string, board_date string, note string",
    )
    layout = project.Layout(aliases={"loan_amount": ["loan_amount_x"], "cofinancing_partners": ["partners"]}, day_first=True, own_names=("bnk",))
    got = project.canonical(rows, layout, _lists(spark), keep=("note",)).collect()
    assert [(r["project_id"], r["project_name"], r["country"], r["country_code"]) for r in got] == [("1", "Road", "Aa land", "AAX"), ("2", "Bridge", "Bland", "BBX"), (None, None, None, None)]
    assert [(r["loan_amount"], r["loan_currency"], r["loan_amount_usd"], r["total_commitment"], r["commitment_currency"]) for r in got] == [
        (D("12500000"), "EUR", None, D("12500000"), "EUR"), (D("7"), None, None, D("7"), None), (None,) * 5,
    ]
    assert [(r["approval_date"], r["approval_year"], r["commitment_date"], r["cofinancing_partners"]) for r in got] == [
        (date(2020, 12, 31), 2020, date(2020, 12, 31), "x; y"), (date(2019, 1, 1), 2019, date(2019, 1, 1), None), (None,) * 4,
    ]
    assert "country named by code bb" in got[1]["data_quality_notes"] and got[0]["note"] == "own" and got[2]["data_quality_notes"] is None
    assert project.named(project.canonical(rows, layout)).count() == 2 and project.canonical(rows.limit(0), layout, _lists(spark)).count() == 0


def test_codes_windows_and_notes(spark):
    cols = "project_name string, recipient_region_code string, activity_status_code string, sector_code string, default_finance_type_code string, default_flow_type_code string, iati_funding_window string, iati_funding_window_ref string, iati_commitment_value string, iati_commitment_currency string, _source_note string"
    rows = [("a", "298", "2", "21020", "421", "10", "Fund", "W-1", "5.000", "USD", "from x"), ("b", None, "9", "1", None, "20", None, None, None, None, None), ("c", None, None, None, "110", "20", "Other", "W-9", None, None, None), ("d", None, None, None, None, None, "Fund; Ord", "W-1; W-2", None, None, None)]
    layout = project.Layout(soft=("w-1",), hard=("W-2",), soft_flows=("10",), hard_flows=("20",), grant="110", dot_is_decimal=True)
    got = project.canonical(spark.createDataFrame(rows, cols), layout, _lists(spark)).collect()
    assert [(r["country"], r["status"], r["sector"], r["sector_category"], r["financing_instrument"]) for r in got][:2] == [("Africa", "Implementation", "Road transport", "Transport", "Standard loan"), (None,) * 5]
    assert [(r["concessional"], r["concessional_flag"]) for r in got] == [("Yes", 1), ("No", 0), ("Yes", 1), ("Blended", None)]
    assert got[0]["loan_amount"] == got[0]["loan_amount_usd"] == D("5") and all(n in got[0]["data_quality_notes"] for n in ("a region, not a country", "status named", "sector named", "instrument named", "no country code for Africa", "from x"))


def test_json_rows(spark):
    rows = spark.createDataFrame([(0, '{"projectTitle": "A", "sectors": ["X", "x", "Y"], "who": {"a": "P", "b": null}, "amountAgreed USD": 5}'), (1, '{"projectTitle": null}'), (2, "broken"), (3, None)], "_ord long, row string")
    df = project.json_columns(rows)
    assert set(df.columns) == {"_ord", "project_title", "sectors", "who", "amount_agreed_usd"} and df.count() == 4
    got = project.canonical(df, project.Layout(aliases={"loan_amount": ["amount_agreed_usd"], "cofinancing_partners": ["who"]}), keep=("_ord",)).orderBy("_ord").collect()
    assert (got[0]["project_name"], got[0]["sector"], got[0]["cofinancing_partners"], got[0]["loan_amount_usd"]) == ("A", "X; Y", "P", D("5")) and got[1]["project_name"] is None
    assert project.json_columns(rows.limit(0)).columns == ["_ord"]


def test_parts_of_records(spark):
    recs = project.canonical(spark.createDataFrame([("1", "A", "Aland", "2020-01-01", "2021-01-01", "credit"), ("2", "B", "Bland", None, None, None)], "id string, name string, country string, signed_date string, end_date string, instrument string"))
    full = project.complete(project.with_constants(recs, {"status": "Signed", "bank_id": "x", "pipeline_stage": 0})).collect()
    assert [(r["status"], r["bank_id"], r["instrument_category"]) for r in full] == [("Signed", "x", "loan"), ("Signed", "x", None)]
    assert float(full[0]["duration_years"]) == 1.002 and "no duration given" not in full[0]["data_quality_notes"] and "no sector given" in full[1]["data_quality_notes"]
    marks = spark.createDataFrame([(2, "ALAND", 9.0, 9.0), (1, "aland ", 1.5, 2.5), (3, None, 0.0, 0.0)], "_ord long, country string, latitude double, longitude double")
    assert sorted((r["project_id"], r["latitude"] and float(r["latitude"])) for r in project.marker_places(recs, marks).collect()) == [("1", 1.5), ("2", None)]
    fan = project.usd_fan_out(recs.withColumn("usd", F.lit("5").cast("double")), "usd").first()
    assert fan["loan_amount"] == fan["total_commitment_usd"] == D("5") and fan["commitment_currency"] == "USD"
    assert spark.range(1).select(project.composed_name([F.lit(" A "), F.lit(None).cast("string"), F.lit("n/a"), F.lit("B")])).first()[0] == "A - B"
    assert spark.range(1).select(project.sector_parts(F.lit('["FY17 - Roads", "Roads", "Water"]'))).first()[0] == "Roads; Water"
    assert project.covered_years(2019, "2021-12-31") == [2019, 2020, 2021] and project.covered_years(2019, "2021-06-30") == [2019, 2020] and project.covered_years(None, "2021-06-30") == []


def test_loans_of_projects(spark):
    loans = spark.createDataFrame([("a", 5.0, None, "1.5", date(2030, 1, 1), date(2001, 1, 1)), ("a", None, 2.0, "1.5", date(2031, 1, 1), None), ("b", None, None, None, None, None), (None, 1.0, 1.0, "9", None, None)], "project_id string, principal double, disbursed double, interest_rate string, last_repayment_date date, board_approval_date date")
    projects = spark.createDataFrame([("a", "Dropped", None), ("b", "Closed", 1.0), ("c", "dropped ", 3.0), ("d", None, 0.0), (None, "Active", 2.0)], "project_id string, status string, arm_amount double")
    got = {r["project_id"]: r for r in project.with_loans(projects, loans).collect()}
    assert (got["a"]["n_loans"], got["a"]["loan_principal"], got["a"]["loan_disbursed"], got["a"]["interest_rates"], got["a"]["single_rate"]) == (2, 5.0, 2.0, "1.5", "1.5")
    assert got["b"]["loan_principal"] is None and got["c"]["n_loans"] == 0
    assert {r["project_id"] for r in project.own_money(project.with_loans(projects, loans)).collect()} == {"a", "b", None}
    parts = spark.createDataFrame([("a", None), ("b", 2.0), ("b", None)], "project_id string, amount double")
    assert {r["project_id"]: r["cofinancing_amount"] for r in project.partner_sum(projects, "project_id", parts).collect()} == {"a": None, "b": 2.0, "c": None, "d": None, None: None}


def test_scope_union_and_counts(spark):
    rows = spark.createDataFrame([(1, 2000), (2, 2010), (3, None)], "row_id long, year int")
    assert [r["row_id"] for r in project.in_scope(rows, "year", 2001, None).collect()] == [2]
    decisions = spark.createDataFrame([(1, "kept-recent"), (2, "excluded")], "row_id long, decision string")
    got = project.merged_and_kept(spark.createDataFrame([(9, 1)], "row_id long, conflict int"), rows, decisions).collect()
    assert {(r["row_id"], r["origin"]) for r in got} == {(9, "official"), (1, "kept-recent")}
    a = spark.createDataFrame([(1, None, "x"), (2, None, None)], "k long, p string, q string")
    b = spark.createDataFrame([(1, "new", "y"), (2, None, "z")], "k long, p string, q string")
    assert {r["field"]: r["n_filled"] for r in project.fill_counts(a, b, "k", ["p", "q"]).collect()} == {"p": 1, "q": 1}
