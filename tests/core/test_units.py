import pytest

from fundlens.operators import units

CODES = ("EUR", "QTN", "QRP", "USD", "XDR")


@pytest.mark.parametrize(
    ("text", "exp10", "code"),
    [
        ("USD", 0, "USD"), ("usd ", 0, "USD"), ("US$", 0, "USD"), ("U.S. Dollars", 0, "USD"), ("SDR", 0, "XDR"), ("€", 0, "EUR"),
        ("USD '000", 3, "USD"), ("000 USD", 3, "USD"), ("USDk", 3, "USD"), ("€k", 3, "EUR"), ("k US$", 3, "USD"), ("milliers QTN", 3, "QTN"),
        ("lakhs of QRP", 5, "QRP"), ("Cr. QRP", 7, "QRP"), ("Mio. EUR", 6, "EUR"), ("USD millones", 6, "USD"), ("QTN m.", 6, "QTN"),
        ("Mrd. QTN", 9, "QTN"), ("EUR (minor units)", -2, "EUR"), ("cents USD", -2, "USD"), ("billions (10^9) of USD", 9, "USD"), ("10^6 EUR", 6, "EUR"),
    ],
)
def test_money_units(text, exp10, code):
    u = units.grammar(CODES).parse(text)
    assert (u.exp10, u.dims) == (exp10, ((code, 1),))


@pytest.mark.parametrize("text", [None, "", "unknown", "ZZZ", "??", "x" * 50_000])
def test_not_units(text):
    assert units.grammar(CODES).parse(text) is None


@pytest.mark.parametrize(
    ("text", "power"),
    [
        ("Figures are in thousands.", 3), ("montants en millions; no coordinates disclosed", 6), ("importes en miles de EUR", 3), ("loan amount as printed, '000 USD", 3),
        ("printed in thousands of dollars, already scaled up to single USD", 0), ("source lists amounts in millions; converted to full units here", None),
        ("no coordinates disclosed", None), (None, None), ("Older mirror in full dollars.", 0), ("Loan ledger back to 1970; every money column is in USD '000.", 3),
    ],
)
def test_statements(text, power):
    got = units.grammar(CODES).statement(text)
    assert got == (0 if "converted" in (text or "") else power)


def test_vectors_and_offsets():
    value, unit = units.parse_quantity("12 km/h", CODES)
    assert value == pytest.approx(12_000 / 3600) and unit.dims == (("L", 1), ("T", -1))
    assert units.parse_quantity("68 degF", CODES)[0] == pytest.approx(293.15)
    assert units.parse_quantity("1.234,5 kg", CODES)[0] == pytest.approx(1234.5)
    assert units.parse_quantity("3 ha", CODES)[1].dims == units.parse_quantity("2 m^2", CODES)[1].dims
    assert units.parse_quantity("none", CODES) is None


_SCHEMA = "row_id long, loan_amount decimal(22,4), loan_currency string, data_quality_notes string, official_source_id string, loan_amount_usd decimal(22,4), total_commitment decimal(22,4), commitment_currency string, approval_year int, commitment_year int, exp10 string"


def _run(spark, rows):
    fx = spark.createDataFrame([("EUR", 2010, 0.8), ("EUR", 2011, 0.9)], "series_code string, fx_year int, units_per_usd double")
    src = spark.createDataFrame([("ledger", "every money column is in USD '000."), ("plain", None)], "source_id string, scope_note string")
    df = spark.createDataFrame(rows, _SCHEMA)
    return {r["row_id"]: r for r in units.to_single_units(df, fx, src).collect()}


def test_to_single_units(spark):
    from decimal import Decimal as D

    got = _run(
        spark,
        [
            (1, D("5"), "USD million", None, None, None, None, None, None, None, "clash"),
            (2, D("5"), "USD", "Figures are in thousands.", None, None, None, None, 2010, None, None),
            (3, D("5"), "USD", None, "ledger", None, None, None, 2010, None, None),
            (4, D("5000000"), "USD", "already scaled up to single USD, printed in thousands", "ledger", None, None, None, 2010, None, None),
            (5, D("8"), "EUR", None, None, D("10000000"), None, None, 2010, None, None),
            (6, D("8"), "EUR", None, None, None, D("13000000"), "USD", None, None, None),
            (7, D("100000000000000"), "USD million", None, None, None, None, None, None, None, None),
            (8, None, "USD million", None, None, None, None, None, None, None, None),
            (9, D("-5"), "USD million", None, None, None, None, None, None, None, None),
            (10, D("5"), None, None, None, None, None, None, None, None, None),
            (11, D("5000000"), "EUR", None, "plain", None, None, None, 2010, None, None),
        ],
    )
    assert [got[k]["exp10"] for k in range(1, 12)] == [6, 3, 3, 0, 6, 6, None, None, None, None, 0]
    assert got[1]["single_amount"] == D("5000000") and got[5]["currency"] == "EUR" and got[3]["unit_basis"] == "source"


def test_empty(spark):
    assert _run(spark, []) == {}


def test_statements_are_parsed():
    g = units.grammar(("EUR", "QTN", "USD"))
    said = {
        "Reported in billions (10^9) of USD": 9, "amounts in EUR thousands; no coordinates": 3, "in 10^5 QTN": 5, "all values in USD m": 6, "values in crores": 7,
        "3 million people reached, amounts in thousand EUR": 3, "10 per cent in 2019": None, "100 USD were paid": None, "k": None, "m": None, "mil": None, "": None, None: None,
        "printed in thousands of dollars, already scaled up to single USD": 0, "no scale stated": None, "of of / (": None, "USD per thousand": -3, "x" * 100_000: None,
    }
    assert {t: g.statement(t) for t in said} == said


def test_lakhs_and_crores_from_figures(spark):
    rows = [(1, 2.5, 250_000.0), (2, 2.5, 25_000_000.0), (3, 2.5, 2_500_000.0), (4, 2.5, 2.4), (5, 2.5, None)]
    df = spark.createDataFrame(
        [(k, a, "USD", None, None, u, None, None, 2010, None) for k, a, u in rows],
        "row_id long, loan_amount double, loan_currency string, data_quality_notes string, official_source_id string, loan_amount_usd double, total_commitment double, commitment_currency string, approval_year int, commitment_year int",
    )
    fx = spark.createDataFrame([("EUR", 2010, 0.8)], "series_code string, fx_year int, units_per_usd double")
    sources = spark.createDataFrame([], "source_id string, scope_note string")
    assert {r["row_id"]: r["exp10"] for r in units.to_single_units(df, fx, sources).collect()} == {1: 5, 2: 7, 3: 6, 4: 0, 5: 0}
