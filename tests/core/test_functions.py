from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlens.functions import dates, money, numbers, text


def _one(spark, fn, *values):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in rows.select(fn(F.col("v"))).collect()]


def test_text(spark):
    assert _one(spark, text.normalize_text, "  a\xa0 &amp;\n b ", "N/A", "--", None, "none", "x") == ["a & b", None, None, None, None, "x"]
    assert _one(spark, text.ascii_fold, "Crédito nº ﬁn", "plain") == ["Credito no fin", "plain"]
    assert text.normalized_key("Projectó NameID (US$)") == "projecto_name_id_us" and text.normalized_key("approvalDate") == "approval_date"
    assert _one(spark, text.loan_type, "Nonsovereign", "NSG", "Quasi-Sovereign", "Public sector", "con garantía soberana", "Other") == ["Non-sovereign", "Non-sovereign", "Quasi-sovereign", "Sovereign", "Sovereign", "Other"]
    assert _one(spark, lambda c: text.instrument_category(c), "Technical Assistance Loan", "Grant | Loan", "Donación", "Murabaha", "Equity", "ITFC trade", "Security", "securities", "") == ["loan", "loan", "grant", "loan", "equity", "trade_finance", None, "other", None]
    assert _one(spark, text.mojibake, "CÃ³rdoba", "plain", "São") == ["Córdoba", "plain", "São"]
    assert _one(spark, text.loan_numbers, "46904-LN0123, ln45") == [["123", "45"]]
    df = spark.createDataFrame([(["b", "A ", "a", None, "n/a", "C"],)], "v array<string>")
    assert df.select(text.join_values(F.col("v"))).first()[0] == "b; A; C"


def test_concessionality(spark):
    df = spark.createDataFrame([(["adf"], "20", None), (["adb", "adf"], None, None), (["x"], "10", "110"), (["x"], "10", None), ([], "10", None), ([], "20", None), ([], None, None)], "w array<string>, flow string, fin string")
    got = [r[0] for r in df.select(text.concessionality(F.col("w"), F.col("flow"), F.col("fin"), ["adf"], ["adb"], ["10"], ["20"], "110")).collect()]
    assert got == ["Yes", "Blended", "Yes", None, "Yes", "No", None]


@pytest.mark.parametrize(
    ("value", "amount", "currency"),
    [
        ("USD 12.5 million", D("12500000"), "USD"), ("€ 1.234.567,89", D("1234567.89"), "EUR"), ("(1,500)", D("-1500"), None), ("RMB 1.448 billion", D("1448000000"), "CNY"),
        ("1.448 millones", D("1448000000"), None), ("10 mil", D("10000"), None), ("1,5", D("1.5"), None), ("1.500", D("1500"), None), ("12.34", D("12.34"), None), ("TBC", None, None), ("n/a", None, None),
        ("3 SDR", D("3"), "XDR"), ("5 IDA", D("5"), None), ("US$ 2bn", D("2000000000"), "USD"),
    ],
)
def test_amounts(spark, value, amount, currency):
    got = _one(spark, numbers.parse_amount, value)[0]
    assert (got["amount"], got["currency"]) == (amount, currency)


def test_coordinates(spark):
    assert _one(spark, numbers.parse_coordinate, "12.345", "-7,25 N", "none", None) == [D("12.345"), D("-7.25"), None, None]


@pytest.mark.parametrize(
    ("value", "order", "want"),
    [
        ("2020-03-05", None, "2020-03-05"), ("2020-03-05T10:00:00Z", None, "2020-03-05"), ("5 March 2020", None, "2020-03-05"), ("March 5, 2020", None, "2020-03-05"), ("October 15,2020", None, "2020-10-15"),
        ("25 March, 2021", None, "2021-03-25"), ("05/03/2020", None, None), ("05/03/2020", True, "2020-03-05"), ("05/03/2020", False, "2020-05-03"), ("25/03/2020", False, "2020-03-25"), ("15 de enero de 2019", None, "2019-01-15"),
        ("March 2020", None, "2020-03-01"), ("2020", None, "2020-01-01"), ("5-Mar-2020", None, "2020-03-05"), ("soon", None, None), (None, None, None), ("31/02/2020", True, None), ("05/03/61", True, "2061-03-05"), ("05/03/75", True, "1975-03-05"),
    ],
)
def test_dates(spark, value, order, want):
    got = _one(spark, lambda c: dates.parse_date(c, order), value)[0]
    assert got == (date.fromisoformat(want) if want else None)


def test_durations(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), date(2021, 1, 1)), (date(2021, 1, 1), date(2020, 1, 1)), (None, None)], "a date, b date")
    assert [r[0] for r in df.select(dates.duration_years(F.col("a"), F.col("b"))).collect()] == [D("1.002"), None, None]
    assert _one(spark, lambda c: dates.pivot_date(c), "5-Mar-60", "5-Mar-59", "x") == [date(1960, 3, 5), date(2059, 3, 5), None]
    assert _one(spark, lambda c: dates.extract_year(c), "approved 1999", "12345", None) == [1999, None, None]


def test_half_even_against_decimal(spark):
    import random

    rng = random.Random(9)
    pairs = [(rng.randint(-(10**15), 10**15), rng.randint(1, 10**7)) for _ in range(5000)] + [(5, 2), (7, 2), (-5, 2), (-7, 2), (1, 0), (0, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(money.half_even(F.col("a").cast("decimal(38,0)"), F.col("b").cast("decimal(38,0)"))).collect()]
    assert got == [None if b == 0 else int((D(a) / D(b)).quantize(D(1), "ROUND_HALF_EVEN")) for a, b in pairs]


def test_convert(spark):
    schema = "row_id long, loan_amount decimal(22,4), loan_currency string, loan_amount_usd decimal(22,4), approval_year int, commitment_year int, country_code string, loan_type string, official_source_id string"
    rows = [
        (1, D(80), "EUR", None, 2010, None, "IND", None, None), (2, D(50), "XUA", None, 2010, None, None, None, None), (3, D(100), "USD", None, 2010, None, "IND", None, None),
        (4, D("59900456000"), "USD", D("59900456000"), 2025, None, "IDN", "Non-sovereign", None), (5, D("59900456000"), "USD", None, 2025, None, "IDN", "Non-sovereign", "official"),
        (6, None, "EUR", None, 2010, None, None, None, None), (7, D(1), "EUR", None, None, None, None, None, None), (8, D(1), "ZZZ", None, 2010, None, None, None, None), (9, D(0), "USD", None, None, 2010, None, None, None),
    ]
    fx = spark.createDataFrame([("EUR", 2010, 0.8), ("EUR", 2025, 0.9), ("IDR", 2025, 9000.0), ("XDR", 2010, 0.5)], "series_code string, fx_year int, units_per_usd double")
    deflator = spark.createDataFrame([(2010, D(50)), (2025, D(100))], "year int, deflator decimal(12,3)")
    level = spark.createDataFrame([("IND", 2010, 25.0, 100.0)], "code string, year int, gdp_usd double, gdp_ppp double")
    pegs = spark.createDataFrame([("XUA", "XDR")], "currency string, series string")
    areas = spark.createDataFrame([("IDN", "IDR", 1), ("IDN", "EUR", 2)], "area string, series string, ord int")
    got = {r["row_id"]: r for r in money.convert(spark.createDataFrame(rows, schema), fx, deflator, level, pegs, areas).collect()}
    assert (got[1]["nominal_cents"], got[1]["constant_cents"], got[2]["nominal_cents"]) == (10000, 20000, 10000)
    assert (got[3]["ppp_cents"], got[3]["ppp_constant_cents"]) == (40000, 80000)
    assert [got[k]["conversion"] for k in range(4, 10)] == ["excluded-currency-suspect", "source-usd", "no-amount", "no-year", "unconverted", "source-usd"]
    assert got[4]["nominal_cents"] is None and got[9]["constant_cents"] == 0


def test_mojibake_never_fails(spark):
    texts = ["CÃ´te", "lâ€™eau", "Ã“ntario – x", "Â£ 5", "plain", "déjà", "Ã", "", None, "Ã©" * 50_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r["k"]: r["r"] for r in df.select("k", text.mojibake(F.col("t")).alias("r")).collect()}
    assert [got[k] for k in range(9)] == ["Côte", "lâ€™eau", "Ã“ntario – x", "£ 5", "plain", "déjà", "Ã", "", None] and got[9] == "é" * 50_000


def test_similarity_from_a_bound(spark):
    """The bounded ratio against difflib, pair by pair."""
    import difflib
    import random

    rng = random.Random(2)
    texts = ["", None, "a", "é漢", "x" * 3000] + ["".join(rng.choice("abc d") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    pairs = [(x, y, rng.choice([0.0, 0.5, 0.8, 1.0])) for x in texts for y in rng.sample(texts, 12)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string, least double")
    for r in df.withColumn("r", text.similarity_from("a", "b", "least")).collect():
        want = difflib.SequenceMatcher(None, r["a"], r["b"]).ratio() if r["a"] is not None and r["b"] is not None else 0.0
        assert r["r"] == want or (r["r"] == 0.0 and want < r["least"]), r
