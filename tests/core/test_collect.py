"""Collecting and combining from the command line, end to end."""

import json

import pytest
from pyspark.sql import functions as F

from fundlens import cli
from fundlens.operators import project
from fundlens.sources import files, registry, sinks


@pytest.fixture
def data(spark, tmp_path):
    rows = [(1, "one", "o1", "Old road", "AAX", 2010, 2010, None, "note a"), (2, "two", "t1", "Dam", "BBX", 1990, None, None, None), (3, "two", "t2", "Port", None, None, None, "s", None)]
    schema = "row_id long, bank_id string, project_id string, project_name string, country_code string, approval_year int, commitment_year int, official_source_id string, data_quality_notes string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "data" / "project_records.parquet"))
    spark.createDataFrame([("AA", "AAX", "Aland", [])], "iso2 string, iso3 string, country_name string, alt_names array<string>").write.parquet(str(tmp_path / "data" / "ref_countries.parquet"))
    (tmp_path / "three.csv").write_text("Ref;Name;Country;Amount;Signed Date\nx1;Line one;Aland;1.5 million;2015-03-01\nx1;Line one again;Aland;2;2015-03-01\n;Line two;Nowhere;;\nx3;;Aland;1;2016-01-01\nx4;Too old;Aland;1;1999-01-01\n", encoding="utf-8")
    banks = [{"id": "three", "name": "Third Bank", "abbreviation": "TB", "aliases": ["iii"], "layout": {"aliases": {"project_id": ["ref"], "loan_amount": ["amount"]}, "default_currency": "EUR"}, "constants": {"status": "Signed"}}]
    (tmp_path / "banks.json").write_text(json.dumps(banks))
    return tmp_path


def test_collect_and_combine(spark, data, capsys):
    base = ["--data", str(data / "data"), "--registry", str(data / "banks.json"), "--output-dir", str(data / "out")]
    run = [*base, "--banks", "TB,one", "--source-file", f"iii={data / 'three.csv'}", "--combine", "--format", "csv", "--format", "xlsx", "--include-raw", "--parallel", "2"]
    assert cli.main(run) == 0
    got = spark.read.csv(str(data / "out" / "records_three_csv"), header=True, escape=chr(34)).orderBy("project_name").collect()
    assert [(r["project_id"], r["project_name"], r["country_code"], r["loan_amount"], r["loan_currency"], r["status"], r["approval_year"]) for r in got] == [
        ("x1", "Line one", "AAX", "1500000.0000", "EUR", "Signed", "2015"), (got[1]["project_id"], "Line two", None, None, "EUR", "Signed", None),
    ]
    assert got[1]["project_id"].startswith("made-") and "year unknown" in got[1]["data_quality_notes"] and "no country code for Nowhere" in got[1]["data_quality_notes"]
    assert json.loads(got[0]["source_fields"])["amount"] == "1.5 million"
    assert spark.read.csv(str(data / "out" / "records_all_csv"), header=True, escape=chr(34)).count() == 3
    book = files.workbook_rows((data / "out" / "records_three_xlsx.xlsx").read_bytes())
    assert [r["project_name"] for r in sorted(book, key=lambda r: r["project_name"])] == ["Line one", "Line two"]
    told = json.loads((data / "out" / "manifest.json").read_text())
    assert told["banks"] == ["three", "one"] and told["failures"] == {} and told["source_files"]["iii"]["sha256"]
    assert (data / "out" / "report_three.md").exists() and "bank_id" in (data / "out" / "summary.csv").read_text(encoding="utf-8-sig")


def test_partial_failures_and_combine_only(spark, data, capsys):
    base = ["--data", str(data / "data"), "--registry", str(data / "banks.json"), "--output-dir", str(data / "out")]
    broken = [*base, "--banks", "two,three", "--source-file", f"three={data / 'nothing.csv'}"]
    assert cli.main(broken) == 2 and cli.main([*broken, "--allow-partial"]) == 0
    assert "three" in json.loads((data / "out" / "manifest.json").read_text())["failures"] and "Not collected" in (data / "out" / "report_three.md").read_text()
    assert spark.read.csv(str(data / "out" / "records_two_csv"), header=True, escape=chr(34)).count() == 1  # 1990 is out of scope, a row without a year isn't
    assert cli.main([*base, "--banks", "one"]) == 0
    assert cli.main([*base, "--banks", "one,two", "--combine-only"]) == 0
    assert spark.read.csv(str(data / "out" / "records_all_csv"), header=True, escape=chr(34)).count() == 2
    assert cli.main([*base, "--all-banks", "--combine-only"]) == 2 and cli.main([*base, "--all-banks", "--combine-only", "--allow-partial"]) == 0
    for bad in (["--bank", "zz"], ["--bank", "one", "--source-file", "zz=x"], ["--bank", "one", "--parallel", "0"]):
        assert cli.main([*base, *bad]) == 2


def test_registry(tmp_path):
    r = registry.Registry([registry.Bank("a", abbreviation="AA", aliases=("first",))])
    assert r.get(" FIRST ").id == "a" and r.get("aa").id == "a"
    with pytest.raises(ValueError):
        r.add(registry.Bank("b", aliases=("AA",)))
    with pytest.raises(ValueError):
        r.get("c")
    (tmp_path / "r.json").write_text('[{"id": "x", "layout": {"colour": 1}}]')
    with pytest.raises(ValueError, match="colour"):
        registry.Registry.read(str(tmp_path / "r.json"))


def test_reader_and_extra_tables(spark, tmp_path):
    own = registry.Bank(
        "o", reader=lambda spark, path: spark.createDataFrame([("1", "A", "5"), ("2", "B", None)], "id string, name string, loan_amount string"),
        adapt=lambda df: project.usd_fan_out(df, "loan_amount"), extra=lambda rows: {"count": rows.agg(F.count(F.lit(1)).alias("n"))},
    )
    got, extra = registry.collect(spark, own, "p", most=1)
    assert [r["commitment_currency"] for r in got.collect()] == ["USD"] and extra["count"].first()["n"] == 2
    with pytest.raises(ValueError):
        registry.collect(spark, registry.Bank("e", reader=lambda spark, path: spark.createDataFrame([], "name string")), "p")


def test_json_array(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "a long, b string")
    assert sinks.write_json_file(df, str(tmp_path / "x.json")) == 2
    assert json.loads((tmp_path / "x.json").read_text()) == [{"a": 1, "b": "é"}, {"a": 2}]
    assert sinks.write_json_file(df.limit(0), str(tmp_path / "y.json")) == 0 and json.loads((tmp_path / "y.json").read_text()) == []
