import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fundlens import cli
from fundlens.sources import dashboard, files, html, iati, official, paged, sinks


def test_formats_and_encodings():
    assert files.infer_format("a/b.csv?x=1.xml") == "csv" and files.infer_format("get", "application/json; charset=utf-8") == "json"
    with pytest.raises(files.SourceError):
        files.infer_format("a.bin")
    assert files.decode("é".encode("utf-16"))[1] == "utf-16" and files.decode(b"\xef\xbb\xbfa")[0] == "a" and files.decode(b"\xe9")[1] == "cp1252"
    assert files.sniff("a;b;c\n1;2;3\n") == ";" and files.sniff("abc") == ","


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Project ID;Name \n1;"a ""q"" b"\n2;\n', encoding="utf-8")
    df = files.read_rows(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["Project ID", "Name"] and [r[1] for r in df.collect()] == ['a "q" b', None]
    assert files.normalize_columns(df).columns == ["project_id", "name"]
    got = files.resolve(files.normalize_columns(df), {"id": ["ref", "project_id"], "title": ["title"]}).collect()
    assert [tuple(r) for r in got] == [("1", None), ("2", None)]
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("x,y\n1,2\n")
    assert files.read_delimited(spark, str(tmp_path / "b.csv.gz")).count() == 1


def test_preamble(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(b'Title,,\rprinted 2020\r"Project Number",Name,ADB Financing\r12345-001,"A, B","1,500.00"\r\r')
    rows = files.after_preamble(spark, str(tmp_path / "p.csv"), "Project Number").collect()
    assert [(r["Project Number"], r["Name"], r["ADB Financing"]) for r in rows] == [("12345-001", "A, B", "1,500.00")]
    with pytest.raises(files.SourceError):
        files.after_preamble(spark, str(tmp_path / "p.csv"), "Nothing")


def test_json_xml_zip_workbook(spark, tmp_path):
    assert files.record_list({"meta": [{"a": 1}], "deep": {"x": [{"b": 1}, {"b": 2}]}}) == [{"b": 1}, {"b": 2}]
    assert files.record_list({"data": [{"a": 1}, 5]}) == [{"a": 1}] and files.record_list(5) == []
    (tmp_path / "j.json").write_text(json.dumps({"items": [{"a": "é"}, {"a": 2}]}))
    assert [json.loads(r["row"])["a"] for r in files.read_rows(spark, str(tmp_path / "j.json")).orderBy("_ord").collect()] == ["é", 2]
    (tmp_path / "x.xml").write_text('<r><project id="7"><title><narrative>T</narrative></title><country code="AA"/><country code="BB"/></project></r>')
    row = json.loads(files.read_rows(spark, str(tmp_path / "x.xml")).first()["row"])
    assert row == {"@id": "7", "title": "T", "country@code": "AA", "@code": "AA"}
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.txt", "a|b\n1|2,3\n")
        z.writestr("skip.pdf", "x")
    assert json.loads(files.read_rows(spark, str(tmp_path / "z.zip")).first()["row"]) == {"a": "1", "b": "2,3"}
    book = io.BytesIO()
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = lambda rows: "<worksheet><sheetData>" + "".join(f'<row r="{k}">' + "".join(cell(f"{'AB'[j]}{k}", v) for j, v in enumerate(r) if v) + "</row>" for k, r in enumerate(rows, 1)) + "</sheetData></worksheet>"
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook><sheets><sheet name="S"/><sheet name="Big"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", sheet([["h"]]))
        z.writestr("xl/worksheets/sheet2.xml", sheet([["note", ""], ["id", "name"], ["1", "x"], ["2", ""]]))
    assert files.workbook_rows(book.getvalue()) == [{"id": "1", "name": "x"}, {"id": "2", "name": ""}]


PAGE = '<h1>Road <b>one</b></h1><script>no: no</script><a href="/a.pdf#p">File</a><a href="/a.pdf">again</a><table><tr><th>Country</th><th>Amount</th></tr><tr><td>X</td></tr></table><table><tr><td>País</td><td>Y</td></tr></table><p>Status: open</p><p>Approval Date</p><p>Status</p><p>2020</p>'


def test_html(spark):
    df = spark.createDataFrame([(1, PAGE, "https://h.example/x/"), (2, None, None), (3, "", "")], "id long, html string, base string")
    got = html.links(df, "id", "html", "base", extensions=(".pdf",)).collect()
    assert [(r["id"], r["href"], r["label"]) for r in got] == [(1, "https://h.example/a.pdf", "File")]
    page = df.select(html.page_column(F.col("html"), F.col("base")).alias("p")).first()["p"]
    assert "no: no" not in page["text"] and page["labels"]["pais"] == "Y" and page["labels"]["status"] == "open"
    assert df.select(html.heading(F.col("html"))).first()[0] == "Road one"
    rows = html.table_rows(df, "id", "html", "base").collect()
    assert rows[0]["cells"] == {"country": "X", "amount": ""}
    text = spark.createDataFrame([("approval date\nSTATUS\n2020\nStatus\n\nActive",)], "t string")
    assert text.select(html.labelled_lines(F.col("t"), {"Approval Date": "day", "Status": "state"}, False)).first()[0] == {"day": "2020", "state": "2020"}


ACTIVITY = """<iati-activities><iati-activity default-currency="XDR"><iati-identifier>Z-1</iati-identifier><reporting-org ref="B-1"><narrative>Bank</narrative></reporting-org>
<title><narrative>T</narrative></title><participating-org role="1" ref="B-1"><narrative>Bank</narrative></participating-org><participating-org role="1" ref="B-1"><narrative>Bank - Window</narrative></participating-org>
<participating-org role="1" ref="W-2"><narrative>Soft Fund</narrative></participating-org><participating-org role="1" ref="P-1"><narrative>Partner</narrative></participating-org><participating-org role="4" type="99"/><participating-org role="4" type="70"/>
<activity-date type="1" iso-date="2010-01-01"/><activity-date type="4" iso-date="2015-01-01"/>
<transaction><transaction-type code="2"/><transaction-date iso-date="2010-02-01"/><value>100</value></transaction><transaction><transaction-type code="2"/><value>900</value></transaction>
<transaction><transaction-type code="3"/><transaction-date iso-date="2011-01-01"/><value currency="USD">10.5</value></transaction><transaction><transaction-type code="3"/><transaction-date iso-date="2012-01-01"/><value>20</value></transaction>
<transaction><transaction-type code="3"/><transaction-date iso-date="2009-01-01"/><value>-5</value></transaction><transaction><transaction-type code="3"/><value>x</value></transaction></iati-activity></iati-activities>"""


def test_activities(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ACTIVITY)
    df = iati.counterpart(iati.funders(iati.dates(iati.transactions(iati.read_activities(spark, str(tmp_path / "a.xml")))), ["W-2"]))
    r = df.first()
    assert (float(r["commitment"]), r["commitment_currency"], float(r["disbursed"]), r["disbursed_currency"], float(r["corrections"])) == (100, "XDR", 30.5, "USD", -5)
    assert (r["first_disbursement"], r["last_disbursement"], r["start_date"], r["start_planned"], r["end_date"], r["end_planned"]) == ("2011-01-01", "2012-01-01", "2010-01-01", 1, "2015-01-01", 0)
    assert (r["partners"], r["windows"], r["counterpart"]) == (["Partner"], ["Bank - Window", "Soft Fund"], "Private Sector")


def test_paged(spark, tmp_path):
    for k in range(0, 25, 10):
        (tmp_path / f"p{k}.json").write_text(json.dumps({"results": [{"n": j} for j in range(k, min(k + 10, 25))]}))
    df = paged.read_paged(spark, url=f"file:{tmp_path}/p{{offset}}.json", total="25", page_size="10")
    assert sorted(json.loads(r["row"])["n"] for r in df.collect()) == list(range(25)) and df.rdd.getNumPartitions() == 3
    assert list(paged.pages_until_short(lambda k: [{}] * (3 if k < 2 else 1), 3)) == [{}] * 7
    assert paged.backoff(9) == 30 and paged.backoff(0, "7") == 7
    assert [r["format"] for r in paged.rank_resources([{"format": "CSV"}, {"format": "pdf"}, {"format": "XML"}])] == ["XML", "CSV", "pdf"]
    paged.land(b"x", str(tmp_path / "d" / "raw"))
    assert (tmp_path / "d" / "raw").read_bytes() == b"x"


def test_dashboard(spark):
    doc = json.dumps({"a": 1})
    assert dashboard.segments(f"{len(doc)};{doc}{len(doc)};{doc}") == [{"a": 1}] * 2
    df = spark.createDataFrame([([0, 1, -1, 9], ["x", "y"], ["z"])], "i array<long>, v array<string>, w array<string>")
    assert df.select(dashboard.decode_column(F.col("i"), F.col("v"), F.col("w"))).first()[0] == ["x", "y", "z", None]


def test_official(spark):
    row = {c: "None" for c in ["afdb_identifier", "title", "country", "country_codes", "activity_status", "approval_date", "afdb_sector", "afdb_status", "total_commitments_usd", "total_disbursements_usd"]}
    rows = [{**row, "rec_no": 1}, {**row, "rec_no": 2, "afdb_identifier": "xm-P-AA-B12-345", "country_codes": "AA,", "afdb_status": "Blend", "total_commitments_usd": "1,500.5", "approval_date": "2020-01-02"}]
    got = {r["rec_no"]: r for r in official.group_list(spark.createDataFrame(rows)).collect()}
    assert got[1]["title" if "title" in got[1] else "project_name"] is None and got[2]["country_code"] == "AA" and got[2]["concessional"] == "Blended" and float(got[2]["loan_amount"]) == 1500.5
    arms = official.export_arms(
        spark.createDataFrame([("p", "Active", 5.0, 0.0), ("q", "Dropped", 5.0, 5.0)], "project_id string, status string, ibrd_amount double, ida_amount double"),
        spark.createDataFrame([("p", 1.0, 2.0), ("q", 1.0, 2.0), ("q", 3.0, 4.0)], "project_id string, latitude double, longitude double"),
    ).collect()
    assert [(r["project_id"], r["arm"], r["latitude"]) for r in arms] == [("p", "ibrd", 1.0)]
    text = spark.createDataFrame([("Road A\nCountry: X\nAmount: USD 1.5 million\nStatus: Approved\n\nnoise",)], "value string")
    assert official.cards(text).first()["country"] == "X"
    eib = official.positional(spark.createDataFrame([(["Signed", "25/12/2020", "0", "5"],)], "info array<string>"), "info").first()
    assert eib["status"] == "Signed" and str(eib["approval_date"]) == "2020-12-25" and float(eib["loan_amount"]) == 5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a"b', ["x", "y"]), (1, None, None)], "id long, t string, l array<string>")
    assert sinks.write_csv_file(df, str(tmp_path / "o.csv"), ["id"]) == 2
    assert (tmp_path / "o.csv").read_bytes().startswith(b"\xef\xbb\xbfid,t,l\r\n1,,\r\n")
    assert sinks.read_csv_file(spark, str(tmp_path / "o.csv"), ["id", "t", "l"]).count() == 2
    with pytest.raises(ValueError):
        sinks.read_csv_file(spark, str(tmp_path / "o.csv"), ["id", "l", "t"])
    info = sinks.combine([df, df], [str(tmp_path / "o.csv")] * 2, str(tmp_path / "both"))
    assert info["rows"] == 4 and info["warnings"] == []
    with pytest.raises(ValueError):
        sinks.combine([df, df.drop("t")], [], str(tmp_path / "no"))
    sinks.manifest(str(tmp_path / "m.json"), rows=4)
    assert json.loads((tmp_path / "m.json").read_text())["rows"] == 4
    assert "| 1 |" in sinks.markdown("T", df.select("id"))


def test_command_line():
    p = cli.parser()
    args = p.parse_args(["--data", "d", "--banks", "B,a,b", "--combine", "--dyad"])
    cli.check(args)
    assert cli.chosen(args, ["a", "b", "c"]) == ["b", "a"] and cli.pairs(["A=x=y"]) == {"a": "x=y"}
    for bad in (["--min-year", "2020", "--max-year", "2010"], ["--max-projects", "0"], ["--dyad"], ["--source-file", "x"], ["--combine-only", "--format", "json"]):
        with pytest.raises(ValueError):
            cli.check(p.parse_args(["--data", "d", *bad]))
    with pytest.raises(ValueError):
        cli.chosen(p.parse_args(["--data", "d", "--bank", "zz"]), ["a"])
    assert [cli.exit_code(*a) for a in ((1, 0, False, False), (1, 1, True, True), (0, 1, False, False), (1, 1, False, True))] == [2, 3, 0, 3]


def test_heads_that_end_inside_a_letter(spark, tmp_path):
    body = "id,name\n" + "".join(f"{k},été {k}\n" for k in range(3000))
    for shift in (0, 1):
        (tmp_path / "u.csv").write_bytes(b"x" * shift + body.encode())
        df = files.read_delimited(spark, str(tmp_path / "u.csv"))
        assert df.count() == 3000 and df.first()["name"] == "été 0"
    assert files.decode("é".encode()[:1] * 1, whole=False)[1] == "utf-8-sig" and files.decode("aé".encode("utf-16")[:5], whole=False)[1] == "utf-16"
    with gzip.open(tmp_path / "g.csv.gz", "wt") as f:
        f.write(body)
    assert files.head(spark, str(tmp_path / "g.csv.gz"), 7) == b"id,name"


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('id,name\n1,"a\nb"\n2,c\n')
    (tmp_path / "p.csv").write_text('id,name\n1,"a"\n2,c\n')
    assert [r["name"] for r in files.read_delimited(spark, str(tmp_path / "q.csv")).collect()] == ["a\nb", "c"]
    assert [r["name"] for r in files.read_delimited(spark, str(tmp_path / "p.csv")).collect()] == ["a", "c"]
    (tmp_path / "h.csv").write_text('Title\nNo.,Name\n1,"two\nlines"\n\n2,x\n')
    got = files.after_preamble(spark, str(tmp_path / "h.csv"), "No.").orderBy("_ord").collect()
    assert [(r["_ord"], r["No."], r["Name"]) for r in got] == [(0, "1", "two\nlines"), (1, "2", "x")]


def test_moved_sheets():
    book = io.BytesIO()
    sheet = lambda v: f'<worksheet><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>h</t></is></c></row><row r="2"><c r="A2" t="inlineStr"><is><t>{v}</t></is></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="x"><sheets><sheet name="One" r:id="b"/><sheet name="Two" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><r Id="a" Target="worksheets/sheet1.xml"/><r Id="b" Target="/xl/worksheets/sheet2.xml"/></R>')
        z.writestr("xl/worksheets/sheet1.xml", sheet("two"))
        z.writestr("xl/worksheets/sheet2.xml", sheet("one"))
    assert files.workbook_rows(book.getvalue(), "One") == [{"h": "one"}] and files.workbook_rows(book.getvalue(), "Two") == [{"h": "two"}]


def test_pages_keep_the_service_order(spark, tmp_path):
    for a in (0, 10, 20):
        (tmp_path / f"p{a}.json").write_text(json.dumps([{"n": a + k} for k in range(min(10, 25 - a))]))
    df = paged.read_paged(spark, url=f"file:{tmp_path}/p{{offset}}.json", total="25", page_size="10")
    assert [(r["_ord"], json.loads(r["row"])["n"]) for r in df.orderBy("_ord").collect()] == [(k, k) for k in range(25)]
    with pytest.raises(files.SourceError):
        list(paged.pages_until_short(lambda k: [{}] * 2, 2, most=5))
    assert list(paged.pages_until_short(lambda k: [{"id": k // 2}] if k < 4 else [], 1, key="id")) == [{"id": 0}, {"id": 1}]


def test_portals_and_listings(spark, tmp_path):
    frames = {"a.xml": None, "b.csv": spark.range(0), "c.json": spark.range(2)}

    def read(r):
        if frames[r["url"]] is None:
            raise files.SourceError("broken")
        return frames[r["url"]]

    got, df = paged.first_with_rows([{"url": "c.json", "format": "json"}, {"url": "a.xml", "format": "XML"}, {"url": "b.csv", "format": "CSV"}], read)
    assert got["url"] == "c.json" and df.count() == 2
    with pytest.raises(files.SourceError):
        paged.first_with_rows([], read)
    listed = [{"name": "projects-aa", "title": "AA"}, {"name": "x-organisation"}, {"name": "projects-bb", "resources": [{"url": "http://h/organisation.xml"}]}, {"name": "projects-cc"}]
    found = list(paged.packages(lambda start: {"count": 4, "results": listed[start : start + 3]}, lambda p: paged.relevant(p, ("projects",))))
    assert [p["name"] for p in found] == ["projects-aa", "projects-cc"] and found[0]["_source_note"] == "from the package AA"
    pages = {"http://h/1": ["http://h/2#x", "http://other/3", "http://h/1"], "http://h/2": ["http://h/1", "http://h/4"], "http://h/4": []}
    assert paged.crawl("http://h/1", pages.get, lambda u: True) == ["http://h/1", "http://h/2", "http://h/4"]
    with pytest.raises(files.SourceError):
        paged.crawl("http://h/1", pages.get, lambda u: True, most=2)


def test_requests_are_spaced_and_logged(tmp_path):
    waited, now = [], [0.0]
    throttle = paged.Throttle(0.75, clock=lambda: now[0], sleep=waited.append)

    class Answer(io.BytesIO):
        pass

    opened = lambda request, timeout: Answer(gzip.compress(b"body") if request.get_header("Accept-encoding") == "gzip" else b"")
    assert paged.fetch("http://h/a", opener=opened, throttle=throttle) == paged.fetch("http://h/b", opener=opened, throttle=throttle) == b"body"
    paged.fetch("http://i/c", opener=opened, throttle=throttle)
    assert waited == [0.75]
    paged.land(b"x", str(tmp_path / "r"), "http://h/a", str(tmp_path / "log"))
    paged.land_reference(b"y", str(tmp_path / "fx.csv"), "http://h/fx")
    assert json.loads((tmp_path / "log").read_text())["url"] == "http://h/a" and json.loads((tmp_path / "fx.csv.meta.json").read_text())["bytes"] == 1
