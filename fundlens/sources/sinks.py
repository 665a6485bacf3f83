"""Sinks: CSV with a byte order mark, JSON, manifests and reports. Distributed writers stay Spark's own."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re
import zipfile
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.operators.ordered import union_checked


def sha256(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            h.update(chunk)
    return h.hexdigest()


def plain(df: DataFrame) -> DataFrame:
    """Text columns for a delimited file: plain decimals, nulls as empty, arrays joined."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        text = F.array_join(c.cast("array<string>"), "; ") if kind.startswith("array") else c.cast("string")
        out.append(F.coalesce(text, F.lit("")).alias(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers."""
    plain(df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_csv_file(df: DataFrame, path: str, order: list[str] | None = None) -> int:
    """One CSV file with a byte order mark, streamed partition by partition; for outputs of report size."""
    rows = plain(df.orderBy(*order) if order else df)
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(rows.columns)
        for r in rows.toLocalIterator():
            out.writerow(r)
            n += 1
    return n


def read_csv_file(spark, path: str, columns: list[str]) -> DataFrame:  # noqa: ANN001
    """Our own output back; its header must be the wanted columns in order."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    if df.columns != columns:
        raise ValueError(f"{path}: missing {[c for c in columns if c not in df.columns]}, unexpected {[c for c in df.columns if c not in columns]}")
    return df


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_file(df: DataFrame, path: str) -> int:
    """One JSON array with two blanks of indent, streamed; for outputs of report size."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for (row,) in df.select(F.to_json(F.struct("*"))).toLocalIterator():
            f.write(("," if n else "") + "\n" + "\n".join("  " + line for line in json.dumps(json.loads(row), ensure_ascii=False, indent=2).split("\n")))
            n += 1
        f.write("\n]\n" if n else "]\n")
    return n


def write_workbook(df: DataFrame, path: str, sheet: str = "Sheet1") -> int:
    """One sheet with a bold, frozen header, a filter and widths from 12 to 42; text cells, up to the format's rows."""

    def letters(k: int) -> str:
        return (letters(k // 26 - 1) if k >= 26 else "") + chr(65 + k % 26)

    def cell(ref: str, v: str, style: int = 0) -> str:
        v = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", v)[:32_767]
        return f'<c r="{ref}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'

    rows = plain(df)
    width, body, n = [len(c) for c in rows.columns], io.StringIO(), 1
    body.write('<row r="1">' + "".join(cell(f"{letters(k)}1", c, 1) for k, c in enumerate(rows.columns)) + "</row>")
    for r in rows.toLocalIterator():
        n += 1
        if n > 1_048_576:
            raise ValueError("a sheet holds 1,048,576 rows; write CSV or Parquet")
        width = [max(w, len(v)) for w, v in zip(width, r, strict=True)]
        body.write(f'<row r="{n}">' + "".join(cell(f"{letters(k)}{n}", v) for k, v in enumerate(r) if v) + "</row>")
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    span = f"A1:{letters(len(width) - 1)}{n}"
    cols = "".join(f'<col min="{k}" max="{k}" width="{min(42, max(12, w + 2))}" customWidth="1"/>' for k, w in enumerate(width, 1))
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet[:31])}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf fontId="0"/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>{body.getvalue()}</sheetData><autoFilter ref="{span}"/></worksheet>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text if name.startswith("xl/worksheets") else '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return n - 1


def combine(frames: list[DataFrame], paths: list[str], out: str, spread_hours: float = 6.0) -> dict:
    """Outputs joined in the given order after a layout check; a manifest of inputs and a warning if they are far apart in time."""
    both = union_checked(frames)
    both.drop("__input").write.mode("overwrite").parquet(out)
    counts = {r["__input"]: r["count"] for r in both.groupBy("__input").count().collect()}
    times = [Path(p).stat().st_mtime for p in paths]
    far = bool(times) and max(times) - min(times) > spread_hours * 3600
    inputs = [{"path": p, "sha256": sha256(p) if Path(p).is_file() else None, "rows": counts.get(k, 0)} for k, p in enumerate(paths)]
    return {"inputs": inputs, "rows": sum(counts.values()), "warnings": ["inputs were written far apart"] if far else []}


def combine_layouts(frames: list[DataFrame], paths: list[str], out: str) -> dict:
    """As :func:`combine`, written as CSV."""
    info = combine(frames, paths, f"{out}.parquet")
    write_csv(frames[0].sparkSession.read.parquet(f"{out}.parquet"), out)
    return info


def manifest(path: str, **parts: object) -> None:
    """What a run did: time, filters, counts, failures."""
    Path(path).write_text(json.dumps({"written_at": datetime.now(UTC).isoformat(timespec="seconds"), **parts}, indent=2, default=str, sort_keys=True))


def summary(records: DataFrame, fields: list[str]) -> DataFrame:
    """(bank_id, n_records, n_<field> filled ..., first_year, last_year): the coverage of each bank's records in one pass."""
    filled = [F.count(F.when(F.trim(F.col(f).cast("string")) != "", 1)).alias(f"n_{f}") for f in fields]
    return records.groupBy("bank_id").agg(F.count(F.lit(1)).alias("n_records"), *filled, F.min("approval_year").alias("first_year"), F.max("approval_year").alias("last_year"))


def report(bank: str, row: dict, notes: list[tuple[str, int]], excluded: int = 0) -> str:
    """A bank's quality report as Markdown: what is filled, the commonest notes and what a merge left out."""
    total = row.get("n_records") or 0
    lines = [f"# {bank}", "", f"{total} records, {row.get('first_year') or '?'} to {row.get('last_year') or '?'}", "", "| field | filled |", "| --- | --- |"]
    lines += [f"| {k[2:]} | {v} ({v / total:.0%}) |" if total else f"| {k[2:]} | 0 |" for k, v in row.items() if k.startswith("n_") and k != "n_records"]
    return "\n".join([*lines, "", *[f"- {n} ({k})" for n, k in notes], *([f"- {excluded} rows left out"] if excluded else [])]) + "\n"


def failure_report(bank: str, why: str) -> str:
    return f"# {bank}\n\nNot collected: {why}\n"


def markdown(title: str, df: DataFrame, limit: int = 1000) -> str:
    """A small table as Markdown; says so when rows are left out."""
    rows = df.limit(limit + 1).collect()
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows[:limit]]
    return "\n".join(lines + ([f"\nOnly the first {limit} rows are shown."] if len(rows) > limit else []))


#: Writer per format.
WRITERS: dict[str, Callable[[DataFrame, str], None]] = {
    "csv": write_csv,
    "json": write_json,
    "parquet": lambda df, path: df.write.mode("overwrite").parquet(path),
}


def write(df: DataFrame, fmt: str, path: str) -> str:
    """A table in a format; a workbook is one file, the others are folders of parts. Returns where it lies."""
    if fmt == "xlsx":
        write_workbook(df, f"{path}.xlsx")
        return f"{path}.xlsx"
    WRITERS[fmt](df, path)
    return path
