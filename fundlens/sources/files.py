"""File scans: encodings, delimited text, JSON, XML, workbooks, archives, preambles and format choice.

Small decisions (encoding, separator, layout) are made on a bounded head of the file on the driver; the rows
are read by Spark's own readers wherever a format allows it.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.text import NULL_WORDS, normalized_key

HEAD = 8192
# File suffixes and media types by format.
SUFFIXES = {"csv": "csv", "tsv": "csv", "txt": "csv", "json": "json", "jsonld": "json", "xml": "xml", "iati": "xml", "xlsx": "xlsx", "xlsm": "xlsx", "zip": "zip", "parquet": "parquet"}
MEDIA = {"text/csv": "csv", "text/tab-separated-values": "csv", "application/json": "json", "application/ld+json": "json", "application/xml": "xml", "text/xml": "xml", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx", "application/zip": "zip"}
# Keys of record lists and names of row elements, in the order they are tried.
RECORD_KEYS = ["records", "results", "data", "projects", "items"]
XML_ROWS = ["iati-activity", "project", "record", "item", "operation"]


class SourceError(ValueError):
    """A source that cannot be read as what it should be."""


def decode(data: bytes, whole: bool = True) -> tuple[str, str]:
    """(text, encoding): a byte order mark decides for UTF-16 first; then UTF-8, UTF-16, cp1252, Latin-1.

    With ``whole`` false the data are the head of a file, which may end inside a letter.
    """
    order = ["utf-8-sig", "utf-8", "utf-16", "cp1252", "latin-1"]
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        order.insert(0, "utf-16")
    for name in order:
        try:
            return codecs.getincrementaldecoder(name)().decode(data, whole), name
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace"), "utf-8"


def infer_format(path: str, media: str | None = None) -> str:
    """The format by suffix, before any query string, else by media type."""
    suffix = path.split("?", 1)[0].rsplit(".", 1)[-1].lower()
    kind = SUFFIXES.get(suffix) or MEDIA.get((media or "").split(";")[0].strip().lower())
    if kind is None:
        raise SourceError(f"unknown format: {path}")
    return kind


def sniff(head: str) -> str:
    """The separator of a delimited text, by its head."""
    try:
        return csv.Sniffer().sniff(head, delimiters=",\t;|").delimiter
    except csv.Error:
        return "\t" if "\t" in head else ","


def head(spark: SparkSession, path: str, size: int = HEAD) -> bytes:
    """The first bytes of a file on any file system that Spark reads; of a gzip file, of what is in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        data = bytes(stream.readNBytes(max(size, 1 << 16) if path.endswith(".gz") else size))
    finally:
        stream.close()
    return zlib.decompressobj(31).decompress(data, size) if path.endswith(".gz") else data


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, multiline: bool | None = None) -> DataFrame:
    """A delimited file with a header as text columns under tidy names, in Spark's reader.

    Unless said, a scan of the lines finds whether quotes hold line breaks; only then is a file one task.
    """
    text, encoding = decode(head(spark, path), whole=False)
    if not text.strip():
        raise SourceError("delimited source has no header row")
    charset = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "utf-16": "UTF-16", "cp1252": "windows-1252", "latin-1": "ISO-8859-1"}[encoding]
    if multiline is None:
        multiline = encoding == "utf-16" or not spark.read.text(path).where(F.regexp_count("value", F.lit('"')) % 2 == 1).isEmpty()
    df = spark.read.csv(path, header=True, sep=sep or sniff(text), encoding=charset, multiLine=multiline, quote='"', escape='"', mode="PERMISSIVE")
    return df.toDF(*[re.sub(r"\s+", " ", c.lstrip("\ufeff")).strip() for c in df.columns])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names by their keys, once per schema; a repeated key is numbered."""
    seen: dict[str, int] = {}
    names = []
    for k, c in enumerate(df.columns):
        key = normalized_key(c) or f"column_{k + 1}"
        seen[key] = seen.get(key, 0) + 1
        names.append(key if seen[key] == 1 else f"{key}_{seen[key]}")
    return df.toDF(*names)


def resolve(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Target fields from the first alias column that exists and is not null or a word for nothing."""
    out = []
    for field, names in aliases.items():
        there = [F.col(f"`{n}`") for n in names if n in df.columns]
        usable = [F.when(~F.lower(F.trim(c.cast("string"))).isin(NULL_WORDS), c.cast("string")) for c in there]
        out.append((F.coalesce(*usable) if usable else F.lit(None).cast("string")).alias(field))
    return df.select(*out)


def after_preamble(spark: SparkSession, path: str, header_prefix: str) -> DataFrame:
    """A CSV whose header is the first line with a prefix; bare carriage returns end lines too, quotes may hold line breaks.

    ``_ord`` is the place of a row after the header.
    """

    def cut(text: str) -> list[list[str]]:
        lines = io.StringIO(text.replace("\r\n", "\n").replace("\r", "\n"), newline="\n")
        while True:
            at = lines.tell()
            line = lines.readline()
            if not line:
                return []
            if line.lstrip('"').startswith(header_prefix):
                lines.seek(at)
                return [r for r in csv.reader(lines) if any(x.strip() for x in r)]

    found = cut(decode(head(spark, path, 1 << 20), whole=False)[0])
    if not found:
        raise SourceError(f"no header line starting with {header_prefix!r}")
    names = found[0]

    def parse(data: bytes) -> list[dict]:
        return [dict(zip(map(str, range(len(names))), r, strict=False)) for r in cut(decode(data)[0])[1:]]

    rows = _files(spark, path, parse).select("_ord", F.from_json("row", "map<string,string>").alias("r"))
    return rows.select("_ord", *[F.col("r")[str(k)].alias(n) for k, n in enumerate(names)])


def record_list(payload: object) -> list[dict]:
    """The records of a JSON document: itself, a list under a usual key, else its longest list of objects."""
    if isinstance(payload, list):
        return [r for r in payload if isinstance(r, dict)]
    if not isinstance(payload, dict):
        return []
    for key in RECORD_KEYS:
        if isinstance(payload.get(key), list):
            return [r for r in payload[key] if isinstance(r, dict)]
    best: list[dict] = []
    todo: list[object] = [payload]
    while todo:
        node = todo.pop(0)
        if isinstance(node, list):
            found = [x for x in node if isinstance(x, dict)]
            best = found if len(found) > len(best) else best
        todo += node if isinstance(node, list) else list(node.values()) if isinstance(node, dict) else []
    return best


def _files(spark: SparkSession, path: str, parse: Callable[[bytes], list[dict]]) -> DataFrame:
    """(path, _ord, row json): one task per file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                rows = parse(bytes(content))
                yield pd.DataFrame({"path": p, "_ord": range(len(rows)), "row": [json.dumps(r, ensure_ascii=False, default=str) for r in rows]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, _ord long, row string")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, _ord, row): the records of JSON documents, each as JSON text. Lines of JSON: ``spark.read.json``."""

    def parse(data: bytes) -> list[dict]:
        try:
            return record_list(json.loads(decode(data)[0]))
        except json.JSONDecodeError as e:
            raise SourceError(f"invalid JSON: {e}") from e

    return _files(spark, path, parse)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def flatten_element(node: ET.Element) -> dict[str, str]:
    """An element as a flat map: first value wins; a narrative goes by its parent; attributes as elem@attr and @attr."""
    out: dict[str, str] = {}

    def visit(e: ET.Element, parent: str | None) -> None:
        name = _local(e.tag)
        text = re.sub(r"\s+", " ", e.text or "").strip()
        if text:
            out.setdefault(parent if name == "narrative" and parent else name, text)
        for a, v in e.attrib.items():
            out.setdefault(f"{name}@{_local(a)}", v)
            out.setdefault(f"@{_local(a)}", v)
        for child in e:
            visit(child, name)

    for a, v in node.attrib.items():
        out.setdefault(f"@{_local(a)}", v)
    for child in node:
        visit(child, None)
    return out


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """(path, _ord, row): the row elements of XML documents - or the root's children - as flat JSON maps."""

    def parse(data: bytes) -> list[dict]:
        root = ET.fromstring(data)
        rows = [e for e in root.iter() if _local(e.tag) in XML_ROWS] or list(root)
        return [flatten_element(e) for e in rows]

    return _files(spark, path, parse)


def workbook_rows(data: bytes, sheet: str | None = None, header_row: int | None = None) -> list[dict]:
    """Rows of a workbook sheet (the one with most rows unless named); the fullest of the first 25 rows is the header."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if _local(t.tag) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]
        book = ET.fromstring(z.read("xl/workbook.xml"))
        parts = {}
        if "xl/_rels/workbook.xml.rels" in names:
            parts = {e.attrib["Id"]: e.attrib["Target"].lstrip("/") for e in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")) if "Id" in e.attrib}
        sheets = []
        for k, e in enumerate((e for e in book.iter() if _local(e.tag) == "sheet"), 1):
            grid, title = [], e.attrib["name"]
            # a sheet's file is the one its relation names; its place says nothing once sheets were moved
            part = next((parts[v] for a, v in e.attrib.items() if _local(a) == "id" and v in parts), f"worksheets/sheet{k}.xml")
            part = part if part.startswith("xl/") else f"xl/{part}"
            for row in (e for e in ET.fromstring(z.read(part)).iter() if _local(e.tag) == "row"):
                cells: dict[int, str] = {}
                for c in row:
                    letters = re.match(r"[A-Z]+", c.attrib.get("r", "A"))
                    col = 0
                    for ch in letters[0] if letters else "A":
                        col = col * 26 + ord(ch) - 64
                    v = "".join(x.text or "" for x in c.iter() if _local(x.tag) in ("v", "t"))
                    cells[col - 1] = shared[int(v)] if c.attrib.get("t") == "s" and v else v
                grid.append([cells.get(j, "") for j in range(max(cells, default=-1) + 1)])
            sheets.append((title, grid))
    if sheet is not None:
        sheets = [s for s in sheets if s[0] == sheet]
        if not sheets:
            raise SourceError(f"no sheet {sheet!r}")
    grid = max(sheets, key=lambda s: len(s[1]))[1]
    if not grid:
        return []
    at = header_row - 1 if header_row else max(range(min(25, len(grid))), key=lambda k: sum(bool(x.strip()) for x in grid[k]))
    head = grid[at]
    return [{h.strip(): (r[j] if j < len(r) else "") for j, h in enumerate(head) if h.strip()} for r in grid[at + 1 :] if any(x.strip() for x in r)]


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None, header_row: int | None = None) -> DataFrame:
    return _files(spark, path, lambda data: workbook_rows(data, sheet, header_row))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(path, _ord, row): the delimited members of zip archives; '|' or ',' by which the first line has more of."""

    def parse(data: bytes) -> list[dict]:
        rows: list[dict] = []
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for name in z.namelist():
                if name.lower().endswith((".txt", ".csv")):
                    raw = z.read(name)
                    text = decode(raw)[0]
                    first = text.split("\n", 1)[0]
                    rows += csv.DictReader(io.StringIO(text), delimiter="|" if first.count("|") > first.count(",") else ",")
        return rows

    return _files(spark, path, parse)


def read_rows(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A source by its format; see READERS."""
    kind = fmt or infer_format(path)
    if kind not in READERS:
        raise SourceError(f"no reader for {kind}")
    return READERS[kind](spark, path)


#: Reader per format; add an entry to add a format.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": read_delimited,
    "json": read_json,
    "xml": read_xml,
    "xlsx": read_workbook,
    "zip": read_archive,
    "parquet": lambda spark, path: spark.read.parquet(path),
}


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """(year, value) of a yearly series; rows that don't cast are skipped. The year may be a date."""
    df = spark.read.csv(path, header=True)
    y, v = df.columns[:2]
    return df.select(F.substring(F.col(y), 1, 4).try_cast("int").alias("year"), F.col(v).try_cast("decimal(28,12)").alias("value")).where("year IS NOT NULL AND value IS NOT NULL")


def locate(bank: str, overrides: dict[str, str], urls: dict[str, str], registry: dict[str, str]) -> str:
    """Where a source is read from: a local snapshot, else a given address, else the registered one."""
    for place in (overrides, urls, registry):
        if place.get(bank):
            return place[bank]
    raise SourceError(f"no source for {bank}")
