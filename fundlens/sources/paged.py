"""Paged services as a Spark data source: one input partition per page, fields and limit pushed to the service.

The transport is a function ``fetch(url) -> bytes``, so tests and air-gapped runs need no network.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import urldefrag, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fundlens.sources.files import SourceError, record_list

#: Answers worth another try.
RETRIED = {408, 425, 429, 500, 502, 503, 504}


def backoff(attempt: int, retry_after: str | None = None, most: float = 30.0) -> float:
    """Seconds to wait before the next try: what the service asks for, else doubling, never above ``most``."""
    asked = float(retry_after) if retry_after and retry_after.isdigit() else 2.0**attempt
    return min(most, asked)


def fetch(url: str, tries: int = 4, timeout: float = 45.0, sleep: Callable[[float], None] = time.sleep, opener=urllib.request.urlopen, throttle: "Throttle | None" = None) -> bytes:
    """Bytes of an address; other answers and network errors are tried again."""
    for attempt in range(tries):
        try:
            if throttle:
                throttle.wait(url)
            with opener(urllib.request.Request(url, headers={"Accept-Encoding": "gzip"}), timeout=timeout) as r:
                data = r.read()
                return gzip.decompress(data) if data[:2] == b"\x1f\x8b" and not url.split("?")[0].endswith(".gz") else data
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or attempt == tries - 1:
                raise
            sleep(backoff(attempt, e.headers.get("Retry-After") if e.headers else None))
        except urllib.error.URLError:
            if attempt == tries - 1:
                raise
            sleep(backoff(attempt))
    raise AssertionError("unreachable")


class _Page(InputPartition):
    def __init__(self, url: str, offset: int):
        super().__init__(url)
        self.url, self.offset = url, offset


class PagedSource(DataSource):
    """Options: ``url`` with ``{offset}``, ``{limit}`` and ``{fields}``, ``total``, ``page_size``, ``fields``, ``max_rows``.

    A ``file:`` address reads landed pages.  Rows come as JSON text with ``_ord``, the offset of
    their page and their place in it; services without a stable order repeat rows over pages, so keep the first
    by ``_ord`` after the scan.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "_ord bigint, row string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.o = options

    def partitions(self) -> list[_Page]:
        size, total = int(self.o.get("page_size", 1000)), int(self.o["total"])
        total = min(total, int(self.o.get("max_rows", total)))
        fields = self.o.get("fields", "")
        return [_Page(self.o["url"].format(offset=a, limit=min(size, total - a), fields=fields), a) for a in range(0, total, size)]

    def read(self, partition: _Page) -> Iterator[tuple[int, str]]:
        url = partition.url
        data = Path(url[5:]).read_bytes() if url.startswith("file:") else fetch(url)
        for k, row in enumerate(record_list(json.loads(data))):
            yield partition.offset + k, json.dumps(row, ensure_ascii=False)


def read_paged(spark: SparkSession, **options: str) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").options(**options).load()


def pages_until_short(get: Callable[[int], list[dict]], size: int, key: str | None = None, most: int = 10_000) -> Iterator[dict]:
    """Rows of a service that only knows page numbers: pages until one is short; of rows with one ``key`` the first.

    A service that still gives full pages after ``most`` of them is an error, not an end.
    """
    seen: set = set()
    for k in range(most):
        rows = get(k)
        for r in rows:
            if key is None or r.get(key) is None or r[key] not in seen:
                seen.add(r.get(key))
                yield r
        if len(rows) < size:
            return
    raise SourceError(f"more than {most} pages")


def rank_resources(resources: list[dict], order: tuple[str, ...] = ("iati", "xml", "csv", "json")) -> list[dict]:
    """Resources of a data portal's package by preferred format, otherwise in their order."""
    place = {f: k for k, f in enumerate(order)}
    return sorted(resources, key=lambda r: place.get(str(r.get("format", "")).lower(), len(order)))


def first_with_rows(resources: list[dict], read: Callable[[dict], DataFrame], order: tuple[str, ...] = ("iati", "xml", "csv", "json")) -> tuple[dict, DataFrame]:
    """The first resource by rank that can be read and has rows, with its rows."""
    for r in rank_resources(resources, order):
        try:
            df = read(r)
        except SourceError:
            continue
        if not df.isEmpty():
            return r, df
    raise SourceError("no resource has rows")


def relevant(package: dict, words: tuple[str, ...] = (), all_of: tuple[str, ...] = (), not_in_url: tuple[str, ...] = ("organisation", "organization")) -> bool:
    """Whether a portal's package holds projects: its name has a word and all the required ones, no address says it is about an organisation."""
    name = f"{package.get('name', '')} {package.get('title', '')}".lower()
    urls = " ".join(str(r.get("url", "")) for r in package.get("resources", [])).lower()
    return (not words or any(w in name for w in words)) and all(w in name for w in all_of) and not any(w in urls or w in name for w in not_in_url)


def packages(get: Callable[[int], dict], keep: Callable[[dict], bool] = relevant) -> Iterator[dict]:
    """The packages of a portal's organisation that hold projects, page by page up to the stated count, with a note of where rows come from."""
    start = 0
    while True:
        answer = get(start)
        found = answer.get("results", [])
        for p in found:
            if keep(p):
                yield {**p, "_source_note": f"from the package {p.get('title') or p.get('name')}"}
        start += len(found)
        if not found or start >= int(answer.get("count", 0)):
            return


def crawl(start: str, links: Callable[[str], list[str]], wanted: Callable[[str], bool], most: int = 1000) -> list[str]:
    """Addresses of listing pages reachable from ``start`` on the same host, breadth first, each once; beyond ``most`` an error."""
    host, seen, todo = urlsplit(start).netloc, [start], [start]
    while todo:
        for link in links(todo.pop(0)):
            link = urldefrag(link)[0]
            if urlsplit(link).netloc == host and link not in seen and wanted(link):
                if len(seen) >= most:
                    raise SourceError(f"more than {most} listing pages")
                seen.append(link)
                todo.append(link)
    return seen


class Throttle:
    """Waits between two requests to one host."""

    def __init__(self, seconds: float = 0.75, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.seconds, self.clock, self.sleep, self.last = seconds, clock, sleep, {}

    def wait(self, url: str) -> None:
        host, now = urlsplit(url).netloc, self.clock()
        if host in self.last and (left := self.last[host] + self.seconds - now) > 0:
            self.sleep(left)
            now += left
        self.last[host] = now


def land(data: bytes, path: str, url: str | None = None, log: str | None = None) -> dict:
    """A raw answer written whole or not at all; its entry (address, time, size, digest) is appended to ``log``."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_suffix(target.suffix + ".part")
    part.write_bytes(data)
    part.replace(target)
    entry = {"url": url, "path": str(target), "at": datetime.now(UTC).isoformat(timespec="seconds"), "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}
    if log:
        with open(log, "a", encoding="utf-8") as f:
            f.write(json.dumps(entry) + "\n")
    return entry


def land_reference(data: bytes, path: str, url: str) -> dict:
    """A fetched reference list with a sidecar that says where and when it came from."""
    entry = land(data, path, url)
    land(json.dumps(entry, indent=2).encode(), f"{path}.meta.json")
    return entry
