"""Institutions and how their deliveries are read: a registry that a file or code can extend."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.operators import ordered, project
from fundlens.operators import records as canonical_records
from fundlens.sources import files


@dataclass(frozen=True)
class Bank:
    """One institution.

    ``source`` and ``format`` say where its delivery lies; ``layout`` how its rows are written.  ``reader`` (spark,
    path) replaces the reader of the format, ``adapt`` changes canonical records, ``constants`` are fields that all
    its rows share, ``extra`` makes supplementary tables from the rows read.
    """

    id: str
    name: str = ""
    abbreviation: str = ""
    aliases: tuple[str, ...] = ()
    source: str = ""
    format: str | None = None
    layout: project.Layout = field(default_factory=project.Layout)
    constants: dict[str, object] = field(default_factory=dict)
    reader: Callable[[SparkSession, str], DataFrame] | None = None
    adapt: Callable[[DataFrame], DataFrame] | None = None
    extra: Callable[[DataFrame], dict[str, DataFrame]] | None = None


class Registry:
    """Banks by id or alias, without case, in the order they were added."""

    def __init__(self, banks: list[Bank] | None = None):
        self.banks: dict[str, Bank] = {}
        for b in banks or []:
            self.add(b)

    def add(self, bank: Bank) -> None:
        """Add a bank; a name that already means another bank is an error."""
        taken = {n for b in self.banks.values() if b.id != bank.id for n in self._names(b)}
        if clash := taken & self._names(bank):
            raise ValueError(f"{bank.id}: {sorted(clash)} is another bank's name")
        self.banks[bank.id] = bank

    @staticmethod
    def _names(bank: Bank) -> set[str]:
        return {n.lower() for n in (bank.id, bank.abbreviation, *bank.aliases) if n}

    def get(self, name: str) -> Bank:
        for b in self.banks.values():
            if name.strip().lower() in self._names(b):
                return b
        raise ValueError(f"unknown bank: {name}")

    @classmethod
    def read(cls, path: str) -> "Registry":
        """From a JSON list of banks; ``layout`` is an object with the fields of a layout. Unknown fields are an error."""
        with open(path, encoding="utf-8") as f:
            listed = json.load(f)
        made = cls()
        usual = {x.name for x in fields(project.Layout)}
        for b in listed:
            layout = b.pop("layout", {})
            if unknown := set(layout) - usual:
                raise ValueError(f"{b.get('id')}: unknown layout fields {sorted(unknown)}")
            layout = {k: tuple(v) if isinstance(v, list) else v for k, v in layout.items()}
            made.add(Bank(**{k: tuple(v) if k == "aliases" else v for k, v in b.items()}, layout=project.Layout(**layout)))
        return made


def read_source(spark: SparkSession, bank: Bank, path: str, fmt: str | None = None) -> DataFrame:
    """The rows of a bank's delivery under tidy names."""
    if bank.reader:
        return bank.reader(spark, path)
    df = files.read_rows(spark, path, fmt or bank.format)
    return project.json_columns(df) if "row" in df.columns else files.normalize_columns(df)


def collect(
    spark: SparkSession, bank: Bank, path: str, fmt: str | None = None, *, lists: project.CodeLists | None = None, first: int | None = None, last: int | None = None, most: int | None = None, include_raw: bool = False
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """A bank's canonical records and supplementary tables.

    Rows without a name are dropped, years outside the scope too, a row without a year is kept with a note; of
    rows with one id the first stands; ``most`` is a limit asked for.  A delivery without a named row is an error.
    """
    rows = read_source(spark, bank, path, fmt)
    if "_ord" not in rows.columns:
        rows = rows.withColumn("_ord", F.monotonically_increasing_id())
    if include_raw:
        rows = rows.withColumn("source_fields", F.to_json(F.struct(*[f"`{c}`" for c in rows.columns if c not in ("_ord", "path")])))
    layout = bank.layout if bank.layout.own_names else replace(bank.layout, own_names=tuple(n for n in (bank.abbreviation, bank.name) if n))
    got = project.named(project.canonical(rows, layout, lists, keep=("_ord", *(["source_fields"] if include_raw else []))))
    if bank.adapt:
        got = bank.adapt(got)
    got = got.withColumns({"bank_id": F.lit(bank.id), "bank_name": F.lit(bank.name), "bank_abbreviation": F.lit(bank.abbreviation), "pipeline_stage": F.lit(None).cast("tinyint")})
    got = got.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("approval_date", "commitment_date", "completion_date")})
    got = canonical_records.not_empty(project.with_constants(got, bank.constants), bank.id)
    got = canonical_records.finalize(got, first, last).withColumn("completion_date", F.col("completion_date").cast("date")).withColumns({c: F.col(c).cast("date") for c in ("approval_date", "commitment_date")})
    got = ordered.dedupe(project.complete(got), "bank_id", "project_id", "_ord").withColumn("source_url", F.lit(path))
    if most is not None:
        got = got.orderBy("_ord").limit(most)
    return got.drop("_ord"), bank.extra(rows) if bank.extra else {}
