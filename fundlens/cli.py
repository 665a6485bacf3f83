"""Command line: choose banks, years, sources and outputs; collect, combine and run the panel over the records."""

from __future__ import annotations

import argparse
import sys

# Default scope of years.
SCOPE = (2002, 2026)
FORMATS = ["csv", "json", "xlsx", "parquet"]
#: Fields whose filling the summary counts.
SUMMARY = ["country_code", "approval_year", "sector", "loan_amount", "total_commitment", "total_disbursement", "cofinancing_partners"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fundlens")
    p.add_argument("--data", required=True, help="folder of canonical tables")
    p.add_argument("--registry", help="JSON list of banks with their sources and layouts")
    p.add_argument("--landing", default=None, help="folder for what --source-url fetches, OUTPUT/landing if left out")
    p.add_argument("--parallel", type=int, default=1, help="banks collected at a time")
    p.add_argument("--include-raw", action="store_true", help="keep the delivered row beside the record")
    p.add_argument("--bank", action="append", default=[], help="bank id; may be repeated")
    p.add_argument("--banks", default="", help="bank ids separated by commas")
    p.add_argument("--all-banks", action="store_true")
    p.add_argument("--list-banks", action="store_true")
    p.add_argument("--min-year", type=int, default=SCOPE[0])
    p.add_argument("--max-year", type=int, default=SCOPE[1])
    p.add_argument("--max-projects", type=int)
    p.add_argument("--source-file", action="append", default=[], metavar="BANK=PATH")
    p.add_argument("--source-url", action="append", default=[], metavar="BANK=URL")
    p.add_argument("--source-format", action="append", default=[], metavar="BANK=FORMAT")
    p.add_argument("--no-official", action="store_true")
    p.add_argument("--strict-backstop", action="store_true")
    p.add_argument("--allow-partial", action="store_true")
    p.add_argument("--output-dir", default="output")
    p.add_argument("--format", action="append", choices=FORMATS, default=None)
    p.add_argument("--combine", action="store_true")
    p.add_argument("--combine-only", action="store_true")
    p.add_argument("--dyad", action="store_true", help="write the panels")
    return p


def pairs(values: list[str]) -> dict[str, str]:
    """BANK=VALUE options as a map."""
    out = {}
    for v in values:
        bank, eq, value = v.partition("=")
        if not eq or not bank or not value:
            raise ValueError(f"expected BANK=VALUE: {v}")
        out[bank.strip().lower()] = value
    return out


def chosen(args: argparse.Namespace, known: list[str], aliases: dict[str, str] | None = None) -> list[str]:
    """Banks in the order asked for, once each, by id or alias."""
    if args.all_banks:
        return list(known)
    asked = [*args.bank, *[b for b in args.banks.split(",") if b.strip()]]
    low = {**{k.lower(): k for k in known}, **{a.lower(): b for a, b in (aliases or {}).items()}}
    out = []
    for a in asked:
        bank = low.get(a.strip().lower())
        if bank is None:
            raise ValueError(f"unknown bank: {a}")
        if bank not in out:
            out.append(bank)
    return out


def check(args: argparse.Namespace) -> None:
    """Rules between options."""
    if args.min_year > args.max_year:
        raise ValueError("--min-year is after --max-year")
    if args.max_projects is not None and args.max_projects <= 0:
        raise ValueError("--max-projects must be positive")
    if args.dyad and not (args.combine or args.combine_only):
        raise ValueError("--dyad needs --combine or --combine-only")
    if args.combine_only and args.format and args.format != ["csv"]:
        raise ValueError("--combine-only reads and writes CSV")
    if args.parallel < 1:
        raise ValueError("--parallel must be at least 1")
    for option in (args.source_file, args.source_url, args.source_format):
        pairs(option)


def exit_code(failed: int, backstop_failed: int, allow_partial: bool, strict: bool) -> int:
    """2 if a bank failed unless that is allowed, 3 if a strict backstop failed; the larger of both."""
    return max(2 if failed and not allow_partial else 0, 3 if backstop_failed and strict else 0)


def known_banks(spark, args: argparse.Namespace):  # noqa: ANN001, ANN201
    """The registry, extended by the banks of the canonical table that it doesn't list."""
    from fundlens.core.tables import bounded_collect, load
    from fundlens.sources.registry import Bank, Registry

    registry = Registry.read(args.registry) if args.registry else Registry()
    rows = load(spark, args.data, "project_records")
    for bank in sorted(r[0] for r in bounded_collect(rows.select("bank_id").distinct(), 10_000, "banks") if r[0]):
        if bank not in registry.banks:
            registry.add(Bank(bank))
    return registry


def bank_records(spark, args: argparse.Namespace, registry, bank_id: str):  # noqa: ANN001, ANN201
    """A bank's records from its file, its address (landed first), its registered source, else the canonical table."""
    from pyspark.sql import functions as F

    from fundlens.core.tables import load
    from fundlens.operators.project import CodeLists
    from fundlens.sources import files, paged
    from fundlens.sources.registry import collect

    bank = registry.get(bank_id)
    low = lambda option: {registry.get(k).id: v for k, v in pairs(option).items()}
    fmt = low(args.source_format).get(bank.id)
    path = low(args.source_file).get(bank.id)
    if path is None and (url := low(args.source_url).get(bank.id)):
        landing = args.landing or f"{args.output_dir}/landing"
        path = f"{landing}/{bank.id}.{fmt or files.infer_format(url)}"
        paged.land(paged.fetch(url), path, url, f"{landing}/fetched.jsonl")
    path = path or bank.source
    if path:
        lists = CodeLists(countries=load(spark, args.data, "ref_countries"))
        return collect(spark, bank, path, fmt, lists=lists, first=args.min_year, last=args.max_year, most=args.max_projects, include_raw=args.include_raw)
    year = F.coalesce("approval_year", "commitment_year")
    # a row without a year passes the scope of collection and is noted, not dropped
    kept = load(spark, args.data, "project_records").where((F.col("bank_id") == bank.id) & (year.isNull() | year.between(args.min_year, args.max_year)))
    if args.no_official:
        kept = kept.where("official_source_id IS NULL")
    return (kept.orderBy("row_id").limit(args.max_projects) if args.max_projects else kept), {}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        check(args)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce
    from pathlib import Path

    from pyspark.sql import DataFrame, SparkSession
    from pyspark.sql import functions as F

    from fundlens.core.tables import materialize
    from fundlens.operators import audit
    from fundlens.plans.domain import backstop_status
    from fundlens.sources import sinks

    spark = SparkSession.builder.appName("fundlens").getOrCreate()
    try:
        registry = known_banks(spark, args)
        if args.list_banks:
            print("\n".join(registry.banks))
            return 0
        banks = chosen(args, list(registry.banks), {n: b.id for b in registry.banks.values() for n in registry._names(b)})
        for option in (args.source_file, args.source_url, args.source_format):
            for name in pairs(option):
                registry.get(name)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    out = Path(args.output_dir)
    out.mkdir(parents=True, exist_ok=True)
    formats, failures, outputs = args.format or ["csv"], {}, {}
    if args.combine_only:
        missing = [b for b in banks if not (out / f"records_{b}_csv").exists()]
        if missing and not args.allow_partial:
            print(f"not collected: {', '.join(missing)}", file=sys.stderr)
            return 2
        there = [b for b in banks if b not in missing]
        frames = [sinks.read_csv_file(spark, str(out / f"records_{b}_csv"), spark.read.csv(str(out / f"records_{b}_csv"), header=True).columns) for b in there]
        info = sinks.combine_layouts(frames, [str(out / f"records_{b}_csv") for b in there], str(out / "records_all_csv")) if there else {}
        sinks.manifest(str(out / "manifest.json"), mode="combine-only", banks=there, missing=missing, combined=info)
    else:

        def one(bank: str) -> tuple[str, DataFrame | None, dict, str]:
            try:
                records, extra = bank_records(spark, args, registry, bank)
                return bank, materialize(records), extra, ""
            except Exception as e:  # another bank's run goes on; the manifest says what failed
                return bank, None, {}, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"

        with ThreadPoolExecutor(max(1, args.parallel)) as pool:
            got = list(pool.map(one, banks))
        failures = {b: why for b, r, _, why in got if r is None}
        done = [(b, r, extra) for b, r, extra, _ in got if r is not None]
        for bank, records, extra in done:
            for fmt in formats:
                outputs[f"{bank}.{fmt}"] = sinks.write(records, fmt, str(out / f"records_{bank}_{fmt}"))
            for name, table in extra.items():
                outputs[f"{bank}.{name}"] = sinks.write(table, "csv", str(out / f"{bank}_{name}_csv"))
        if done:
            every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [r for _, r, _ in done])
            counts = sinks.summary(every, [c for c in SUMMARY if c in every.columns])
            rows = {r["bank_id"]: r.asDict() for r in counts.limit(len(banks)).collect()}
            sinks.write_csv_file(counts, str(out / "summary.csv"), ["bank_id"])
            for bank, records, _ in done:
                common = audit.note_frequency(records.withColumnRenamed("bank_id", "__b").withColumn("row_id", F.monotonically_increasing_id()), "data_quality_notes", "row_id").orderBy("n", ascending=False).limit(10)
                (out / f"report_{bank}.md").write_text(sinks.report(bank, rows.get(bank, {}), [(r["note"], r["n"]) for r in common.collect()]), encoding="utf-8")
            if args.combine:
                for fmt in formats:
                    outputs[f"all.{fmt}"] = sinks.write(every, fmt, str(out / f"records_all_{fmt}"))
        for bank, why in failures.items():
            print(f"{bank}: {why}", file=sys.stderr)
            (out / f"report_{bank}.md").write_text(sinks.failure_report(bank, why), encoding="utf-8")
        sinks.manifest(
            str(out / "manifest.json"), mode="collect", banks=[b for b, _, _ in done], requested=banks, failures=failures, scope=[args.min_year, args.max_year], outputs=outputs,
            source_files={k: {"path": v, "sha256": sinks.sha256(v) if Path(v).is_file() else None} for k, v in pairs(args.source_file).items()}, source_urls=pairs(args.source_url),
        )
    if args.dyad:
        panels(spark, args, banks)
    strict = backstop_status(spark, args.data).where("status = 'fail'").limit(1).count() if args.strict_backstop else 0
    return exit_code(len(failures), strict, args.allow_partial, args.strict_backstop)


def panels(spark, args: argparse.Namespace, banks: list[str]) -> None:  # noqa: ANN001
    """The panel and what has no country, over the canonical table."""
    from fundlens.operators import panel
    from fundlens.plans.domain import operations

    ops = operations(spark, args.data)
    ops = ops.where(ops["bank_id"].isin(banks))
    panel.panel(ops, args.min_year, args.max_year).write.mode("overwrite").parquet(f"{args.output_dir}/panel")
    panel.unallocated(ops, args.min_year, args.max_year).write.mode("overwrite").parquet(f"{args.output_dir}/unallocated")


if __name__ == "__main__":
    sys.exit(main())
