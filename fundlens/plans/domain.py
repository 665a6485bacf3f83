"""Queries of conversion, panels, ordered semantics, reconciliation and audits on the domain tables, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect, load
from fundlens.functions import codes, dates, money, numbers, text
from fundlens.operators import audit, ids, ordered, panel, project, reconcile, theta
from fundlens.operators import records as canonical_records
from fundlens.sources import html, official, sinks
from fundlens.streaming import landing

FIRST, LAST, TODAY = 2002, 2026, "2026-03-15"
#: Above this a non-official dollar amount is tested for being local currency.
SUSPECT = 4e8


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "project_records")


def _price_levels(ref: DataFrame) -> DataFrame:
    """Price levels made from a rule: the real ones are not part of the data."""
    a = lambda k: F.ascii(F.substring("iso3", k, 1))
    lands = ref.where(a(3) % 7 != 0).select(F.col("iso3").alias("code"), (1000 + 7 * a(1)).alias("gdp_usd"), (2000 + 13 * a(2)).alias("gdp_ppp"))
    return lands.withColumn("year", F.explode(F.sequence(F.lit(2000), F.lit(2025))))


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a valid country code or none, instrument, and amounts in cents."""
    ref = load(spark, sf_dir, "ref_countries")
    r = records(spark, sf_dir).select(
        "row_id", "bank_id", "country", F.upper(F.trim("country_code")).alias("__c"), "approval_year", "commitment_year", "loan_amount", "loan_currency", "loan_amount_usd",
        "loan_type", "official_source_id", "concessional", text.instrument_category(F.col("financing_instrument")).alias("instrument"),
    )
    r = r.join(ref.select(F.col("iso3").alias("code")), F.col("__c") == F.col("code"), "left").withColumn("country_code", F.col("code")).drop("__c")
    deflator = spark.range(2000, 2026).select(F.col("id").cast("int").alias("year"), (F.lit(60) + F.lit("1.6").cast("decimal(4,1)") * (F.col("id") - 2000)).cast("decimal(12,3)").alias("deflator"))
    pegs = spark.createDataFrame([("SDR", "XDR")], "currency string, series string")
    which = F.element_at(F.array(F.lit("QKR"), F.lit("QTN"), F.lit("QMB"), F.lit("EUR")), F.ascii("iso3") % 4 + 1)
    areas = ref.select(F.col("iso3").alias("area"), which.alias("series"), F.lit(1).alias("ord"))
    return money.convert(r, load(spark, sf_dir, "fx_rates"), deflator, _price_levels(ref), pegs, areas, suspect_amount=SUSPECT)


def _windows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("cor", 2005, None), ("kdb", None, 2023), ("nrb", 2008, 2024)], "bank_id string, start_year int, end_year int")


def _q(ops_fn):
    return lambda spark, sf_dir: ops_fn(operations(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    return r.withColumn("approval_date", F.col("approval_date").try_cast("date")).withColumn("commitment_date", F.col("commitment_date").try_cast("date"))


def convert_constant_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operations(spark, sf_dir).select("row_id", "conversion", "analysis_year", "nominal_cents", "constant_cents", "ppp_cents", "ppp_constant_cents")


def panel_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = panel.panel(operations(spark, sf_dir), FIRST, LAST).select("bank_id", "code", "year", "n_operations", "usd_2025_total")
    return panel.balanced(cells, _windows(spark), FIRST, LAST)


def panel_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty unless the panel loses something."""
    ops = operations(spark, sf_dir)
    return panel.broken(panel.panel(ops, FIRST, LAST), panel.unallocated(ops, FIRST, LAST), panel.control(ops, FIRST, LAST))


def panel_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals that fail where the panel lost the rows of one bank and year."""
    ops = operations(spark, sf_dir)
    lossy = ops.where("NOT (coalesce(bank_id = 'kdb', false) AND coalesce(analysis_year = 2010, false))")
    return panel.broken(panel.panel(lossy, FIRST, LAST), panel.unallocated(ops, FIRST, LAST), panel.control(ops, FIRST, LAST))


def panel_private_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = operations(spark, sf_dir)
    private = ops.where("loan_type = 'Non-sovereign' AND code IS NOT NULL").select("bank_id", "code", F.col("analysis_year").alias("year"), F.lit(1).alias("n"), "nominal_cents", "constant_cents").where("year IS NOT NULL")
    cells = panel.panel(ops.where("NOT (loan_type <=> 'Non-sovereign')"), FIRST, LAST).select("bank_id", "code", "year", "n_operations")
    return panel.with_outer(cells, panel.private_totals(private))


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.dedupe(records(spark, sf_dir).select("row_id", "bank_id", "project_id", "load_no"), "bank_id", "project_id", "row_id")


def newest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).select("row_id", "bank_id", "project_id", "load_no")
    live, one, two = r.where("load_no > 2"), r.where("load_no = 2"), r.where("load_no = 1")
    return ordered.newest_snapshot(live, [one, two], "project_id", "row_id").select("row_id", "project_id")


def first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.labels(records(spark, sf_dir), ["bank_id", "country_code"], "country", "row_id")


def last_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.labels(records(spark, sf_dir), ["bank_id"], "bank_abbreviation", "row_id", last=True)


def first_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.first_filled(records(spark, sf_dir), ["bank_id", "project_id"], ["status", "sector", "loan_type"], "row_id")


def occurrence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "isdb_approvals").select("list_id", "economy", "approval_year")
    return ordered.occurrence_ids(a, ["economy", "approval_year"], "list_id", "ap-")


def ordered_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.ordered_concat(records(spark, sf_dir).where("country_code IS NOT NULL"), ["bank_id", "country_code"], "status", "row_id")


def union_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All banks' rows as inputs of one layout, each with its number."""
    r = records(spark, sf_dir).select("row_id", "bank_id", "loan_amount")
    banks = sorted(b[0] for b in bounded_collect(r.select("bank_id").distinct(), 10_000, "banks") if b[0] is not None)
    return ordered.union_checked([r.where(F.col("bank_id") == b) for b in banks]).groupBy("__input", "bank_id").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("__input", "input_no")


def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources in records that the list lacks, and the other way round."""
    a = records(spark, sf_dir).where("official_source_id IS NOT NULL").select(F.col("official_source_id").alias("source_id"))
    b = load(spark, sf_dir, "official_sources").select("source_id")
    return a.exceptAll(b).distinct().subtract(b).withColumn("side", F.lit("records")).unionByName(b.subtract(a).withColumn("side", F.lit("list"))).unionByName(a.intersect(b).withColumn("side", F.lit("both")))


def coverage_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.coverage(_dated(spark, sf_dir), _windows(spark), FIRST, LAST, TODAY)


def coverage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.flag_rollup(coverage_by_year(spark, sf_dir))


_FILL = ["province", "latitude", "approval_date", "status", "sector", "loan_amount", "interest_rate", "cofinancing_partners"]


def fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    either = {"any_year": ["approval_year", "commitment_year"], "any_disbursement": ["total_disbursement", "first_disbursement_date"]}
    return audit.fill_rates(records(spark, sf_dir), "bank_id", _FILL, either, zero="loan_amount")


def note_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.note_frequency(records(spark, sf_dir), "data_quality_notes", "row_id")


def _official_and_ours(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows of backstop sources, and all others as ours."""
    src = load(spark, sf_dir, "official_sources").where(F.array_contains("roles", "backstop")).select(F.col("source_id").alias("official_source_id"))
    r = records(spark, sf_dir).withColumn("year", F.coalesce("approval_year", "commitment_year"))
    return r.join(src, "official_source_id", "left_semi"), r.join(src, "official_source_id", "left_anti")


def backstop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_checks(*_official_and_ours(spark, sf_dir), FIRST, LAST, 0.95)


def backstop_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.visibility_checks(*_official_and_ours(spark, sf_dir), ["province", "status", "interest_rate", "loan_amount"])


def backstop_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.amount_checks(*_official_and_ours(spark, sf_dir), FIRST, LAST)


def backstop_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backstop_counts(spark, sf_dir).select("bank_id", "status")


def backstop_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.status_pivot(backstop_status(spark, sf_dir))


def _backbone_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    src = load(spark, sf_dir, "official_sources").where(F.array_contains("roles", "backbone")).select(F.col("source_id").alias("official_source_id"))
    r = _dated(spark, sf_dir).withColumn("key", F.concat_ws(":", "bank_id", F.lower(text.strip(F.col("project_id"))))).withColumn("ord", F.col("row_id"))
    return r.join(src, "official_source_id", "left_semi"), r.where("official_source_id IS NULL")


def backbone_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.backbone(*_backbone_sides(spark, sf_dir), fields=["province", "status", "sector"])


def backbone_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    official_rows, live = _backbone_sides(spark, sf_dir)
    outside = text.instrument_category(F.col("financing_instrument")) == "trade_finance"
    return reconcile.unmatched(live, official_rows, "2015-12-31", outside).select("row_id", "decision")


def group_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = ids.canonical_ids(_dated(spark, sf_dir)).withColumn("ord", F.col("row_id")).withColumn("instrument", text.instrument_category(F.col("financing_instrument")))
    r = r.withColumn("number", F.when(F.col("project_key").rlike(r"^\d{8}$"), F.regexp_replace("project_key", r"^(\d{5})", "$1-")))
    return reconcile.group_by_number(r, "number")


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with ``key``, bank and canonical id, and ``roles`` of their official source."""
    src = load(spark, sf_dir, "official_sources").select(F.col("source_id").alias("official_source_id"), "roles")
    r = ids.canonical_ids(records(spark, sf_dir)).withColumn("key", F.concat("bank_id", F.lit(":"), "project_key"))
    return r.join(src, "official_source_id", "left")


def supplement_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of supplement sources and their project: a row of a backbone list, else a collected one."""
    r = _keyed(spark, sf_dir)
    mine = [F.col("row_id").alias("id"), F.col("country_code").alias("country"), F.col("approval_year").alias("year")]
    listed = F.coalesce(F.array_contains("roles", "backbone"), F.lit(False))
    loans = r.where(F.array_contains("roles", "supplement")).select(*mine, F.col("key").alias("number"))
    projects = r.where(listed | F.col("official_source_id").isNull()).where("key IS NOT NULL")
    return reconcile.supplement(loans, projects.select(*mine, F.struct((~listed).alias("l"), "row_id").alias("ord"), F.array("key").alias("numbers")))


def loan_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of every project of the banks' supplements (lists of loans)."""
    src = load(spark, sf_dir, "official_sources").where(F.array_contains("roles", "supplement")).select(F.col("source_id").alias("official_source_id")).distinct()
    r = records(spark, sf_dir).join(src, "official_source_id", "left_semi").withColumn("last_date", F.col("last_disbursement_date").try_cast("date"))
    return reconcile.loan_terms(r, "bank_id", "project_id")


def extra_fields_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected rows of the banks that have a source for extra fields, filled from it."""
    r = _keyed(spark, sf_dir).select(F.col("row_id").alias("id"), F.col("row_id").alias("ord"), "key", "bank_id", "province", "completion_date", "financing_instrument", "official_source_id", "roles")
    extra = r.where(F.array_contains("roles", "extra-fields"))
    banks = load(spark, sf_dir, "official_sources").where(F.array_contains("roles", "extra-fields")).select(F.explode("bank_ids").alias("bank_id")).distinct()
    mine = r.where("official_source_id IS NULL").join(banks, "bank_id", "left_semi").select("id", "key", "province", "completion_date", "financing_instrument")
    return reconcile.extra_fields(mine, extra, ["province", "completion_date"], "financing_instrument")


def fuzzy_match_1to1(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "isdb_approvals").select(F.col("list_id").alias("id"), F.col("project_name").alias("name"), F.col("economy").alias("country"), F.col("approval_year").alias("year"), (F.col("us_million") * 1e6).alias("usd"))
    r = records(spark, sf_dir).where("loan_type <> 'Non-sovereign' OR loan_type IS NULL").select(F.col("row_id").alias("id"), F.col("project_name").alias("name"), "country", F.col("approval_year").alias("year"), F.col("loan_amount_usd").cast("double").alias("usd"))
    return reconcile.greedy_one_to_one(reconcile.fuzzy_pairs(a, r), "country").select("lid", "oid", "score")


def absorb_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approvals absorbed by records of the same country code and year of the dates; names without a code share one block."""
    tiers = codes.country_tiers(load(spark, sf_dir, "ref_countries"))
    coded = lambda df, name: codes.tiered_lookup(df, name, tiers, "__code").withColumn("country", F.coalesce("__code", F.lit("")))
    a = coded(load(spark, sf_dir, "isdb_approvals"), "economy").select(F.col("list_id").alias("id"), F.col("project_name").alias("name"), "country", F.col("approval_year").alias("year"), (F.col("us_million") * 1e6).alias("amount"), F.col("list_id").alias("ord"))
    r = coded(_dated(spark, sf_dir), "country").withColumn("year", F.coalesce(F.year("approval_date"), F.year("commitment_date")))
    return reconcile.absorb(a, r.select(F.col("row_id").alias("id"), F.col("project_name").alias("name"), "country", "year", F.col("loan_amount_usd").alias("amount"), F.col("row_id").alias("ord")))


def _donor_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = records(spark, sf_dir)
    soft = F.coalesce(F.col("concessional") == "Yes", F.lit(False))
    rows = r.where("official_source_id IS NOT NULL AND approval_year IS NOT NULL").select("bank_id", F.col("approval_year").alias("year"), F.col("project_id").alias("number"), F.col("loan_amount_usd").alias("commitment"), soft.alias("soft"))
    return rows, r.where("official_source_id IS NULL").select("bank_id", F.col("project_id").alias("id"))


def theta_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ids = _donor_rows(spark, sf_dir)
    return theta.contained_keys(rows.select("bank_id", F.col("number").alias("key")), ids, "bank_id")


def donor_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return theta.donor_profile(*_donor_rows(spark, sf_dir))


_PREFIXES = [("kdb", "karst"), ("nrb", "north"), ("any", "n"), ("sil", "silt basin")]


def prefix_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return theta.first_prefix(records(spark, sf_dir).select("row_id", "bank_name"), "bank_name", _PREFIXES).select("row_id", "owner")


def member_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose name mentions exactly one country of the list, by its name or another name."""
    ref = load(spark, sf_dir, "ref_countries").select("iso3", "country_name", "alt_names")
    names = [(n, r["iso3"]) for r in bounded_collect(ref, 50_000, "countries") for n in [r["country_name"], *(r["alt_names"] or [])] if n]
    return theta.single_member(records(spark, sf_dir).select("row_id", "project_name"), "row_id", "project_name", names)


def scalar_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("row_id", numbers.detect_currency(F.col("loan_currency")).alias("currency"))


def scalar_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole part of every record's amount, written in six notations and read again."""
    r = records(spark, sf_dir).select("row_id", F.abs(F.floor("loan_amount")).cast("decimal(24,0)").alias("n"))
    grouped = F.format_number("n", 0)
    notations = {
        "worded": F.concat(F.lit("EUR "), F.col("n").cast("string"), F.lit(".25 million")),
        "grouped": F.concat(F.lit("USD "), grouped, F.lit(".50")),
        "spanish": F.concat(F.col("n").cast("string"), F.lit(",5 millones de euros")),
        "bracketed": F.concat(F.lit("(US$ "), grouped, F.lit(")")),
        "unit of account": F.concat(F.lit("SDR "), F.col("n").cast("string"), F.lit(" mn")),
        "blanks": F.concat(F.lit("£ "), F.translate(grouped, ",", " ")),
    }
    made = r.select("row_id", F.explode(F.array(*[F.struct(F.lit(k).alias("notation"), v.alias("text")) for k, v in notations.items()])).alias("c")).select("row_id", "c.*")
    return made.select("row_id", "notation", numbers.parse_amount(F.col("text")).alias("a")).select("row_id", "notation", F.col("a.amount").cast("double").alias("amount"), "a.currency")


def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("approval_date").try_cast("date")
    r = records(spark, sf_dir).where(day.isNotNull())
    made = F.date_format(day, "dd/MM/yyyy")
    return r.select(
        "row_id", dates.parse_date(made, day_first=True).cast("string").alias("day_first"), dates.parse_date(made).cast("string").alias("unknown_order"),
        dates.parse_date(F.date_format(day, "d MMMM yyyy")).cast("string").alias("worded"), dates.extract_year(F.lit("none"), made).alias("year"),
        dates.duration_years(day, F.col("completion_date").try_cast("date")).cast("double").alias("years"),
    )


def scalar_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("row_id", text.loan_type(F.col("loan_type")).alias("loan_type"), text.instrument_category(F.col("financing_instrument")).alias("instrument"))


def fold_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("row_id", F.lower(text.ascii_fold(F.col("project_name"))).alias("folded"))


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit('<p><a href="'), F.col("project_url"), F.lit('#top">'), F.col("bank_name"), F.lit("</a></p>"))
    pages = records(spark, sf_dir).where("project_url IS NOT NULL AND bank_name IS NOT NULL").select("row_id", page.alias("html"), F.lit("https://x.example/").alias("base"))
    return html.links(pages, "row_id", "html", "base").select("row_id", "pos", "href", "label")


def list_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return official.group_list(load(spark, sf_dir, "afdb_projects"))


def approvals_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return official.approvals(load(spark, sf_dir, "isdb_approvals"))


_LIST_LAYOUT = project.Layout(
    aliases={
        "project_id": ["afdb_identifier"], "sector": ["afdb_sector"], "funding_window": ["afdb_status"], "total_commitment": ["total_commitments_usd"], "total_disbursement": ["total_disbursements_usd"],
    },
    soft=("adf",), hard=("adb",), dot_is_decimal=True,
)
_APPROVALS_LAYOUT = project.Layout(aliases={"loan_amount": ["usd"], "location_text": ["description"]}, default_currency="USD", dot_is_decimal=True)
_PROJECTED = ["project_id", "project_name", "country", "country_code", "approval_date", "approval_year", "commitment_date", "completion_date", "status", "sector", "financing_instrument", "concessional", "loan_amount", "loan_currency", "loan_amount_usd", "total_commitment", "commitment_currency", "total_commitment_usd", "total_disbursement", "disbursement_currency", "total_disbursement_usd", "data_quality_notes"]


def project_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group's list as canonical records."""
    lists = project.CodeLists(countries=load(spark, sf_dir, "ref_countries"))
    return project.canonical(load(spark, sf_dir, "afdb_projects"), _LIST_LAYOUT, lists, keep=("rec_no",)).select("rec_no", *_PROJECTED)


def project_approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of approvals, in millions and without ids, as canonical records."""
    lists = project.CodeLists(countries=load(spark, sf_dir, "ref_countries"))
    rows = load(spark, sf_dir, "isdb_approvals").withColumn("usd", (F.col("us_million").cast("decimal(18,6)") * 1_000_000).cast("decimal(22,4)"))
    return project.canonical(rows, _APPROVALS_LAYOUT, lists, keep=("list_id",)).select("list_id", *_PROJECTED)


def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of every bank's records."""
    return sinks.summary(records(spark, sf_dir), ["country_code", "sector", "loan_amount", "cofinancing_partners"])


def merged_and_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official rows after the merge, and the collected rows kept beside them, as one table."""
    official_rows, live = _backbone_sides(spark, sf_dir)
    merged = reconcile.backbone(official_rows, live, fields=["province", "status", "sector"]).withColumn("row_id", F.lit(None).cast("long"))
    every = project.merged_and_kept(merged, live.select("row_id", "key", "province", "status", "sector", "loan_amount", "loan_currency"), backbone_unmatched(spark, sf_dir))
    return every.select("row_id", "key", "province", "status", "sector", "loan_amount", "loan_currency", "origin")


def merge_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the merge filled a field that the official row left empty."""
    official_rows, live = _backbone_sides(spark, sf_dir)
    base = ordered.first_by(official_rows.where("key IS NOT NULL"), [F.col("key")], F.col("ord"))
    fields = ["province", "status", "sector", "loan_amount", "total_disbursement"]
    return project.fill_counts(base.select("key", *fields), reconcile.backbone(official_rows, live, fields=["province", "status", "sector"]), "key", fields)


def project_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects of backbone lists with the sums and terms of their loans from the supplements, own money only."""
    r = _keyed(spark, sf_dir).where("key IS NOT NULL")
    loans = r.where(F.array_contains("roles", "supplement")).select(
        F.col("key").alias("project_id"), F.col("loan_amount").alias("principal"), F.col("total_disbursement").alias("disbursed"), "interest_rate",
        F.col("completion_date").try_cast("date").alias("last_repayment_date"), F.col("approval_date").try_cast("date").alias("board_approval_date"),
    )
    projects = r.where(F.array_contains("roles", "backbone")).select("row_id", F.col("key").alias("project_id"), "status", F.col("loan_amount_usd").alias("arm_amount"))
    return project.own_money(project.with_loans(projects, loans))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.windowed_counts(load(spark, sf_dir, "events")).select(F.col("start").cast("string").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def star_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by region, nation and year over the star tables: joins in one pass, partial sums before the shuffle."""
    t = lambda n: load(spark, sf_dir, n)
    cents = F.sum((F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)"))
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_lines"), cents.cast("double").alias("revenue"))


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO codes by code, name or other name: exact tiers, nothing guessed."""
    ref = load(spark, sf_dir, "ref_countries")
    return codes.tiered_lookup(records(spark, sf_dir).select("row_id", "country"), "country", codes.country_tiers(ref), "code")


def record_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_records.split_valid(records(spark, sf_dir))[1].select("row_id", F.array_join("problems", "; ").alias("problems"))


def finalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_records.finalize(records(spark, sf_dir), FIRST, LAST).select("row_id", "approval_year", F.col("total_commitment").cast("double").alias("total_commitment"), "commitment_currency", F.col("pipeline_stage").cast("int").alias("pipeline_stage"))


QUERIES = {
    "country_codes": country_codes,
    "record_problems": record_problems,
    "finalized": finalized,
    "convert_constant_usd": convert_constant_usd,
    "panel_country_year": _q(lambda o: panel.panel(o, FIRST, LAST)),
    "panel_unallocated": _q(lambda o: panel.unallocated(o, FIRST, LAST)),
    "panel_control": _q(lambda o: panel.control(o, FIRST, LAST)),
    "panel_levels": _q(lambda o: panel.with_totals(o, FIRST, LAST)),
    "panel_balanced": panel_balanced,
    "panel_invariant": panel_invariant,
    "panel_broken": panel_broken,
    "panel_private_outer": panel_private_outer,
    "conversion_tally": _q(panel.conversion_tally),
    "ppp_missing": _q(panel.ppp_missing),
    "top10_ops": _q(lambda o: panel.top(o).select("row_id", "bank_id", "constant_cents")),
    "dedupe_first": dedupe_first,
    "newest_snapshot": newest_snapshot,
    "first_label": first_label,
    "last_label": last_label,
    "first_filled": first_filled,
    "occurrence_ids": occurrence_ids,
    "ordered_concat": ordered_concat,
    "union_layout": union_layout,
    "set_ops": set_ops,
    "coverage_by_year": coverage_by_year,
    "coverage_flags": coverage_flags,
    "fill_rates": fill_rates,
    "note_frequency": note_frequency,
    "backstop_counts": backstop_counts,
    "backstop_visibility": backstop_visibility,
    "backstop_amounts": backstop_amounts,
    "backstop_pivot": backstop_pivot,
    "backbone_merge": backbone_merge,
    "backbone_unmatched": backbone_unmatched,
    "group_by_number": group_by_number,
    "supplement_attach": supplement_attach,
    "loan_terms": loan_terms,
    "extra_fields_fill": extra_fields_fill,
    "fuzzy_match_1to1": fuzzy_match_1to1,
    "absorb_match": absorb_match,
    "theta_contains": theta_contains,
    "donor_profile": donor_profile,
    "prefix_first": prefix_first,
    "member_containment": member_containment,
    "scalar_currency": scalar_currency,
    "scalar_amount": scalar_amount,
    "scalar_dates": scalar_dates,
    "scalar_types": scalar_types,
    "fold_names": fold_names,
    "html_links": html_links,
    "list_reader": list_reader,
    "approvals_reader": approvals_reader,
    "project_list": project_list,
    "project_approvals": project_approvals,
    "summary_counts": summary_counts,
    "merged_and_kept": merged_and_kept,
    "merge_fills": merge_fills,
    "project_loans": project_loans,
    "event_windows": event_windows,
    "star_revenue": star_revenue,
}
