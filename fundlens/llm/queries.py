"""Queries of the operators for training data (problems 1, 6, 7, 8, 9, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect, load, materialize
from fundlens.llm import canon, langid, linkage, mixing, packing, tokens, truth
from fundlens.operators import units


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "project_records")
    return truth.resolve(rows, load(spark, sf_dir, "official_sources"), fused=False).select("group_id", "survivor_id")


def p1_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per project: the survivor and the discovered value of every field."""
    rows = load(spark, sf_dir, "project_records")
    fields = ("loan_amount", "loan_currency", "project_name", "country", "approval_date", "status")
    return truth.resolve(rows, load(spark, sf_dir, "official_sources"), fields=fields)


def p6_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct typed country with its entry and score."""
    return canon.map_values(load(spark, sf_dir, "project_records").select("country"), load(spark, sf_dir, "ref_countries"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "project_records").select("row_id", "country")
    ref = load(spark, sf_dir, "ref_countries")
    odd = rows.join(ref.select(F.col("country_name").alias("country")), "country", "left_anti")
    mapped = canon.map_values(odd, ref)
    return odd.join(mapped.withColumnRenamed("typed", "country"), "country").select("row_id", "canon_code")


def p7_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and lines of the approvals list that are the same operation, with the confidence."""
    records = load(spark, sf_dir, "project_records")
    lines = load(spark, sf_dir, "isdb_approvals")
    ref, fx = load(spark, sf_dir, "ref_countries"), load(spark, sf_dir, "fx_rates")
    typed = records.select("country").union(lines.select("economy"))
    mapped = materialize(canon.map_values(typed, ref).where(F.col("canon_code") != canon.UNMATCHED).select(F.col("typed").alias("__typed"), "canon_code"))
    money = units.to_single_units(
        records.select(
            "row_id", "project_name", "country", "loan_amount", "loan_currency", "data_quality_notes", "official_source_id",
            "loan_amount_usd", "total_commitment", "commitment_currency", "approval_year", "commitment_year",
        ), fx, load(spark, sf_dir, "official_sources"),
    )
    rate = fx.select(F.col("series_code").alias("__code"), F.col("fx_year").alias("__year"), "units_per_usd")
    money = money.withColumn("__y", F.coalesce("approval_year", "commitment_year"))
    money = money.join(rate, (F.col("currency") == F.col("__code")) & (F.col("__y") == F.col("__year")), "left")
    own = F.when(F.col("currency") == "USD", F.lit(1.0)).otherwise(F.col("units_per_usd"))
    usd = F.coalesce(F.col("loan_amount_usd").cast("double"), F.col("single_amount").cast("double") / own)
    left = money.join(mapped, F.col("country") == F.col("__typed"), "left").select(
        F.col("row_id").alias("id"), F.col("project_name").alias("name"), F.col("canon_code").alias("country"), F.col("approval_year").alias("year"), F.when(usd > 0, usd).alias("usd")
    )
    right = lines.join(mapped, F.col("economy") == F.col("__typed"), "left").select(
        F.col("list_id").alias("id"), F.col("project_name").alias("name"), F.col("canon_code").alias("country"), F.col("approval_year").alias("year"),
        F.when(F.col("us_million") > 0, F.col("us_million") * 1e6).alias("usd"),
    )
    names = bounded_collect(ref.select("country_name", "alt_names"), canon.MAX_ENTRIES, "reference entries")
    country_words = sorted({t for r in names for n in [r[0] or "", *(r[1] or [])] for t in canon.words(canon.clean(n))})
    return linkage.link(left, right, country_words).select(F.col("lid").alias("row_id"), F.col("rid").alias("list_id"), "confidence")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_links(spark, sf_dir).select("row_id", "list_id")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(tokens.sizes(load(spark, sf_dir, "documents").select("doc_id", "text")), load(spark, sf_dir, "pack_specs"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every text, or piece of a larger text, goes for every capacity."""
    return _packed(spark, sf_dir)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(_packed(spark, sf_dir), load(spark, sf_dir, "pack_specs"))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = materialize(tokens.sizes(load(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep=("source",)))
    return mixing.mix(sizes, load(spark, sf_dir, "mix_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of every mixture with how often each is used."""
    return _mixed(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source of every recipe."""
    return _mixed(spark, sf_dir)[1]


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and paragraph with its language, confidence, and what the label said."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    langs = [(r["lang"], r["iso3"], r["lang_name"]) for r in bounded_collect(load(spark, sf_dir, "ref_langs"), 1000, "languages") if r["lang"]]
    labelled = docs.withColumn("label_lang", langid.label_language(F.col("lang"), langs))
    countries = [r[0] for r in bounded_collect(load(spark, sf_dir, "ref_countries").select("country_name"), canon.MAX_ENTRIES, "countries") if r[0]]
    return langid.segments(docs, langid.train(labelled, "text", "label_lang", "doc_id"), names=countries).join(labelled.select("doc_id", "label_lang"), "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = p10_segments(spark, sf_dir)
    per_doc = seg.groupBy("doc_id").agg(
        F.max(F.when(F.col("para_no") == 0, F.col("lang"))).alias("__whole"),
        F.first("label_lang").alias("__label"),
        (F.min(F.when(F.col("para_no") > 0, F.col("lang"))) != F.max(F.when(F.col("para_no") > 0, F.col("lang")))).alias("__mixed"),
    )
    cases = per_doc.where("__whole IS NOT NULL AND (__mixed OR __label IS NULL OR __label <> __whole)").select("doc_id", "__mixed")
    return seg.join(cases, "doc_id").where("para_no = 0 OR __mixed").select("doc_id", "para_no", "lang")


QUERIES = {
    "p1_found": p1_found,
    "p1_golden": p1_golden,
    "p6_found": p6_found,
    "p6_mapped": p6_mapped,
    "p7_found": p7_found,
    "p7_links": p7_links,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_segments": p10_segments,
}

ORACLE_SQL = {
    "p1_found": """
WITH x AS (SELECT *, nullif(regexp_replace(lower(project_id), '[^a-z0-9]', '', 'g'), '') AS p FROM project_records WHERE bank_id IS NOT NULL),
s AS (SELECT *, regexp_replace(regexp_replace(p, '[a-z]', 'A', 'g'), '[0-9]', '9', 'g') AS shape FROM x WHERE p IS NOT NULL),
u AS (SELECT bank_id, shape AS usual FROM s GROUP BY bank_id, shape QUALIFY row_number() OVER (PARTITION BY bank_id ORDER BY count(*) DESC, shape DESC) = 1),
k AS (SELECT s.*, CASE WHEN suffix(shape, usual) THEN right(p, length(usual)) ELSE p END AS k,
  CASE WHEN list_contains(o.roles, 'backbone') THEN 0 WHEN list_contains(o.roles, 'supplement') THEN 1 WHEN list_contains(o.roles, 'extra-fields') THEN 2 WHEN list_contains(o.roles, 'backstop') THEN 3 ELSE 4 END AS tier
  FROM s JOIN u USING (bank_id) LEFT JOIN official_sources o ON o.source_id = s.official_source_id),
r AS (SELECT *, count(*) OVER g AS n, min(row_id) OVER g AS group_id, row_number() OVER (PARTITION BY bank_id, k ORDER BY (loan_amount IS NULL), tier, source_updated_at DESC NULLS LAST, row_id) AS rk FROM k WINDOW g AS (PARTITION BY bank_id, k))
SELECT group_id, row_id AS survivor_id FROM r WHERE rk = 1 AND n > 1
""",
}
