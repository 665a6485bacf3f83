"""From a delivered row to a canonical record: one projection per layout.

Every target field takes the first of its alias columns that holds something, decided per row; which aliases a
layout has is settled once, when the plan is made.  Code lists come as tables and are joined as small sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect
from fundlens.functions import codes, dates, numbers, text
from fundlens.sources.files import normalize_columns

# Names that the fields go by in deliveries, in the order they are tried. A layout with other names
# brings its own through ``Layout.aliases``.
FIELD_ALIASES: dict[str, list[str]] = {
    "project_id": ["project_id", "project_number", "project_no", "project_code", "operation_number", "id", "projectid", "iati_identifier"],
    "project_name": ["project_name", "project_title", "operation_name", "title", "name", "project"],
    "country": ["country", "country_name", "member", "recipient_country", "pais", "economy", "countries"],
    "country_code": ["country_code", "iso3", "iso_code", "recipient_country_code"],
    "region_code": ["recipient_region_code"],
    "province": ["province", "state", "region", "district", "provincia"],
    "location_text": ["precise_location", "project_location", "location_description", "address", "city"],
    "latitude": ["latitude", "lat", "project_latitude"],
    "longitude": ["longitude", "lon", "lng", "project_longitude"],
    "approval_date": ["approval_date", "approved_date", "date_approved", "board_approval_date", "board_date", "fecha_de_aprobacion", "approval_year"],
    "commitment_date": ["commitment_date", "signing_date", "signed_date", "signature_date", "start_date", "effective_date", "iati_start_date"],
    "completion_date": ["completion_date", "closing_date", "end_date", "expected_completion_date", "iati_end_date"],
    "status": ["status", "project_status", "operation_status", "activity_status", "stage", "estado"],
    "status_code": ["activity_status_code"],
    "sector": ["sector", "sector_name", "major_sector", "area", "theme", "sectors"],
    "sector_code": ["sector_code"],
    "subsector": ["subsector", "sub_sector", "industry", "activity_sector"],
    "loan_type": ["loan_type", "financing_type", "lending_type", "sovereign_status", "sovereign_non_sovereign"],
    "financing_instrument": ["financing_instrument", "instrument", "lending_instrument", "operation_type", "product", "mode_of_finance"],
    "finance_type_code": ["default_finance_type_code"],
    "flow_type_code": ["default_flow_type_code"],
    "funding_window": ["funding_window", "iati_funding_window"],
    "funding_window_ref": ["iati_funding_window_ref"],
    "total_project_cost": ["total_project_cost", "project_cost", "total_cost"],
    "project_cost_currency": ["project_cost_currency", "currency", "currency_code", "moneda"],
    "loan_amount": ["loan_amount", "financing_amount", "bank_financing", "approved_financing", "amount_agreed", "signed_amount", "iati_commitment_value"],
    "loan_currency": ["loan_currency", "financing_currency", "currency", "currency_code", "moneda", "iati_commitment_currency"],
    "total_commitment": ["total_commitment", "commitment_amount", "total_commitments", "approved_amount", "signed_amount", "total_financing"],
    "commitment_currency": ["commitment_currency", "approved_amount_currency", "currency", "currency_code", "moneda"],
    "total_disbursement": ["total_disbursement", "total_disbursements", "disbursed_amount", "amount_disbursed", "disbursed", "iati_disbursement_value"],
    "disbursement_currency": ["disbursement_currency", "disbursed_currency", "currency", "currency_code", "moneda", "iati_disbursement_currency"],
    "first_disbursement_date": ["first_disbursement_date", "first_disbursement", "iati_first_disbursement_date"],
    "last_disbursement_date": ["last_disbursement_date", "latest_disbursement_date", "disbursement_date", "iati_last_disbursement_date"],
    "cofinancing_partners": ["cofinancing_partners", "cofinanciers", "cofinancing", "partner_institutions", "participating_organisation", "iati_cofinancing_partners"],
    "cofinancing_amount": ["cofinancing_amount", "co_financing_amount", "cofinanced_amount"],
    "cofinancing_currency": ["cofinancing_currency", "co_financing_currency", "currency", "currency_code", "moneda"],
    "conditionality": ["conditionality", "conditions", "loan_conditions", "prior_actions", "covenants"],
    "conditionality_source_url": ["conditionality_source_url", "program_document", "policy_document"],
    "project_url": ["project_url", "url", "link", "project_link"],
    "source_updated_at": ["last_updated", "updated_at", "data_date", "publication_date"],
}
MONEY = {
    "loan_amount": "loan_currency", "total_project_cost": "project_cost_currency", "total_commitment": "commitment_currency",
    "total_disbursement": "disbursement_currency", "cofinancing_amount": "cofinancing_currency",
}
_MONEY_TYPE = "decimal(22,4)"


@dataclass(frozen=True)
class Layout:
    """How a source writes its rows; everything has a neutral default.

    ``aliases`` are tried before the usual ones, per field.  ``own_names`` are how the institution calls itself
    among its partners.  ``soft``/``hard`` are references and names (lower case) of windows on and off easy terms,
    ``soft_flows``/``hard_flows`` flow types, ``grant`` the finance type of grants.
    """

    aliases: dict[str, list[str]] = field(default_factory=dict)
    default_currency: str = ""
    day_first: bool | None = None
    dot_is_decimal: bool = False
    own_names: tuple[str, ...] = ()
    soft: tuple[str, ...] = ()
    hard: tuple[str, ...] = ()
    soft_flows: tuple[str, ...] = ()
    hard_flows: tuple[str, ...] = ()
    grant: str = ""


@dataclass(frozen=True)
class CodeLists:
    """Lists by code; each optional. ``countries``: iso2, iso3, country_name, alt_names; the others: code, name.

    ``sectors``: tiers of (key, value) for :func:`fundlens.functions.codes.tiered_lookup`, the value a category.
    """

    countries: DataFrame | None = None
    regions: DataFrame | None = None
    statuses: DataFrame | None = None
    finance_types: DataFrame | None = None
    sector_names: DataFrame | None = None
    sectors: tuple[DataFrame, ...] = ()


def json_columns(rows: DataFrame, column: str = "row", most: int = 10_000) -> DataFrame:
    """Rows given as JSON objects as text columns under tidy names; nested values stay JSON. The keys are a bounded list."""
    keys = sorted(r[0] for r in bounded_collect(rows.select(F.explode(F.json_object_keys(column))).distinct(), most, "keys of rows"))
    m = F.from_json(F.col(column), "map<string,string>")
    rest = [c for c in rows.columns if c != column]
    tidy = normalize_columns(rows.sparkSession.createDataFrame([], ", ".join(f"`{k}` string" for k in keys))).columns if keys else []
    df = rows.select(*rest, m.alias("__m"))
    return df.select(*[c for c in rest if c not in tidy], *[F.col("__m")[k].alias(t) for k, t in zip(keys, tidy, strict=True)])


def scalar(c: Column) -> Column:
    """A value as text: the members of a JSON list or the values of an object joined, anything else tidied."""

    def read(t: Column) -> Column:
        kind = F.substring(t, 1, 1)
        members = F.when(kind == "[", F.from_json(t, "array<string>")).when(kind == "{", F.map_values(F.from_json(t, "map<string,string>")))
        return text.bound(members, lambda m: F.when(m.isNull(), text.tidy(t)).otherwise(F.nullif(text.join_values(m), F.lit(""))))

    return text.bound(F.trim(c.cast("string")), read)


def _once(c: Column) -> Column:
    """The same value, which the optimiser may not copy into each of its uses, as it copies elements taken from an array."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def _usable(c: Column) -> Column:
    return text.tidy(c.cast("string")).isNotNull()


def first_of(df: DataFrame, names: list[str]) -> tuple[Column, Column]:
    """(value, name) of the first named column that exists and holds more than a word for nothing."""
    there = [n for n in dict.fromkeys(names) if n in df.columns]
    if not there:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    found = F.coalesce(*[F.when(_usable(F.col(f"`{n}`")), F.struct(F.col(f"`{n}`").cast("string").alias("v"), F.lit(n).alias("n"))) for n in there])
    return found["v"], found["n"]


def money(value: Column, name: Column, currency: Column, layout: Layout) -> Column:
    """``struct<amount, currency, usd>`` of texts without character references; dollars by currency or by the column's name."""
    stated = numbers.detect_currency(currency, F.lit(layout.default_currency), resolved=True)
    got = numbers.parse_amount(value, stated, layout.dot_is_decimal, resolved=True)
    code = F.coalesce(got["currency"], stated)
    usd = F.coalesce(code == "USD", F.lit(False)) | F.coalesce(F.contains(name, F.lit("usd")) | F.contains(name, F.lit("us_dollar")), F.lit(False))
    return F.struct(got["amount"].cast(_MONEY_TYPE).alias("amount"), code.alias("currency"), usd.alias("usd"))


def _named(df: DataFrame, code: str, listed: DataFrame | None, out: str) -> DataFrame:
    """Add the name that a list has for a code, null without a list or an entry; of a repeated code the smallest name."""
    if listed is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    one = listed.where("code IS NOT NULL").groupBy(F.upper("code").alias("__code")).agg(F.min("name").alias(out))
    return df.join(one, F.upper(F.col(code)) == F.col("__code"), "left").drop("__code")


def canonical(rows: DataFrame, layout: Layout | None = None, lists: CodeLists | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical columns of delivered rows, whose columns have tidy names, with notes on what was derived.

    The country's name comes from its code, else its region's, where the source gives no name; the three-letter
    code from the name, or from a two-letter code that named the country.  Status, sector and instrument are named
    by code where there is no text.  One stated amount is the commitment too.  Nothing is guessed: what no list
    knows stays null with a note.  Rows without a name are kept (see :func:`named`); missing columns are null;
    columns in ``keep`` go through.
    """
    layout, lists = layout or Layout(), lists or CodeLists()
    names = {f: [*layout.aliases.get(f, []), *a] for f, a in FIELD_ALIASES.items()}
    got = {f: first_of(rows, a) for f, a in names.items()}
    # fields that no column can fill are settled here and not in the plan
    order = [f for f, a in names.items() if any(n in rows.columns for n in a)]
    none = F.lit(None).cast("string")
    note = F.col("_source_note").cast("string") if "_source_note" in rows.columns else F.lit(None).cast("string")
    df = rows.select(*keep, F.array(*[got[f][0] for f in order], note).alias("__t"), *[got[f][1].alias(f"__{f}_by") for f in MONEY if f in order])
    # one expression over an array for all fields, amounts and dates: a plan stays as small as its parts are different
    odd = F.exists("__t", lambda t: F.contains(t, F.lit("&")))
    df = df.withColumn("__t", F.when(odd, text.unescape_all(F.when(odd, F.col("__t")))).otherwise(F.col("__t")))
    df = df.withColumn("__t", _once(F.transform("__t", scalar)))
    df = df.select(*[c for c in df.columns if c != "__t"], *[F.get("__t", k).alias(f"__{f}") for k, f in enumerate([*order, "source_note"])])
    col = lambda f: F.col(f"__{f}") if f in order or f == "source_note" else none
    sums = [a for a in MONEY if a in order or MONEY[a] in order]
    days = [d for d in ("approval_date", "commitment_date", "completion_date", "first_disbursement_date", "last_disbursement_date") if d in order]
    staged = {}
    if sums:
        stated = F.array(*[F.struct(col(a).alias("v"), (F.col(f"__{a}_by") if a in order else none).alias("n"), col(MONEY[a]).alias("c")) for a in sums])
        staged["__money"] = _once(F.transform(stated, lambda x: money(x["v"], x["n"], x["c"], layout)))
    if days:
        staged["__days"] = _once(F.transform(F.array(*[col(d) for d in days]), lambda d: dates.parse_date(d, layout.day_first, resolved=True)))
    df = df.withColumns(staged) if staged else df
    day = {d: F.lit(None).cast("date") for d in ("approval_date", "commitment_date", "completion_date", "first_disbursement_date", "last_disbursement_date")} | {d: F.get("__days", k) for k, d in enumerate(days)}
    # a source's own currency holds for what it doesn't state too
    nothing = F.struct(F.lit(None).cast(_MONEY_TYPE).alias("amount"), F.lit(layout.default_currency.upper() or None).cast("string").alias("currency"), F.lit(False).alias("usd"))
    m = ({a: nothing for a in MONEY} | {a: F.get("__money", k) for k, a in enumerate(sums)}).get
    countries = lists.countries
    by_two = countries.select(F.col("iso2").alias("code"), F.col("country_name").alias("name")) if countries is not None else None
    for code, listed, out in (
        ("country_code", by_two, "__named"), ("region_code", lists.regions, "__regional"), ("status_code", lists.statuses, "__status_named"),
        ("finance_type_code", lists.finance_types, "__instrument_named"), ("sector_code", lists.sector_names, "__sector_named"),
    ):
        df = _named(df, f"__{code}", listed if code in order else None, out)
    df = df.withColumn("__place", F.coalesce(col("country"), F.col("__named"), F.col("__regional"))).withColumn("__sector_text", F.coalesce(col("sector"), F.col("__sector_named")))
    df = codes.tiered_lookup(df, "__place", codes.country_tiers(countries), "__iso3") if countries is not None else df.withColumn("__iso3", F.lit(None).cast("string"))
    df = codes.tiered_lookup(df, "__sector_text", list(lists.sectors), "__category") if lists.sectors else df.withColumn("__category", F.lit(None).cast("string"))

    df = df.withColumns({"__approved": day["approval_date"], "__committed": F.coalesce(day["commitment_date"], day["approval_date"])})
    windows = F.filter(F.split(F.lower(F.concat_ws("; ", col("funding_window"), col("funding_window_ref"))), "; "), lambda w: w != "")
    terms = text.concessionality(windows, col("flow_type_code"), col("finance_type_code"), *[[x.lower() for x in v] for v in (layout.soft, layout.hard)], list(layout.soft_flows), list(layout.hard_flows), layout.grant)
    own = [n.lower() for n in layout.own_names]
    partners = F.nullif(F.array_join(F.filter(F.split(col("cofinancing_partners"), r"\s*;\s*"), lambda p: ~F.lower(p).isin(own) & (p != "")), "; "), F.lit("")) if own else col("cofinancing_partners")
    copied = m("total_commitment")["amount"].isNull() & m("loan_amount")["amount"].isNotNull()
    notes = F.array_compact(
        F.array(
            F.when(col("country").isNull() & F.col("__named").isNotNull(), F.concat(F.lit("country named by code "), col("country_code"))),
            F.when(col("country").isNull() & F.col("__named").isNull() & F.col("__regional").isNotNull(), F.concat(F.lit("a region, not a country, by code "), col("region_code"))),
            F.when(F.col("__place").isNotNull() & F.col("__iso3").isNull(), F.concat(F.lit("no country code for "), F.col("__place"))),
            F.when(col("status").isNull() & F.col("__status_named").isNotNull(), F.concat(F.lit("status named by code "), col("status_code"))),
            F.when(col("sector").isNull() & F.col("__sector_named").isNotNull(), F.concat(F.lit("sector named by code "), col("sector_code"))),
            F.when(F.col("__sector_text").isNotNull() & F.col("__category").isNull() & F.lit(bool(lists.sectors)), F.concat(F.lit("no sector category for "), F.col("__sector_text"))),
            F.when(col("financing_instrument").isNull() & F.col("__instrument_named").isNotNull(), F.concat(F.lit("instrument named by code "), col("finance_type_code"))),
            F.when(copied, F.lit("commitment copied from loan amount")),
            F.col("__source_note"),
        )
    )
    plain = ["project_id", "project_name", "province", "location_text", "subsector", "funding_window", "conditionality", "conditionality_source_url", "project_url", "source_updated_at"]
    out = {
        **{f: col(f) for f in plain},
        "country": F.col("__place"), "country_code": F.col("__iso3"), "latitude": numbers.parse_coordinate(col("latitude"), resolved=True), "longitude": numbers.parse_coordinate(col("longitude"), resolved=True),
        "approval_date": F.col("__approved"), "commitment_date": F.col("__committed"), "completion_date": day["completion_date"],
        "approval_year": F.coalesce(F.year("__approved"), dates.extract_year(col("approval_date"))), "commitment_year": F.coalesce(F.year("__committed"), F.year("__approved")),
        "status": F.coalesce(col("status"), F.col("__status_named")), "sector": F.col("__sector_text"), "sector_category": F.col("__category"), "loan_type": text.loan_type(col("loan_type")),
        "financing_instrument": F.coalesce(col("financing_instrument"), F.col("__instrument_named")), "concessional": terms,
        "concessional_flag": F.when(terms == "Yes", 1).when(terms == "No", 0).cast("tinyint"), "cofinancing_partners": partners,
        "first_disbursement_date": day["first_disbursement_date"], "last_disbursement_date": day["last_disbursement_date"],
        "data_quality_notes": F.nullif(F.array_join(notes, "; "), F.lit("")),
    }
    for a, c in MONEY.items():
        out[a], out[c], out[f"{a}_usd"] = m(a)["amount"], m(a)["currency"], F.when(m(a)["usd"], m(a)["amount"])
    for target, part in (("total_commitment", "amount"), ("commitment_currency", "currency")):
        out[target] = F.when(copied, m("loan_amount")[part]).otherwise(m("total_commitment")[part])
    out["total_commitment_usd"] = F.when(copied, F.when(m("loan_amount")["usd"], m("loan_amount")["amount"])).otherwise(F.when(m("total_commitment")["usd"], m("total_commitment")["amount"]))
    return df.select(*keep, *[c.alias(n) for n, c in out.items() if n not in keep])


def named(records: DataFrame) -> DataFrame:
    """The records that have a name."""
    return records.where(F.trim("project_name") != "")


def with_constants(records: DataFrame, constants: dict[str, object]) -> DataFrame:
    """Fields that are the same for every row of a source, over whatever its rows say."""
    return records.withColumns({k: F.lit(v).cast(dict(records.dtypes).get(k, "string")) for k, v in constants.items()}) if constants else records


def usd_fan_out(records: DataFrame, amount: str) -> DataFrame:
    """One dollar amount as loan and commitment, with its currency and dollar columns."""
    a = F.col(amount).cast(_MONEY_TYPE)
    usd = F.when(a.isNotNull(), F.lit("USD"))
    return records.withColumns({"loan_amount": a, "loan_amount_usd": a, "loan_currency": usd, "total_commitment": a, "total_commitment_usd": a, "commitment_currency": usd})


def complete(records: DataFrame) -> DataFrame:
    """Instrument category, duration, and a note for every kind of fact that a source doesn't give."""
    start = F.coalesce("commitment_date", "approval_date")
    missing = {
        "duration": F.col("duration_years").isNull(), "loan amount": F.col("loan_amount").isNull(), "commitment": F.col("total_commitment").isNull(), "disbursement": F.col("total_disbursement").isNull(),
        "disbursement dates": F.col("first_disbursement_date").isNull() & F.col("last_disbursement_date").isNull(), "partners": F.col("cofinancing_partners").isNull() & F.col("cofinancing_amount").isNull(),
        "conditions": F.col("conditionality").isNull(), "location": F.coalesce("province", "location_text").isNull() & F.col("latitude").isNull() & F.col("longitude").isNull(), "sector": F.col("sector").isNull(),
    }
    df = records.withColumns({"instrument_category": text.instrument_category(F.col("financing_instrument"), F.col("loan_type")), "duration_years": dates.duration_years(start, F.col("completion_date"))})
    gone = F.array_compact(F.array(*[F.when(t, F.lit(f"no {n} given")) for n, t in missing.items()]))
    return df.withColumn("data_quality_notes", F.nullif(F.concat_ws("; ", "data_quality_notes", F.nullif(F.array_join(gone, "; "), F.lit(""))), F.lit("")))


def with_loans(projects: DataFrame, loans: DataFrame, key: str = "project_id") -> DataFrame:
    """Projects with their loans' sums, distinct rates and dates: loans are reduced by project before the join.

    Sums are null where no loan states an amount; a project without loans keeps nulls and ``n_loans`` 0.
    """
    per = loans.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum("principal").alias("loan_principal"), F.sum("disbursed").alias("loan_disbursed"),
        F.array_join(F.array_sort(F.collect_set("interest_rate")), "; ").alias("interest_rates"), F.when(F.countDistinct("interest_rate") == 1, F.max("interest_rate")).alias("single_rate"),
        F.array_join(F.array_sort(F.collect_set(F.col("last_repayment_date").cast("string"))), "; ").alias("last_repayment_dates"), F.min("board_approval_date").alias("first_board_date"),
    )
    return projects.join(per, key, "left").withColumn("n_loans", F.coalesce("n_loans", F.lit(0)))


def own_money(projects: DataFrame, amount: str = "arm_amount", principal: str = "loan_principal", status: str = "status") -> DataFrame:
    """Projects that an arm has money in: a positive amount of its own or a loan; one dropped without a loan never was approved."""
    dropped = F.coalesce(F.lower(F.trim(status)) == "dropped", F.lit(False))
    lent = F.coalesce(F.col(principal) != 0, F.lit(False))
    return projects.where((F.coalesce(F.col(amount) > 0, F.lit(False)) | lent) & (~dropped | lent))


def partner_sum(projects: DataFrame, key: str, partners: DataFrame) -> DataFrame:
    """Projects with the sum of their partners' amounts; null where no partner states one."""
    return projects.join(partners.groupBy(key).agg(F.sum("amount").alias("cofinancing_amount")), key, "left")


def marker_places(records: DataFrame, markers: DataFrame) -> DataFrame:
    """Coordinates of a country's marker for records that have none; of several markers the first by ``_ord``."""
    one = markers.groupBy(F.lower(F.trim("country")).alias("__c")).agg(F.min_by(F.struct("latitude", "longitude"), "_ord").alias("__at"))
    df = records.join(one, F.lower(F.trim(F.col("country"))) == F.col("__c"), "left")
    bare = F.col("latitude").isNull() & F.col("longitude").isNull()
    return df.withColumns({x: F.when(bare, F.col(f"__at.{x}").cast(dict(records.dtypes)[x])).otherwise(F.col(x)) for x in ("latitude", "longitude")}).drop("__c", "__at")


def composed_name(parts: list[Column], separator: str = " - ") -> Column:
    """A name made of what a source gives in parts, blanks left out; null if all are."""
    return F.nullif(F.concat_ws(separator, *[text.normalize_text(p) for p in parts]), F.lit(""))


def sector_parts(c: Column) -> Column:
    """Sectors of a list given as JSON, without a fiscal year before them, joined."""
    return F.nullif(text.join_values(F.transform(F.from_json(c, "array<string>"), lambda s: F.regexp_replace(s, r"^FY\d{2,4}\s*-\s*", ""))), F.lit(""))


def covered_years(first: int | None, as_of: str) -> list[int]:
    """The years a file covers: up to the one before its date, and that one only if it ends with the date."""
    year = int(as_of[:4])
    return list(range(first if first is not None else year, year + 1 if as_of[5:10] == "12-31" else year))


def in_scope(rows: DataFrame, year: str, first: int | None, last: int | None) -> DataFrame:
    """Rows of the years; a row without a year is in no scope, as totals by year can't hold it."""
    y = F.col(year)
    return rows.where(y.isNotNull() & (F.lit(True) if first is None else y >= first) & (F.lit(True) if last is None else y <= last))


def fill_counts(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field, n_filled): in how many records a merge filled a field that was empty."""
    a = before.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    j = after.join(a, F.col(key) == F.col("__k"))
    row = j.agg(*[F.coalesce(F.sum((F.col(f"__{f}").isNull() & F.col(f).isNotNull()).cast("long")), F.lit(0)).alias(f) for f in fields])
    return row.unpivot([], fields, "field", "n_filled")


def merged_and_kept(merged: DataFrame, live: DataFrame, decisions: DataFrame, key: str = "row_id") -> DataFrame:
    """The merged official rows and the live rows that were kept beside them, as one table with ``origin``."""
    kept = live.join(decisions.where("decision <> 'excluded'").select(key, F.col("decision").alias("origin")), key)
    return merged.withColumn("origin", F.lit("official")).unionByName(kept, allowMissingColumns=True)
