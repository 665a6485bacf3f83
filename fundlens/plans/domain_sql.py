"""The same questions in ANSI SQL, for an independent engine. Whole-number arithmetic mirrors the cents."""

from __future__ import annotations

# Fixed values, stated again so that this side takes nothing from the engine: words for nothing, instruments and their rules.
_NULLS = ["", "-", "--", "n/a", "na", "n.a.", "none", "null", "not available"]
INSTRUMENTS = ["loan", "grant", "technical_assistance", "guarantee", "equity", "trade_finance", "other"]
INSTRUMENT_RULES = [
    ("trade_finance", "trade financ|itfc"),
    ("guarantee", "guarantee"),
    ("equity", r"\bequity\b|mudaraba|musharaka"),
    ("loan", r"\b(loan|credit\b|lending\b|credito\b|prestamo|leasing\b)|investment project financing|program for results|development policy|project financing|debt|fondos ordinarios|istisna|instal?lment sale|murabaha"),
    ("grant", r"\b(grant|donacion)|no reembolsable"),
    ("technical_assistance", "technical (assistance|cooperation)|capacity development|(asistencia|cooperacion) tecnica"),
    ("other", "container|securities|special assistance"),
]

FIRST, LAST, TODAY, SUSPECT = 2002, 2026, "2026-03-15", 4e8


def _half_even(num: str, den: str) -> str:
    n, d = f"abs({num})", f"({den})"
    q, r = f"({n} // {d})", f"({n} % {d})"
    up = f"(CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"CAST(CASE WHEN {d} > 0 THEN (CASE WHEN {num} < 0 THEN -1 ELSE 1 END) * ({q} + {up}) END AS BIGINT)"


def _instrument(column: str) -> str:
    t = f"regexp_replace(lower(strip_accents({column})), '[^a-z0-9]+', ' ', 'g')"
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, '{p}') THEN '{n}'" for n, p in INSTRUMENT_RULES) + " END"


_A = "ascii(substr(iso3, {k}, 1))"
_OPS = f"""
WITH ref AS (SELECT iso3, [ 'QKR', 'QTN', 'QMB', 'EUR' ][ascii(iso3) % 4 + 1] AS local_series FROM ref_countries),
deflator AS (SELECT CAST(y AS INTEGER) AS year, CAST(60000 + 1600 * (y - 2000) AS HUGEINT) AS d FROM range(2000, 2026) t(y)),
levels AS (SELECT iso3 AS code, CAST((1000 + 7 * {_A.format(k=1)}) * 100 AS HUGEINT) AS gu, CAST((2000 + 13 * {_A.format(k=2)}) * 100 AS HUGEINT) AS gp
           FROM ref_countries WHERE {_A.format(k=3)} % 7 <> 0),
base AS (
  SELECT p.row_id, p.bank_id, p.country, r.iso3 AS code, p.loan_amount, p.loan_amount_usd, p.loan_type, p.official_source_id, p.concessional,
         {_instrument("p.financing_instrument")} AS instrument, coalesce(p.approval_year, p.commitment_year) AS y,
         CASE upper(trim(p.loan_currency)) WHEN 'SDR' THEN 'XDR' ELSE upper(trim(p.loan_currency)) END AS series, upper(trim(p.loan_currency)) AS cur, r.local_series
  FROM project_records p LEFT JOIN ref r ON upper(trim(p.country_code)) = r.iso3),
priced AS (
  SELECT b.*, d.d, l.gu, l.gp, f.units_per_usd AS rate, g.units_per_usd AS local_rate
  FROM base b LEFT JOIN fx_rates f ON f.series_code = b.series AND f.fx_year = b.y
  LEFT JOIN fx_rates g ON g.series_code = b.local_series AND g.fx_year = b.y
  LEFT JOIN deflator d ON d.year = b.y
  LEFT JOIN levels l ON l.code = b.code AND b.y BETWEEN 2000 AND 2025),
told AS (
  SELECT *, CASE WHEN loan_amount IS NULL THEN 'no-amount' WHEN y IS NULL THEN 'no-year'
    WHEN coalesce((loan_amount_usd IS NOT NULL OR cur = 'USD') AND official_source_id IS NULL AND loan_type = 'Non-sovereign'
         AND coalesce(nullif(loan_amount_usd, 0), loan_amount) > {SUSPECT:.0f} AND local_rate >= 10, false) THEN 'excluded-currency-suspect'
    WHEN coalesce(loan_amount_usd IS NOT NULL OR cur = 'USD', false) THEN 'source-usd' WHEN rate > 0 THEN 'annual-average' ELSE 'unconverted' END AS conversion
  FROM priced),
nominal AS (
  SELECT *, CASE conversion
    WHEN 'source-usd' THEN {_half_even("CAST(coalesce(loan_amount_usd, loan_amount) * 10000 AS HUGEINT)", "CAST(100 AS HUGEINT)")}
    WHEN 'annual-average' THEN {_half_even("CAST(loan_amount * 10000 AS HUGEINT) * 10000", "CAST(CAST(rate AS DECIMAL(28,6)) * 1000000 AS HUGEINT)")} END AS nominal_cents
  FROM told),
ops AS (
  SELECT *, y AS analysis_year,
    {_half_even("CAST(nominal_cents AS HUGEINT) * 100000", "d")} AS constant_cents,
    {_half_even("CAST(nominal_cents AS HUGEINT) * gp", "gu")} AS ppp_cents,
    {_half_even("CAST(nominal_cents AS HUGEINT) * 100000 * gp", "d * gu")} AS ppp_constant_cents
  FROM nominal)
"""

_BUCKET = "coalesce(instrument, 'unspecified')"
_TERMS = "CASE WHEN concessional IN ('Yes', 'No', 'Blended') THEN lower(concessional) ELSE 'unknown' END"


def _usd(cond: str | None, cents: str = "constant_cents") -> str:
    inner = f"CASE WHEN {cond} THEN {cents} END" if cond else cents
    return f"CAST(coalesce(sum({inner}), 0) AS DOUBLE) / 100.0"


_MEASURES = ", ".join(
    [
        "count(*) AS n_operations", "count(*) FILTER (WHERE conversion <> 'no-amount') AS n_with_amount",
        "count(*) FILTER (WHERE conversion IN ('unconverted', 'excluded-currency-suspect')) AS n_unconverted",
        f"{_usd(None, 'nominal_cents')} AS usd_nominal_total", f"{_usd(None)} AS usd_2025_total",
        "count(*) FILTER (WHERE constant_cents IS NOT NULL AND ppp_constant_cents IS NULL) AS n_ppp_unpriced",
        f"{_usd('constant_cents IS NOT NULL', 'ppp_constant_cents')} AS ppp_2025_total",
        *[f"count(*) FILTER (WHERE {_BUCKET} = '{b}') AS n_{b}" for b in [*INSTRUMENTS, "unspecified"]],
        *[f"{_usd(f'{_BUCKET} = {chr(39)}{b}{chr(39)}')} AS usd_2025_{b}" for b in [*INSTRUMENTS, "unspecified"]],
        *[f"{_usd(f'({_TERMS}) = {chr(39)}{t}{chr(39)}')} AS usd_2025_concessional_{t}" for t in ("yes", "no", "blended", "unknown")],
    ]
)
_SCOPE = f"analysis_year BETWEEN {FIRST} AND {LAST}"
_WINDOWS = "(VALUES ('cor', 2005, NULL::INT), ('kdb', NULL::INT, 2023), ('nrb', 2008, 2024)) w(bank_id, start_year, end_year)"
_DATED = "SELECT * REPLACE (try_cast(approval_date AS DATE) AS approval_date, try_cast(commitment_date AS DATE) AS commitment_date) FROM project_records"
_COVERAGE = f"""
WITH r AS ({_DATED}), known AS (SELECT *, coalesce(approval_year, commitment_year) AS year FROM r WHERE coalesce(approval_year, commitment_year) IS NOT NULL),
newest AS (SELECT bank_id, max(coalesce(approval_date, commitment_date)) AS latest, max(year) AS seen FROM known GROUP BY ALL),
counts AS (SELECT bank_id, year, count(*) AS operations, count(*) FILTER (WHERE regexp_matches(lower(coalesce(status, '')), 'cancel|drop|terminat|withdrawn|reject')) AS not_active,
  count(loan_amount) AS with_amount, CAST(coalesce(sum(loan_amount_usd), 0) AS DOUBLE) AS usd_total FROM known WHERE year BETWEEN {FIRST} AND {LAST} GROUP BY ALL),
grid AS (SELECT n.bank_id, CAST(y AS INTEGER) AS year, n.latest, n.seen, coalesce(c.operations, 0) AS operations, coalesce(c.not_active, 0) AS not_active, coalesce(c.with_amount, 0) AS with_amount,
  coalesce(c.usd_total, 0.0) AS usd_total,
  CAST(y BETWEEN greatest({FIRST}, coalesce(w.start_year, {FIRST})) AND least({LAST}, coalesce(w.end_year, n.seen, {LAST})) AS INTEGER) AS covered
  FROM newest n CROSS JOIN range({FIRST}, {LAST + 1}) t(y) LEFT JOIN counts c ON c.bank_id = n.bank_id AND c.year = y LEFT JOIN {_WINDOWS} ON w.bank_id = n.bank_id),
mid AS (SELECT bank_id, coalesce(median(operations) FILTER (WHERE covered = 1 AND year < 2026), 0.0) AS bank_median FROM grid GROUP BY ALL),
coverage AS (SELECT g.bank_id, g.year, covered, operations, not_active, with_amount, usd_total, bank_median,
  concat_ws('; ', CASE WHEN covered = 0 THEN 'not_covered' WHEN g.year < 2026 AND operations < bank_median * 0.3 THEN 'low' END,
    CASE WHEN g.year = {LAST} AND DATE '{TODAY}' - latest > 274 AND seen < 2026 THEN 'stale' END) AS flag
  FROM grid g JOIN mid USING (bank_id))
"""
_FILLED = "({c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '')"
_FILL = ["province", "latitude", "approval_date", "status", "sector", "loan_amount", "interest_rate", "cofinancing_partners"]
_SIDES = """
WITH src AS (SELECT source_id FROM official_sources WHERE list_contains(roles, 'backstop')),
r AS (SELECT *, coalesce(approval_year, commitment_year) AS year FROM project_records),
off AS (SELECT * FROM r WHERE official_source_id IN (SELECT source_id FROM src)),
ours AS (SELECT * FROM r WHERE official_source_id IS NULL OR official_source_id NOT IN (SELECT source_id FROM src))
"""
_COUNTS = f"""{_SIDES}, a AS (SELECT bank_id, year, count(*) AS n FROM off GROUP BY ALL), b AS (SELECT bank_id, year, count(*) AS n FROM ours GROUP BY ALL),
checks AS (SELECT s.bank_id, CAST(y AS INTEGER) AS year, coalesce(a.n, 0) AS official, coalesce(b.n, 0) AS ours, coalesce(b.n, 0)::DOUBLE / nullif(coalesce(a.n, 0), 0) AS q
  FROM (SELECT DISTINCT bank_id FROM off) s CROSS JOIN range({FIRST}, {LAST + 1}) t(y) LEFT JOIN a ON a.bank_id = s.bank_id AND a.year = y LEFT JOIN b ON b.bank_id = s.bank_id AND b.year = y)
"""
_STATUS = "CASE WHEN q IS NULL OR q >= 0.95 THEN 'pass' ELSE 'fail' END"
_VIS = ["province", "status", "interest_rate", "loan_amount"]
_BACKBONE = f"""
WITH src AS (SELECT source_id FROM official_sources WHERE list_contains(roles, 'backbone')),
r AS (SELECT *, concat_ws(':', bank_id, lower(trim(project_id))) AS key, row_id AS ord FROM ({_DATED})),
off AS (SELECT * FROM r WHERE official_source_id IN (SELECT source_id FROM src) QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord) = 1),
live AS (SELECT * FROM r WHERE official_source_id IS NULL)
"""


def _one(amount: str, currency: str, what: str) -> str:
    cur = f"CASE WHEN {amount} IS NOT NULL THEN coalesce({currency}, '') END"
    return f"CASE WHEN min({cur}) = max({cur}) THEN {what.format(cur=cur, amount=amount)} END"


def _first(f: str) -> str:
    return f"arg_min({f}, CASE WHEN {f} IS NOT NULL THEN row_id END)"


_CUR = "trim(regexp_replace(coalesce(loan_currency, ''), '\\s+', ' ', 'g'))"

ORACLE_SQL = {
    "convert_constant_usd": _OPS + "SELECT row_id, conversion, analysis_year, nominal_cents, constant_cents, ppp_cents, ppp_constant_cents FROM ops",
    "panel_country_year": _OPS + f"SELECT bank_id, code, analysis_year AS year, {_MEASURES} FROM ops WHERE {_SCOPE} AND code IS NOT NULL GROUP BY ALL",
    "panel_unallocated": _OPS + f"SELECT bank_id, analysis_year AS year, {_MEASURES}, coalesce(array_to_string(list_sort(list_distinct(list(CASE WHEN trim(country) <> '' THEN trim(country) END))), '; '), '') AS countries FROM ops WHERE {_SCOPE} AND code IS NULL GROUP BY bank_id, analysis_year",
    "panel_control": _OPS + f"SELECT bank_id, analysis_year AS year, count(*) AS n_operations, {_usd(None)} AS usd_2025_total FROM ops WHERE {_SCOPE} GROUP BY ALL",
    "panel_levels": _OPS + f"SELECT bank_id, code, analysis_year AS year, count(*) AS n_operations, {_usd(None)} AS usd_2025_total, CASE WHEN grouping(code) = 1 THEN 'control' WHEN code IS NULL THEN 'unallocated' ELSE 'panel' END AS level FROM ops WHERE {_SCOPE} GROUP BY GROUPING SETS ((bank_id, code, analysis_year), (bank_id, analysis_year))",
    "panel_balanced": _OPS + f""", cells AS (SELECT bank_id, code, analysis_year AS year, count(*) AS n_operations, {_usd(None)} AS usd_2025_total FROM ops WHERE {_SCOPE} AND code IS NOT NULL GROUP BY ALL),
pairs AS (SELECT DISTINCT bank_id, code FROM cells), seen AS (SELECT bank_id, max(year) AS s FROM cells GROUP BY ALL),
grid AS (SELECT p.bank_id, p.code, CAST(y AS INTEGER) AS year, c.n_operations, c.usd_2025_total,
  y BETWEEN greatest({FIRST}, coalesce(w.start_year, {FIRST})) AND least({LAST}, coalesce(w.end_year, s.s)) AS inside
  FROM pairs p CROSS JOIN range({FIRST}, {LAST + 1}) t(y) LEFT JOIN cells c ON c.bank_id = p.bank_id AND c.code = p.code AND c.year = y JOIN seen s ON s.bank_id = p.bank_id LEFT JOIN {_WINDOWS} ON w.bank_id = p.bank_id)
SELECT bank_id, code, year, CAST(n_operations IS NOT NULL AS INTEGER) AS observed, CAST(inside AS INTEGER) AS in_coverage,
  coalesce(n_operations, CASE WHEN inside THEN 0 END) AS n_operations, coalesce(usd_2025_total, CASE WHEN inside THEN 0.0 END) AS usd_2025_total FROM grid""",
    "panel_invariant": "SELECT CAST(NULL AS VARCHAR) AS bank_id, CAST(NULL AS INTEGER) AS year, CAST(NULL AS BIGINT) AS got_n, CAST(NULL AS DOUBLE) AS got_usd, CAST(NULL AS BIGINT) AS n_operations, CAST(NULL AS DOUBLE) AS usd_2025_total WHERE false",
    # the panel lacks the rows of one bank and year: these totals can't hold
    "panel_broken": _OPS + f""", got AS (SELECT bank_id, analysis_year AS year, count(*) AS got_n, {_usd(None)} AS got_usd FROM ops WHERE {_SCOPE} AND (code IS NULL OR NOT (bank_id = 'kdb' AND analysis_year = 2010)) GROUP BY ALL),
want AS (SELECT bank_id, analysis_year AS year, count(*) AS n_operations, {_usd(None)} AS usd_2025_total FROM ops WHERE {_SCOPE} GROUP BY ALL)
SELECT bank_id, year, got_n, got_usd, n_operations, usd_2025_total FROM want LEFT JOIN got USING (bank_id, year) WHERE got_n IS DISTINCT FROM n_operations OR abs(coalesce(got_usd, 0) - usd_2025_total) > 0.01""",
    "panel_private_outer": _OPS + f""", cells AS (SELECT bank_id, code, analysis_year AS year, count(*) AS n_operations FROM ops WHERE {_SCOPE} AND code IS NOT NULL AND loan_type IS DISTINCT FROM 'Non-sovereign' GROUP BY ALL),
priv AS (SELECT bank_id, code, analysis_year AS year, count(*) AS private_n, {_usd(None, "nominal_cents")} AS private_usd_nominal,
  CASE WHEN max(CASE WHEN nominal_cents IS NOT NULL AND constant_cents IS NULL THEN 1 END) IS NULL THEN {_usd(None)} END AS private_usd_2025 FROM ops WHERE loan_type = 'Non-sovereign' AND code IS NOT NULL AND analysis_year IS NOT NULL GROUP BY ALL)
SELECT bank_id, code, year, n_operations, private_n, private_usd_nominal, private_usd_2025 FROM cells FULL JOIN priv USING (bank_id, code, year)""",
    "conversion_tally": _OPS + "SELECT conversion, count(*) AS n FROM ops WHERE conversion <> 'no-amount' GROUP BY ALL",
    "ppp_missing": _OPS + "SELECT code, count(*) AS n FROM ops WHERE nominal_cents IS NOT NULL AND ppp_cents IS NULL AND code IS NOT NULL GROUP BY ALL",
    "top10_ops": _OPS + "SELECT row_id, bank_id, constant_cents FROM ops WHERE constant_cents IS NOT NULL ORDER BY constant_cents DESC, row_id LIMIT 10",
    "dedupe_first": "SELECT row_id, bank_id, project_id, load_no FROM project_records QUALIFY row_number() OVER (PARTITION BY lower(concat_ws(':', bank_id, project_id)) ORDER BY row_id) = 1",
    "newest_snapshot": "SELECT row_id, project_id FROM project_records QUALIFY row_number() OVER (PARTITION BY lower(trim(project_id)) ORDER BY CASE WHEN load_no > 2 THEN 0 WHEN load_no = 2 THEN 1 ELSE 2 END, row_id) = 1",
    "first_label": "SELECT bank_id, country_code, arg_min(coalesce(country, ''), row_id) AS country FROM project_records GROUP BY ALL",
    "last_label": "SELECT bank_id, arg_max(coalesce(bank_abbreviation, ''), row_id) AS bank_abbreviation FROM project_records GROUP BY ALL",
    "first_filled": f"SELECT bank_id, project_id, {_first('status')} AS status, {_first('sector')} AS sector, {_first('loan_type')} AS loan_type FROM project_records GROUP BY ALL",
    "occurrence_ids": "WITH f AS (SELECT *, 'ap-' || substr(sha256(coalesce(economy, '') || '|' || coalesce(CAST(approval_year AS VARCHAR), '')), 1, 12) AS f FROM isdb_approvals), n AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY list_id) AS n FROM f) SELECT list_id, economy, approval_year, CASE WHEN n = 1 THEN f ELSE f || '-' || n END AS record_id FROM n",
    "ordered_concat": "WITH f AS (SELECT bank_id, country_code, min(row_id) AS o, arg_min(trim(status), row_id) AS v FROM project_records WHERE country_code IS NOT NULL AND trim(status) <> '' GROUP BY bank_id, country_code, lower(trim(status))) SELECT bank_id, country_code, string_agg(v, '; ' ORDER BY o) AS status FROM f GROUP BY ALL",
    "set_ops": "WITH a AS (SELECT DISTINCT official_source_id AS source_id FROM project_records WHERE official_source_id IS NOT NULL), b AS (SELECT source_id FROM official_sources) SELECT source_id, 'records' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT source_id, 'list' FROM (FROM b EXCEPT FROM a) UNION ALL SELECT source_id, 'both' FROM (FROM a INTERSECT FROM b)",
    "coverage_by_year": _COVERAGE + "SELECT * FROM coverage",
    "coverage_flags": _COVERAGE + "SELECT bank_id, f.flag AS flag, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years FROM (SELECT bank_id, year, unnest(string_split(flag, '; ')) AS flag FROM coverage) f WHERE f.flag IN ('low', 'stale') GROUP BY ALL",
    "fill_rates": "SELECT bank_id, count(*) AS n_rows, " + ", ".join(f"count(*) FILTER (WHERE {_FILLED.format(c=c)}) AS n_{c}" for c in _FILL) + f", count(*) FILTER (WHERE {_FILLED.format(c='approval_year')} OR {_FILLED.format(c='commitment_year')}) AS n_any_year, count(*) FILTER (WHERE {_FILLED.format(c='total_disbursement')} OR {_FILLED.format(c='first_disbursement_date')}) AS n_any_disbursement, count(*) FILTER (WHERE loan_amount = 0) AS zero_loan_amount FROM project_records GROUP BY ALL",
    "note_frequency": f"SELECT data_quality_notes AS note, count(*) AS n, min(row_id) AS first_row FROM project_records WHERE {_FILLED.format(c='data_quality_notes')} GROUP BY ALL",
    "backstop_counts": _COUNTS + f"SELECT bank_id, year, official, ours, round_even(q, 3) AS ratio, {_STATUS} AS status FROM checks",
    "backstop_pivot": _COUNTS + f"SELECT bank_id, count(*) FILTER (WHERE ({_STATUS}) = 'pass') AS pass, count(*) FILTER (WHERE ({_STATUS}) = 'fail') AS fail FROM checks GROUP BY ALL",
    "backstop_visibility": _SIDES + ", ids AS (SELECT DISTINCT bank_id, lower(project_id) AS id FROM off), m AS (SELECT o.*, i.id IS NOT NULL AS hit FROM ours o LEFT JOIN ids i ON i.bank_id = o.bank_id AND i.id = lower(o.project_id)), a AS (SELECT bank_id, count(*) AS o, "
    + ", ".join(f"count(*) FILTER (WHERE {_FILLED.format(c=c)}) AS o_{c}" for c in _VIS) + " FROM off GROUP BY ALL), b AS (SELECT bank_id, count(*) AS a, count(*) FILTER (WHERE hit) AS m, "
    + ", ".join(f"count(*) FILTER (WHERE {_FILLED.format(c=c)}) AS a_{c}, count(*) FILTER (WHERE {_FILLED.format(c=c)} AND hit) AS m_{c}" for c in _VIS)
    + " FROM m GROUP BY ALL), u AS (" + " UNION ALL ".join(f"SELECT bank_id, '{c}' AS field, o_{c}::DOUBLE / o AS x, CASE WHEN m * 2 >= o THEN m_{c}::DOUBLE / nullif(m, 0) ELSE a_{c}::DOUBLE / a END AS y FROM a JOIN b USING (bank_id)" for c in _VIS)
    + ") SELECT bank_id, field, round_even(x, 3) AS official, round_even(y, 3) AS ours, CASE WHEN y >= x - 0.05 THEN 'pass' ELSE 'fail' END AS status FROM u",
    "backstop_amounts": _SIDES + f", o AS (SELECT bank_id, year, loan_currency, sum(loan_amount) AS t FROM off WHERE loan_amount IS NOT NULL AND {_FILLED.format(c='loan_currency')} GROUP BY ALL), u AS (SELECT bank_id, year, loan_currency, sum(loan_amount) AS t FROM ours WHERE loan_amount IS NOT NULL AND {_FILLED.format(c='loan_currency')} GROUP BY ALL) SELECT bank_id, year, loan_currency, round(o.t::DOUBLE, 0) AS official, round(coalesce(u.t::DOUBLE, 0), 0) AS ours, round_even(coalesce(u.t::DOUBLE, 0) / o.t::DOUBLE, 3) AS ratio, CASE WHEN coalesce(u.t::DOUBLE, 0) / o.t::DOUBLE >= 0.98 THEN 'pass' ELSE 'fail' END AS status FROM o LEFT JOIN u USING (bank_id, year, loan_currency) WHERE year BETWEEN {FIRST} AND {LAST} AND o.t <> 0",
    "backbone_merge": _BACKBONE + f""", agg AS (SELECT key, count(*) AS n_live, count(loan_amount) AS na, {_one('total_disbursement', 'disbursement_currency', 'sum({amount})')} AS s, {_one('total_disbursement', 'disbursement_currency', 'min({cur})')} AS sc,
  {_one('loan_amount', 'loan_currency', 'sum({amount})')} AS a, {_one('loan_amount', 'loan_currency', 'min({cur})')} AS ac, {_first('province')} AS p1, {_first('status')} AS p2, {_first('sector')} AS p3 FROM live WHERE key IS NOT NULL GROUP BY key)
SELECT o.key, coalesce(total_disbursement, s) AS total_disbursement, CASE WHEN total_disbursement IS NULL THEN coalesce(nullif(sc, ''), disbursement_currency) ELSE disbursement_currency END AS disbursement_currency,
  coalesce(loan_amount, a) AS loan_amount, CASE WHEN loan_amount IS NULL THEN coalesce(nullif(ac, ''), loan_currency) ELSE loan_currency END AS loan_currency,
  CAST(coalesce(na = n_live AND ac = loan_currency AND loan_amount <> 0 AND abs(a - loan_amount) > abs(loan_amount) * 0.01, false) AS INTEGER) AS conflict, coalesce(n_live, 0) AS n_live,
  coalesce(province, p1) AS province, coalesce(status, p2) AS status, coalesce(sector, p3) AS sector FROM off o LEFT JOIN agg ON agg.key = o.key""",
    "backbone_unmatched": _BACKBONE + f"SELECT row_id, CASE WHEN coalesce(CASE WHEN coalesce(approval_date, commitment_date) IS NOT NULL THEN coalesce(approval_date, commitment_date) > DATE '2015-12-31' ELSE approval_year > 2015 END, false) THEN 'kept-recent' WHEN coalesce(({_instrument('financing_instrument')}) = 'trade_finance', false) THEN 'kept-scope' ELSE 'excluded' END AS decision FROM live WHERE key NOT IN (SELECT key FROM off)",
    "theta_contains": "WITH n AS (SELECT *, regexp_replace(lower(project_id), '[^a-z0-9]+', '', 'g') AS k FROM project_records), keys AS (SELECT DISTINCT bank_id, k FROM n WHERE official_source_id IS NOT NULL AND approval_year IS NOT NULL AND k <> ''), ids AS (SELECT DISTINCT bank_id, k FROM n WHERE official_source_id IS NULL AND k <> '') SELECT bank_id, k AS key FROM keys WHERE EXISTS (SELECT 1 FROM ids WHERE ids.bank_id = keys.bank_id AND contains(ids.k, keys.k))",
    "donor_profile": "WITH n AS (SELECT *, regexp_replace(lower(project_id), '[^a-z0-9]+', '', 'g') AS k, coalesce(concessional = 'Yes', false) AS soft, loan_amount_usd AS c FROM project_records), ids AS (SELECT DISTINCT bank_id, k FROM n WHERE official_source_id IS NULL AND k <> ''), r AS (SELECT * FROM n WHERE official_source_id IS NOT NULL AND approval_year IS NOT NULL), keys AS (SELECT DISTINCT bank_id, k FROM r WHERE k <> ''), hit AS (SELECT * FROM keys WHERE EXISTS (SELECT 1 FROM ids WHERE ids.bank_id = keys.bank_id AND contains(ids.k, keys.k))) SELECT r.bank_id, approval_year AS year, count(*) AS n_rows, count(*) FILTER (WHERE c > 0) AS n_with_commitment, count(DISTINCT CASE WHEN c > 0 AND trim(project_id) <> '' THEN project_id END) AS n_projects, CAST(coalesce(sum(CASE WHEN c > 0 THEN c END), 0) AS DOUBLE) AS commitment, round_even(CAST(coalesce(sum(CASE WHEN c > 0 AND soft THEN c END), 0) AS DOUBLE) / CAST(sum(CASE WHEN c > 0 THEN c END) AS DOUBLE), 3) AS soft_share, count(DISTINCT CASE WHEN h.k IS NOT NULL AND c > 0 AND trim(project_id) <> '' THEN project_id END) AS n_matching FROM r LEFT JOIN hit h ON h.bank_id = r.bank_id AND h.k = r.k GROUP BY ALL",
    "prefix_first": "SELECT row_id, CASE WHEN lower(trim(bank_name)) LIKE 'karst%' THEN 'kdb' WHEN lower(trim(bank_name)) LIKE 'north%' THEN 'nrb' WHEN lower(trim(bank_name)) LIKE 'n%' THEN 'any' WHEN lower(trim(bank_name)) LIKE 'silt basin%' THEN 'sil' END AS owner FROM project_records",
    "scalar_currency": f"SELECT row_id, CASE WHEN lower({_CUR}) IN ({', '.join(repr(w) for w in _NULLS)}) THEN NULL WHEN contains({_CUR}, 'US$') THEN 'USD' WHEN contains({_CUR}, '€') THEN 'EUR' WHEN regexp_matches(upper({_CUR}), '(^|[^A-Z])US DOLLARS?($|[^A-Z])') THEN 'USD' WHEN regexp_matches(upper({_CUR}), '(^|[^A-Z])EUROS?($|[^A-Z])') THEN 'EUR' WHEN regexp_matches(upper({_CUR}), '(^|[^A-Z])SDR($|[^A-Z])') THEN 'XDR' WHEN regexp_matches(upper({_CUR}), '(^|[^A-Z])USD($|[^A-Z])') THEN 'USD' WHEN regexp_matches(upper({_CUR}), '(^|[^A-Z])EUR($|[^A-Z])') THEN 'EUR' WHEN regexp_matches(upper({_CUR}), '(^|[^A-Z])XDR($|[^A-Z])') THEN 'XDR' END AS currency FROM project_records",
    "scalar_dates": "WITH r AS (SELECT row_id, try_cast(approval_date AS DATE) AS d, try_cast(completion_date AS DATE) AS e FROM project_records) SELECT row_id, CAST(d AS VARCHAR) AS day_first, CAST(NULL AS VARCHAR) AS unknown_order, CAST(d AS VARCHAR) AS worded, CAST(year(d) AS INTEGER) AS year, CASE WHEN e - d >= 0 THEN round_even((e - d) / 365.2425::DOUBLE, 3) END AS years FROM r WHERE d IS NOT NULL",
    "html_links": "SELECT row_id, 0 AS pos, project_url AS href, trim(regexp_replace(bank_name, '\\s+', ' ', 'g')) AS label FROM project_records WHERE project_url IS NOT NULL AND bank_name IS NOT NULL",
    "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "star_revenue": "SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
}

ORACLE_SQL["record_problems"] = (
    "WITH p AS (SELECT row_id, list_filter(["
    + ", ".join(f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN '{c} is missing' END" for c in ("bank_id", "project_id", "project_name", "project_url"))
    + ", "
    + ", ".join(f"CASE WHEN {c} NOT BETWEEN 1900 AND 2200 THEN '{c} is out of range' END" for c in ("approval_year", "commitment_year"))
    + ", CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude is out of range' END, CASE WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude is out of range' END, "
    + ", ".join(f"CASE WHEN {c} < 0 THEN '{c} is negative' END" for c in ("loan_amount", "loan_amount_usd", "total_commitment", "cofinancing_amount"))
    + "], lambda x: x IS NOT NULL) AS problems FROM project_records) SELECT row_id, array_to_string(problems, '; ') AS problems FROM p WHERE len(problems) > 0"
)
ORACLE_SQL["finalized"] = f"""
WITH r AS (SELECT *, coalesce(approval_year, year(try_cast(approval_date AS DATE)), commitment_year) AS y FROM project_records)
SELECT row_id, CAST(y AS INTEGER) AS approval_year, CAST(coalesce(total_commitment, loan_amount) AS DOUBLE) AS total_commitment,
  CASE WHEN total_commitment IS NULL AND loan_amount IS NOT NULL THEN loan_currency ELSE commitment_currency END AS commitment_currency,
  CAST(coalesce(pipeline_stage, CAST(lower(status) IN ('pipeline', 'proposed', 'under appraisal', 'planned') AS TINYINT)) AS INTEGER) AS pipeline_stage
FROM r WHERE y IS NULL OR y BETWEEN {FIRST} AND {LAST}"""
# DuckDB resolves no character references: a letter with its mark is the letter (as after folding), the rest by name.
_REFS = "replace(replace(replace(regexp_replace({c}, '&([A-Za-z])(acute|grave|circ|uml|tilde|cedil|ring|caron);', '\\1', 'g'), '&amp;', '&'), '&#39;', chr(39)), '&apos;', chr(39))"
_TIDY = "trim(regexp_replace(" + _REFS + ", '[\\s\u00a0]+', ' ', 'g'))"
_SAID = "CASE WHEN lower(" + _TIDY + ") NOT IN (" + ", ".join(repr(w) for w in _NULLS) + ") THEN " + _TIDY + " END"
_K = "trim(regexp_replace(lower(strip_accents(" + _SAID + ")), '[^a-z0-9]+', ' ', 'g'))"
ORACLE_SQL["country_codes"] = f"""
WITH t AS (SELECT 1 AS tier, iso3 AS k, iso3 AS v FROM ref_countries UNION ALL SELECT 1, iso2, iso3 FROM ref_countries UNION ALL SELECT 2, country_name, iso3 FROM ref_countries UNION ALL SELECT 3, unnest(alt_names), iso3 FROM ref_countries),
tier AS (SELECT tier, {_K.format(c="k")} AS k, min(v) AS v FROM t GROUP BY ALL HAVING {_K.format(c="k")} <> ''),
r AS (SELECT row_id, country, {_K.format(c="country")} AS w, {_K.format(c="regexp_extract(" + _SAID.format(c="country") + ", '^([^;,]*)', 1)")} AS p FROM project_records),
hit AS (SELECT row_id, 0 AS part, tier, v FROM r JOIN tier ON tier.k = r.w UNION ALL SELECT row_id, 1, tier, v FROM r JOIN tier ON tier.k = r.p)
SELECT r.row_id, r.country, arg_min(h.v, h.part * 10 + h.tier) AS code FROM r LEFT JOIN hit h ON h.row_id = r.row_id GROUP BY r.row_id, r.country"""
ORACLE_SQL["fold_names"] = f"SELECT row_id, lower(strip_accents({_SAID.format(c='project_name')})) AS folded FROM project_records"
# Ids as one key of letters and digits; what stands before a bank's commonest shape is a prefix.
_IDS = f"""
WITH x AS (SELECT *, nullif(regexp_replace(lower(project_id), '[^\\p{{L}}\\p{{N}}]', '', 'g'), '') AS plain FROM ({_DATED})),
shaped AS (SELECT *, regexp_replace(regexp_replace(plain, '\\p{{L}}', 'A', 'g'), '\\p{{N}}', '9', 'g') AS shape FROM x),
usual AS (SELECT bank_id, shape AS usual FROM shaped WHERE plain IS NOT NULL GROUP BY bank_id, shape QUALIFY row_number() OVER (PARTITION BY bank_id ORDER BY count(*) DESC, shape DESC) = 1),
ids AS (SELECT s.*, CASE WHEN suffix(shape, usual) THEN right(plain, length(usual)) ELSE plain END AS k, o.roles FROM shaped s LEFT JOIN usual u ON u.bank_id IS NOT DISTINCT FROM s.bank_id
  LEFT JOIN official_sources o ON o.source_id = s.official_source_id)
"""
_NUMBERED = "bank_id, number, row_id AS ord, 1 AS n_records, approval_year, approval_date, loan_amount, loan_currency, total_disbursement, instrument"
ORACLE_SQL["group_by_number"] = (
    _IDS + f""", r AS (SELECT *, CASE WHEN regexp_full_match(k, '[0-9]{{8}}') THEN left(k, 5) || '-' || right(k, 3) END AS number, {_instrument('financing_instrument')} AS instrument FROM ids)
SELECT bank_id, number, min(row_id) AS ord, count(*) AS n_records, min(approval_year) AS approval_year, min(approval_date) AS approval_date, {_one('loan_amount', 'loan_currency', 'sum({amount})')} AS loan_amount,
  {_one('loan_amount', 'loan_currency', 'min({cur})')} AS loan_currency, {_one('total_disbursement', 'disbursement_currency', 'sum({amount})')} AS total_disbursement,
  coalesce(max(CASE WHEN instrument = 'loan' THEN 'loan' END), min(instrument)) AS instrument FROM r WHERE number IS NOT NULL GROUP BY bank_id, number
UNION ALL SELECT {_NUMBERED} FROM r WHERE number IS NULL"""
)
ORACLE_SQL["supplement_attach"] = (
    _IDS + """, p AS (SELECT *, coalesce(list_contains(roles, 'backbone'), false) AS listed FROM ids WHERE k IS NOT NULL AND bank_id IS NOT NULL AND (official_source_id IS NULL OR list_contains(roles, 'backbone'))
  QUALIFY row_number() OVER (PARTITION BY bank_id, k ORDER BY listed DESC, row_id) = 1)
SELECT l.row_id AS id, CASE WHEN coalesce(l.country_code = p.country_code, true) AND coalesce(abs(l.approval_year - p.approval_year) <= 6, true) THEN p.row_id END AS project_id
FROM ids l LEFT JOIN p ON p.bank_id = l.bank_id AND p.k = l.k WHERE list_contains(l.roles, 'supplement')"""
)
ORACLE_SQL["extra_fields_fill"] = (
    _IDS + """, o AS (SELECT * FROM ids WHERE list_contains(roles, 'extra-fields') AND k IS NOT NULL AND bank_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lower(bank_id), k ORDER BY row_id) = 1),
banks AS (SELECT DISTINCT unnest(bank_ids) AS bank_id FROM official_sources WHERE list_contains(roles, 'extra-fields'))
SELECT m.row_id AS id, m.bank_id || ':' || m.k AS key, coalesce(m.province, o.province) AS province, coalesce(m.completion_date, o.completion_date) AS completion_date,
  CASE WHEN o.financing_instrument <> '' AND NOT contains(lower(coalesce(m.financing_instrument, '')), lower(o.financing_instrument)) THEN concat_ws('; ', o.financing_instrument, nullif(coalesce(m.financing_instrument, ''), '')) ELSE m.financing_instrument END AS financing_instrument,
  CAST(o.k IS NOT NULL AS INTEGER) AS matched FROM ids m LEFT JOIN o ON lower(o.bank_id) = lower(m.bank_id) AND o.k = m.k WHERE m.official_source_id IS NULL AND m.bank_id IN (SELECT bank_id FROM banks)"""
)
ORACLE_SQL["loan_terms"] = (
    "SELECT p.bank_id, project_id, count(*) AS n_loans, CASE WHEN count(DISTINCT concessional) > 1 THEN 'Blended' ELSE min(concessional) END AS concessional, coalesce(string_agg(DISTINCT interest_rate, '; ' ORDER BY interest_rate), '') AS interest_rates, "
    "CASE WHEN count(DISTINCT interest_rate) = 1 THEN max(interest_rate) END AS single_rate, max(try_cast(last_disbursement_date AS DATE)) AS last_date FROM project_records p JOIN official_sources o ON o.source_id = p.official_source_id WHERE list_contains(roles, 'supplement') GROUP BY p.bank_id, project_id"
)
ORACLE_SQL["union_layout"] = "SELECT CAST(dense_rank() OVER (ORDER BY bank_id) - 1 AS INTEGER) AS input_no, bank_id, count(*) AS n FROM project_records WHERE bank_id IS NOT NULL GROUP BY bank_id"
_N = "CAST(abs(floor(loan_amount)) AS DECIMAL(24,2))"
ORACLE_SQL["scalar_amount"] = (
    f"WITH n AS (SELECT row_id, {_N} AS n FROM project_records), a AS ("
    + " UNION ALL ".join(
        f"SELECT row_id, '{name}' AS notation, CAST({value} AS DOUBLE) AS amount, CASE WHEN n IS NOT NULL THEN '{code}' END AS currency FROM n"
        for name, value, code in [
            ("worded", "(n + 0.25) * 1000000", "EUR"), ("grouped", "n + 0.5", "USD"), ("spanish", "(n + 0.5) * 1000000", "EUR"),
            ("bracketed", "-n", "USD"), ("unit of account", "n * 1000000", "XDR"), ("blanks", "n", "GBP"),
        ]
    )
    + ") SELECT * FROM a"
)
# a word for a public or private borrower inside the folded text
_L = "trim(regexp_replace(lower(strip_accents(" + _SAID.format(c="loan_type") + ")), '[^a-z0-9]+', ' ', 'g'))"
ORACLE_SQL["scalar_types"] = (
    f"SELECT row_id, CASE WHEN {_L} = 'nsg' OR regexp_matches({_L}, 'non ?sovereign|private|privado|sin garantia soberana|no soberan[oa]') THEN 'Non-sovereign' WHEN regexp_matches({_L}, '(quasi sovereign|cuasi soberano)') THEN 'Quasi-sovereign' "
    f"WHEN {_L} = 'sg' OR regexp_matches({_L}, 'sovereign|public|soberan[oa]|state|government|gobierno') THEN 'Sovereign' ELSE {_SAID.format(c='loan_type')} END AS loan_type, {_instrument('financing_instrument')} AS instrument FROM project_records"
)
_W = "CASE WHEN trim({c}) <> 'None' THEN " + _SAID + " END"
ORACLE_SQL["list_reader"] = (
    "SELECT rec_no, regexp_extract(upper(coalesce(" + _W.format(c="afdb_identifier") + ", '')), '(P-[A-Z0-9]{2}-[A-Z0-9]{3}-[0-9]{3})', 1) AS project_id, " + _W.format(c="title") + " AS project_name, "
    "CASE WHEN len(codes) = 1 THEN codes[1] END AS country_code, " + _W.format(c="country") + " AS country, try_cast(" + _W.format(c="approval_date") + " AS DATE) AS approval_date, "
    "CAST(try_cast(" + _W.format(c="total_commitments_usd") + " AS DECIMAL(22,4)) AS DECIMAL(22,4)) AS loan_amount, 'USD' AS loan_currency, try_cast(" + _W.format(c="total_disbursements_usd") + " AS DECIMAL(22,4)) AS total_disbursement, "
    + _W.format(c="activity_status") + " AS status, CASE upper(afdb_status) WHEN 'ADB' THEN 'No' WHEN 'ADF' THEN 'Yes' WHEN 'BLEND' THEN 'Blended' END AS concessional, " + _W.format(c="afdb_sector")
    + " AS sector FROM (SELECT *, regexp_extract_all(upper(CASE WHEN trim(country_codes) <> 'None' THEN country_codes ELSE '' END), '([A-Z0-9]{2})', 1) AS codes FROM afdb_projects)"
)
ORACLE_SQL["approvals_reader"] = (
    "WITH a AS (SELECT list_id, " + _SAID.format(c="economy") + " AS country, " + _SAID.format(c="project_name") + " AS project_name, CAST(CAST(us_million AS DECIMAL(18,6)) * 1000000 AS DECIMAL(22,4)) AS loan_amount, 'USD' AS loan_currency, "
    "approval_year, mode_of_finance AS financing_instrument FROM isdb_approvals), f AS (SELECT *, 'approval-' || substr(sha256(concat_ws('|', coalesce(country, ''), coalesce(project_name, ''), coalesce(CAST(approval_year AS VARCHAR), ''), "
    "coalesce(CAST(loan_amount AS VARCHAR), ''))), 1, 12) AS f FROM a) SELECT * EXCLUDE (f), CASE WHEN n = 1 THEN f ELSE f || '-' || n END AS record_id FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY list_id) AS n FROM f) QUALIFY true"
).replace("SELECT * EXCLUDE (f), CASE", "SELECT * EXCLUDE (f, n), CASE").replace(" QUALIFY true", "")
_PLAIN = "' ' || trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) || ' '"
# a name inside a longer one that is there as well is not a mention of its own
ORACLE_SQL["member_containment"] = f"""
WITH names AS (SELECT iso3 AS member, lower(country_name) AS n FROM ref_countries UNION SELECT iso3, lower(unnest(alt_names)) FROM ref_countries),
told AS (SELECT n, {_PLAIN.format(c="n")} AS k, min(member) AS member FROM names WHERE length(trim(n)) > 0 GROUP BY n HAVING count(DISTINCT member) = 1),
texts AS (SELECT row_id, {_PLAIN.format(c="project_name")} AS t FROM project_records),
hits AS (SELECT row_id, member, k FROM texts JOIN told ON contains(t, k)),
widest AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.row_id = h.row_id AND length(g.k) > length(h.k) AND contains(g.k, h.k)))
SELECT row_id, min(member) AS member FROM widest GROUP BY row_id HAVING count(DISTINCT member) = 1"""
_P4 = """
WITH v AS (
  SELECT load_no, 'loan_amount' AS column_name, CAST(loan_amount AS DECIMAL(32,4)) AS x, CAST(NULL AS VARCHAR) AS t, loan_amount IS NOT NULL AS there FROM project_records
  UNION ALL SELECT load_no, 'total_disbursement', CAST(total_disbursement AS DECIMAL(32,4)), NULL, total_disbursement IS NOT NULL FROM project_records
  UNION ALL SELECT load_no, 'province', NULL, province, coalesce(trim(regexp_replace(province, '\\s+', ' ', 'g')) <> '', false) FROM project_records),
m AS (
  SELECT load_no, column_name, count(*) AS n_rows, count(*) FILTER (WHERE there) AS n_filled, 1 - n_filled / n_rows AS null_share,
    (count(DISTINCT x) + count(DISTINCT CASE WHEN there THEN t END)) / n_rows AS distinct_per_row, median(CAST(x AS DOUBLE)) FILTER (WHERE x > 0) AS med,
    max(x) AS hi, min(x) AS lo, count(*) FILTER (WHERE there AND t IS NOT NULL AND (NOT regexp_full_match(t, '[\\p{L} .''\\-]*') OR NOT regexp_matches(t, '\\p{L}'))) / nullif(n_filled, 0) AS bad
  FROM v GROUP BY load_no, column_name),
b AS (SELECT *, lag(null_share) OVER w AS null0, lag(distinct_per_row) OVER w AS d0, lag(med) OVER w AS med0 FROM m WINDOW w AS (PARTITION BY column_name ORDER BY load_no))
SELECT load_no, column_name, 'null_rate' AS finding FROM b WHERE abs(null_share - null0) > 0.2
UNION ALL SELECT load_no, column_name, 'distinct' FROM b WHERE distinct_per_row * 2 < d0 OR distinct_per_row > 2 * d0
UNION ALL SELECT load_no, column_name, 'shift' FROM b WHERE column_name <> 'province' AND (med > 3 * med0 OR med0 > 3 * med)
UNION ALL SELECT load_no, column_name, 'range' FROM b WHERE column_name <> 'province' AND (hi > 9e13 OR (column_name = 'loan_amount' AND lo < 0))
UNION ALL SELECT load_no, column_name, 'pattern' FROM b WHERE column_name = 'province' AND bad > 0.02
"""
ORACLE_SQL["p4_found"] = _P4

_P4_PROFILE = """
WITH r AS (SELECT * FROM project_records {rows}), v AS (
  SELECT load_no, 'loan_amount' AS column_name, 'amount' AS kind, CAST(loan_amount AS DECIMAL(32,4)) AS x, NULL AS t FROM r
  UNION ALL SELECT load_no, 'total_disbursement', 'amount', CAST(total_disbursement AS DECIMAL(32,4)), NULL FROM r
  UNION ALL SELECT load_no, 'province', 'text', NULL, CASE WHEN trim(regexp_replace(province, '\\s+', ' ', 'g')) <> '' THEN province END FROM r),
w AS (SELECT *, coalesce(t, CAST(x AS VARCHAR)) AS value FROM v),
c AS (SELECT load_no, column_name, value, CAST(count(*) AS DOUBLE) AS n FROM w WHERE value IS NOT NULL GROUP BY ALL),
e AS (SELECT load_no, column_name, greatest(0.0, log2(sum(n)) - sum(n * log2(n)) / sum(n)) AS bits FROM c GROUP BY ALL),
m AS (SELECT load_no, column_name, any_value(kind) AS kind, count(*) AS n_rows, count(value) AS n_filled, count(DISTINCT value) AS n_distinct, min(x) AS min_value, max(x) AS max_value,
  count(*) FILTER (WHERE t IS NOT NULL AND (NOT regexp_full_match(t, '[\\p{L} .''\\-]*') OR NOT regexp_matches(t, '\\p{L}'))) AS n_pattern, median(CAST(x AS DOUBLE)) FILTER (WHERE x > 0) AS median_positive
  FROM w GROUP BY load_no, column_name)
SELECT m.*, 1 - n_filled / n_rows AS null_share, n_distinct / n_rows AS distinct_per_row, n_pattern / nullif(n_filled, 0) AS pattern_share, round(coalesce(bits, 0), 6) AS entropy_bits
FROM m LEFT JOIN e ON e.load_no = m.load_no AND e.column_name = m.column_name
"""
ORACLE_SQL["p4_profile"] = _P4_PROFILE.replace("{rows}", "")
ORACLE_SQL["p4_withdrawn"] = _P4_PROFILE.replace("{rows}", "WHERE load_no < (SELECT max(load_no) FROM project_records)")

# Names to codes as in country_codes; every column of a list is text in which a word for nothing is null.
_CODED = """
t AS (SELECT 1 AS tier, iso3 AS k, iso3 AS v FROM ref_countries UNION ALL SELECT 1, iso2, iso3 FROM ref_countries UNION ALL SELECT 2, country_name, iso3 FROM ref_countries UNION ALL SELECT 3, unnest(alt_names), iso3 FROM ref_countries),
tier AS (SELECT tier, """ + _K.format(c="k") + """ AS k, min(v) AS v FROM t GROUP BY ALL HAVING """ + _K.format(c="k") + """ <> ''),
hit AS (SELECT id, 0 AS part, tier, v FROM r JOIN tier ON tier.k = r.w UNION ALL SELECT id, 1, tier, v FROM r JOIN tier ON tier.k = r.p),
coded AS (SELECT id, arg_min(v, part * 10 + tier) AS country_code FROM hit GROUP BY id)
"""
_PLACE = _K.format(c="{c}") + " AS w, " + _K.format(c="regexp_extract(" + _SAID.format(c="{c}") + ", '^([^;,]*)', 1)") + " AS p"
_NO_CODE = "CASE WHEN country IS NOT NULL AND country_code IS NULL THEN 'no country code for ' || country END"
ORACLE_SQL["project_list"] = (
    "WITH r AS (SELECT rec_no AS id, *, " + _PLACE.format(c="country") + " FROM afdb_projects), " + _CODED
    + ", x AS (SELECT rec_no, " + _SAID.format(c="afdb_identifier") + " AS project_id, " + _SAID.format(c="title") + " AS project_name, " + _SAID.format(c="r.country") + " AS country, country_code, "
    + ", ".join(f"try_cast({_SAID.format(c=c)} AS DATE) AS {c}" for c in ("approval_date", "signature_date", "completion_date")) + ", " + _SAID.format(c="activity_status") + " AS status, " + _SAID.format(c="afdb_sector") + " AS sector, "
    + _SAID.format(c="afdb_status") + " AS w, " + ", ".join(f"try_cast({_SAID.format(c=c)} AS DECIMAL(22,4)) AS {c}" for c in ("total_commitments_usd", "total_disbursements_usd")) + " FROM r LEFT JOIN coded ON coded.id = r.id)"
    + " SELECT rec_no, project_id, project_name, country, country_code, approval_date, CAST(year(approval_date) AS INTEGER) AS approval_year, coalesce(signature_date, approval_date) AS commitment_date, completion_date, status, sector, NULL::VARCHAR AS financing_instrument,"
    + " CASE upper(w) WHEN 'ADF' THEN 'Yes' WHEN 'ADB' THEN 'No' END AS concessional, NULL::DECIMAL(22,4) AS loan_amount, NULL::VARCHAR AS loan_currency, NULL::DECIMAL(22,4) AS loan_amount_usd,"
    + " total_commitments_usd AS total_commitment, NULL::VARCHAR AS commitment_currency, total_commitments_usd AS total_commitment_usd, total_disbursements_usd AS total_disbursement, NULL::VARCHAR AS disbursement_currency, total_disbursements_usd AS total_disbursement_usd, "
    + _NO_CODE + " AS data_quality_notes FROM x"
)
ORACLE_SQL["project_approvals"] = (
    "WITH r AS (SELECT list_id AS id, *, " + _PLACE.format(c="economy") + " FROM isdb_approvals), " + _CODED
    + ", x AS (SELECT list_id, " + _SAID.format(c="project_name") + " AS project_name, " + _SAID.format(c="economy") + " AS country, country_code, approval_year AS y, " + _SAID.format(c="status") + " AS status, " + _SAID.format(c="mode_of_finance")
    + " AS financing_instrument, CAST(CAST(us_million AS DECIMAL(18,6)) * 1000000 AS DECIMAL(22,4)) AS a FROM r LEFT JOIN coded ON coded.id = r.id)"
    + " SELECT list_id, NULL::VARCHAR AS project_id, project_name, country, country_code, make_date(y, 1, 1) AS approval_date, y AS approval_year, make_date(y, 1, 1) AS commitment_date, NULL::DATE AS completion_date, status, NULL::VARCHAR AS sector, financing_instrument,"
    + " NULL::VARCHAR AS concessional, a AS loan_amount, 'USD' AS loan_currency, a AS loan_amount_usd, a AS total_commitment, 'USD' AS commitment_currency, a AS total_commitment_usd, NULL::DECIMAL(22,4) AS total_disbursement, 'USD' AS disbursement_currency, NULL::DECIMAL(22,4) AS total_disbursement_usd,"
    + " nullif(concat_ws('; ', " + _NO_CODE + ", CASE WHEN a IS NOT NULL THEN 'commitment copied from loan amount' END), '') AS data_quality_notes FROM x"
)
ORACLE_SQL["summary_counts"] = (
    "SELECT bank_id, count(*) AS n_records, " + ", ".join(f"count(*) FILTER (WHERE {_FILLED.format(c=c)}) AS n_{c}" for c in ("country_code", "sector", "loan_amount", "cofinancing_partners"))
    + ", min(approval_year) AS first_year, max(approval_year) AS last_year FROM project_records GROUP BY bank_id"
)
_MERGED = ORACLE_SQL["backbone_merge"]
_UNMATCHED = ORACLE_SQL["backbone_unmatched"]
ORACLE_SQL["merged_and_kept"] = (
    f"WITH m AS ({_MERGED}), u AS ({_UNMATCHED}), live AS (SELECT *, concat_ws(':', bank_id, lower(trim(project_id))) AS key FROM project_records WHERE official_source_id IS NULL)"
    " SELECT NULL::BIGINT AS row_id, key, province, status, sector, loan_amount, loan_currency, 'official' AS origin FROM m"
    " UNION ALL SELECT l.row_id, key, province, status, sector, loan_amount, loan_currency, decision FROM live l JOIN u ON u.row_id = l.row_id WHERE decision <> 'excluded'"
)
ORACLE_SQL["merge_fills"] = (
    _BACKBONE + f", m AS (SELECT * FROM ({_MERGED})) "
    + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE off.{f} IS NULL AND m.{f} IS NOT NULL) AS n_filled FROM off JOIN m ON m.key = off.key" for f in ("province", "status", "sector", "loan_amount", "total_disbursement"))
)
ORACLE_SQL["project_loans"] = (
    _IDS + """, k AS (SELECT *, bank_id || ':' || k AS key FROM ids WHERE k IS NOT NULL AND bank_id IS NOT NULL),
per AS (SELECT key, count(*) AS n_loans, sum(loan_amount) AS loan_principal, sum(total_disbursement) AS loan_disbursed, coalesce(string_agg(DISTINCT interest_rate, '; ' ORDER BY interest_rate), '') AS interest_rates,
  CASE WHEN count(DISTINCT interest_rate) = 1 THEN max(interest_rate) END AS single_rate, coalesce(string_agg(DISTINCT CAST(try_cast(completion_date AS DATE) AS VARCHAR), '; ' ORDER BY CAST(try_cast(completion_date AS DATE) AS VARCHAR)), '') AS last_repayment_dates,
  min(approval_date) AS first_board_date FROM k WHERE list_contains(roles, 'supplement') GROUP BY key)
SELECT k.row_id, k.key AS project_id, status, loan_amount_usd AS arm_amount, coalesce(n_loans, 0) AS n_loans, loan_principal, loan_disbursed, interest_rates, single_rate, last_repayment_dates, first_board_date FROM k LEFT JOIN per ON per.key = k.key
WHERE list_contains(roles, 'backbone') AND (coalesce(loan_amount_usd > 0, false) OR coalesce(loan_principal <> 0, false)) AND (coalesce(lower(trim(status)) <> 'dropped', true) OR coalesce(loan_principal <> 0, false))"""
)
