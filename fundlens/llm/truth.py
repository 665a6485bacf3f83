"""Best representative of each duplicate group, by iterative truth discovery.

Rows that stand for one thing are brought together under a canonical id.  Per group and field, the sources
vote for values with weights; the weights are the sources' estimated reliabilities, which are in turn the
average support of the values they state.  The two are re-estimated alternately until they no longer move.
Declared trust (roles of official sources) enters as tiers that learnt reliability never crosses: inside a
tier the data decide, between tiers the declaration does.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect
from fundlens.operators.ids import canonical_ids

#: Order of trust of an official source's roles; a row without an official source comes last.
ROLE_ORDER = ("backbone", "supplement", "extra-fields", "backstop")
#: Sources are institutions and files they publish; the reliability table is one number for each.
MAX_SOURCES = 10_000
#: Different constellations of votes: a few hundred for dozens of sources.
MAX_PATTERNS = 200_000


def trust_tiers(sources: DataFrame) -> DataFrame:
    """(source_id, tier): the best role of each official source, 0 the most trusted."""
    tier = F.lit(len(ROLE_ORDER))
    for k in reversed(range(len(ROLE_ORDER))):
        tier = F.when(F.array_contains("roles", ROLE_ORDER[k]), F.lit(k)).otherwise(tier)
    return sources.groupBy("source_id").agg(F.min(tier).alias("tier"))


def _claims(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field, value, sources, n): who states which value; sources are a set of bounded size."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = rows.select(*keys, "__src", F.explode(pairs).alias("c")).select(*keys, "__src", "c.field", "c.value").where("trim(value) <> ''")
    return long.groupBy(*keys, "field", "value").agg(F.array_sort(F.collect_set("__src")).alias("sources"), F.count(F.lit(1)).alias("n"))


def _scored(sources: Column, weights: dict[str, float]) -> Column:
    """The sum of the sources' reliabilities."""
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map().cast("map<string,double>")
    return F.aggregate(sources, F.lit(0.0), lambda acc, s: acc + F.coalesce(table[s], F.lit(0.5)))


def vote_patterns(claims: DataFrame, keys: list[str]) -> DataFrame:
    """(pattern, n): how many groups and fields have this constellation of votes.

    A pattern is the sorted list of (sources, number of values that just these state); values themselves don't
    matter to reliability.  A group's entries are as many as its different sets of sources, whatever its rows.
    """
    sets = claims.groupBy(*keys, "field", "sources").agg(F.count(F.lit(1)).alias("k"))
    return sets.groupBy(*keys, "field").agg(F.array_sort(F.collect_list(F.struct("sources", "k"))).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def fixed_point(patterns: list[tuple[list[tuple[list[str], int]], int]], tiers: dict[str, int], rounds: int = 20, tolerance: float = 1e-3) -> tuple[dict[str, float], int]:
    """Reliability per source and the rounds taken, from vote patterns with their numbers.

    A value's vote is the sum of its sources' reliabilities; a source's reliability is the average share that
    its values have of their group's votes, an uncontested value counting 1.  In a tier of declared trust it
    moves between the bounds of that tier.
    """
    names = sorted({s for p, _ in patterns for sources, _ in p for s in sources})
    place = {s: i for i, s in enumerate(names)}
    low, high = min(tiers.values(), default=0), max(tiers.values(), default=0) + 1
    base = np.array([high - tiers.get(s, high) for s in names], dtype=float)
    entry_of, source_of, pattern_of, held, often = [], [], [], [], []
    for i, (p, n) in enumerate(patterns):
        for sources, k in p:
            source_of += [place[s] for s in sources]
            entry_of += [len(held)] * len(sources)
            pattern_of.append(i)
            held.append(float(k))
            often.append(float(k * n))
    entry_of, source_of, pattern_of = (np.array(x, dtype=int) for x in (entry_of, source_of, pattern_of))
    held, often = np.array(held), np.array(often)
    times = np.bincount(source_of, weights=often[entry_of], minlength=len(names))

    def in_tier(accuracy: np.ndarray) -> np.ndarray:
        return (base + np.clip(accuracy, 1e-3, 0.999)) / (high - low + 1)

    weights, taken = in_tier(np.full(len(names), 0.5)), 0
    for taken in range(1, rounds + 1):
        score = np.bincount(entry_of, weights=weights[source_of], minlength=len(held))
        total = np.bincount(pattern_of, weights=score * held, minlength=len(patterns))
        share = score / total[pattern_of] if len(held) else score
        after = in_tier(np.bincount(source_of, weights=(share * often)[entry_of], minlength=len(names)) / np.maximum(times, 1))
        moved = np.abs(after - weights).max(initial=0.0)
        weights = after
        if moved < tolerance:
            break
    return dict(zip(names, weights.tolist(), strict=True)), taken


def source_reliability(claims: DataFrame, keys: list[str], tiers: dict[str, int], rounds: int = 20, tolerance: float = 1e-3) -> tuple[dict[str, float], int]:
    """:func:`fixed_point` of all claims.

    Votes are first reduced to their patterns in the cluster, with map-side combine at each step, so a hot group
    is partial counts and the rounds cost nothing in the cluster.  More than ``MAX_PATTERNS`` patterns - thousands
    of sources that overlap freely - are an error, not a cut.
    """
    got = bounded_collect(vote_patterns(claims, keys), MAX_PATTERNS, "vote patterns")
    return fixed_point([([(list(e["sources"]), e["k"]) for e in r["pattern"]], r["n"]) for r in got], tiers, rounds, tolerance)


def _map(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv]) if values else F.create_map().cast("map<string,int>")


def resolve(
    rows: DataFrame,
    sources: DataFrame,
    *,
    fields: tuple[str, ...] = ("loan_amount",),
    first_field: str = "loan_amount",
    row_id: str = "row_id",
    bank: str = "bank_id",
    ident: str = "project_id",
    source: str = "official_source_id",
    updated: str = "source_updated_at",
    min_rows: int = 2,
    fused: bool = True,
) -> DataFrame:
    """One row per duplicate group: its id, its surviving row and the fused value of every field.

    ``group_id`` is the smallest ``row_id``.  ``survivor_id`` is the row that comes first by filled
    ``first_field``, the level of trust that its source's discovered reliability lies in, latest update (null
    last), smallest id: one ``max`` over structs with map-side combine.  ``<field>_value`` and
    ``<field>_support`` (with ``fused``) are the discovered truth: the value with the most reliability-weighted
    votes (ties: the most rows, then the greater text) and its share of them.  For ``first_field`` the vote is
    held among the sources of the survivor's tier, the most trusted that state it.  Rows without an id or a
    bank form no group; exact repeats vote once per source; a field that is null in the whole group stays null;
    empty tables give no row.
    """
    tier_of = trust_tiers(sources)
    tiers = {r["source_id"]: r["tier"] for r in bounded_collect(tier_of.where("source_id IS NOT NULL"), MAX_SOURCES, "official sources")}
    lowest = len(ROLE_ORDER)
    keys = [bank, "project_key"]
    fields = tuple(dict.fromkeys([first_field, *fields]))
    needed = list(dict.fromkeys([row_id, bank, ident, source, updated, *fields]))
    df = canonical_ids(rows.select(*needed), bank, ident).where(F.col("project_key").isNotNull() & F.col(bank).isNotNull())
    df = df.withColumn("__src", F.coalesce(F.col(source), F.concat(F.lit("live:"), F.col(bank))))
    claims = _claims(df, keys, list(fields))
    weights, _ = source_reliability(claims, keys, tiers)
    # declared tiers bound what is learnt, so a listed source's reliability tells its tier; one that states nothing has the declared one
    high = max(tiers.values(), default=0) + 1
    span = high - min(tiers.values(), default=0) + 1
    level = {s: min(high - int(weights[s] * span) if s in weights else t, lowest) for s, t in tiers.items()}
    tier = F.coalesce(_map(level)[F.col("__src")], F.lit(lowest))
    order = F.struct(
        F.col(first_field).isNotNull().alias("filled"),
        (-tier).alias("trust"),
        F.coalesce(F.col(updated).cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("updated"),
        (-F.col(row_id)).alias("neg_id"),
    )
    groups = (
        df.groupBy(*keys)
        .agg(F.min(row_id).alias("group_id"), F.max(order).alias("__top"), F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") >= min_rows)
        .select(*keys, "group_id", (-F.col("__top.neg_id")).alias("survivor_id"), "n_rows", (-F.col("__top.trust")).alias("survivor_tier"))
    )
    if not fused:
        return groups
    # votes for the first field count among the best tier that states a value, which is the survivor's
    best_tier = F.array_min(F.transform("sources", lambda s: F.coalesce(_map(level)[s], F.lit(lowest))))
    voting = F.when(F.col("field") == first_field, F.filter("sources", lambda s: F.coalesce(_map(level)[s], F.lit(lowest)) == F.col("__tier"))).otherwise(F.col("sources"))
    voted = claims.withColumn("__tier", F.when(F.col("field") == first_field, best_tier).otherwise(0)).withColumn("score", _scored(voting, weights))
    aggs = []
    for f in fields:
        mine = F.when(F.col("field") == f, F.struct((-F.col("__tier")).alias("t"), "score", "n", "value"))
        all_votes = [F.sum(F.when((F.col("field") == f) & (F.col("__tier") == t), F.col("score"))) for t in (range(lowest + 1) if f == first_field else (0,))]
        top = F.max(mine)
        total = F.get(F.array(*all_votes), -top["t"])
        aggs += [top["value"].alias(f"{f}_value"), F.round(F.try_divide(top["score"], total), 4).alias(f"{f}_support")]
    return groups.join(voted.groupBy(*keys).agg(*aggs), keys, "left")
