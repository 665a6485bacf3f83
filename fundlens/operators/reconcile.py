"""Merging collected rows with official lists: backbone, fuzzy, absorbing, supplement and extra-field joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import materialize
from fundlens.functions.alike import Names, alike, ratios
from fundlens.functions.text import word_key
from fundlens.operators.ordered import first_by


def single_currency_sum(amount: str, currency: str) -> Column:
    """Sum of an amount if all its rows share one currency (a blank one counts as a currency), else null."""
    cur = F.when(F.col(amount).isNotNull(), F.coalesce(F.col(currency), F.lit("")))
    return F.when(F.min(cur) == F.max(cur), F.sum(amount))


def single_currency(amount: str, currency: str) -> Column:
    cur = F.when(F.col(amount).isNotNull(), F.coalesce(F.col(currency), F.lit("")))
    return F.when(F.min(cur) == F.max(cur), F.min(cur))


def backbone(official: DataFrame, live: DataFrame, *, fields: list[str], summed: tuple[str, str] = ("total_disbursement", "disbursement_currency"), order: str = "ord") -> DataFrame:
    """Official rows with blanks filled from their live rows: (key, n_live, conflict, ...).

    Both sides have ``key``, ``loan_amount``, ``loan_currency``, the summed pair and ``fields``.  A repeated
    official key keeps its first row.  Missing amounts are summed from the live rows where they share a
    currency; a live sum in the official currency that differs by more than 1 % is reported as a conflict.
    The live side is aggregated by key first - partial sums, so a hot key is split - then joined.
    """
    amount, currency = "loan_amount", "loan_currency"
    aggs = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f"__{f}") for f in fields]
    agg = live.where("key IS NOT NULL").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_live"), F.count(amount).alias("__n_amount"),
        single_currency_sum(*summed).alias("__sum"), single_currency(*summed).alias("__sum_cur"),
        single_currency_sum(amount, currency).alias("__amount"), single_currency(amount, currency).alias("__amount_cur"), *aggs,
    )
    base = first_by(official.where("key IS NOT NULL"), [F.col("key")], F.col(order))
    df = base.join(agg, "key", "left")
    same = (F.col("__n_amount") == F.col("n_live")) & (F.col("__amount_cur") == F.col(currency))
    conflict = same & (F.col(amount) != 0) & (F.abs(F.col("__amount") - F.col(amount)) > F.abs(F.col(amount)) * F.lit("0.01").cast("decimal(3,2)"))
    out = {
        summed[0]: F.coalesce(F.col(summed[0]), F.col("__sum")),
        summed[1]: F.when(F.col(summed[0]).isNull(), F.coalesce(F.nullif(F.col("__sum_cur"), F.lit("")), F.col(summed[1]))).otherwise(F.col(summed[1])),
        amount: F.coalesce(F.col(amount), F.col("__amount")),
        currency: F.when(F.col(amount).isNull(), F.coalesce(F.nullif(F.col("__amount_cur"), F.lit("")), F.col(currency))).otherwise(F.col(currency)),
        "conflict": F.coalesce(conflict, F.lit(False)).cast("int"),
        "n_live": F.coalesce("n_live", F.lit(0)),
    }
    filled = {f: F.coalesce(F.col(f), F.col(f"__{f}")) for f in fields if f not in out}
    # all expressions read the original columns
    return df.select("key", *[e.alias(n) for n, e in {**out, **filled}.items()])


def unmatched(live: DataFrame, official: DataFrame, as_of: str, outside: Column) -> DataFrame:
    """Live rows without an official row and what becomes of each: ``kept-recent``, ``kept-scope`` or ``excluded``.

    Recent is approved (else committed) after ``as_of``; rows without a date go by their year.
    """
    day = F.coalesce("approval_date", "commitment_date")
    recent = F.when(day.isNotNull(), day > F.lit(as_of).cast("date")).otherwise(F.col("approval_year") > int(as_of[:4]))
    rest = live.join(official.select("key").distinct(), "key", "left_anti")
    return rest.withColumn("decision", F.when(F.coalesce(recent, F.lit(False)), "kept-recent").when(F.coalesce(outside, F.lit(False)), "kept-scope").otherwise("excluded"))


def group_by_number(live: DataFrame, number: str, order: str = "ord", bank: str = "bank_id") -> DataFrame:
    """One row per bank and project number: earliest year and date, amounts summed where they share a currency.

    Rows without a number stay as they are.  ``order`` is that of the first row.
    """
    grouped = live.where(F.col(number).isNotNull()).groupBy(bank, number).agg(
        F.min(order).alias(order), F.count(F.lit(1)).alias("n_records"), F.min("approval_year").alias("approval_year"), F.min("approval_date").alias("approval_date"),
        single_currency_sum("loan_amount", "loan_currency").alias("loan_amount"), single_currency("loan_amount", "loan_currency").alias("loan_currency"),
        single_currency_sum("total_disbursement", "disbursement_currency").alias("total_disbursement"),
        F.coalesce(F.max(F.when(F.col("instrument") == "loan", F.lit("loan"))), F.min("instrument")).alias("instrument"),
    )
    loose = live.where(F.col(number).isNull()).withColumn("n_records", F.lit(1).cast("long"))
    return grouped.unionByName(loose.select(*grouped.columns))


#: Pairs of rows of a block that may be held at once; bounds memory only.
_HELD = 1 << 20


def _in_blocks(left: DataFrame, right: DataFrame, *order: Column) -> DataFrame:
    """The rows of both sides (``__side`` 0 and 1) block by block, each whole block in one partition."""
    both = left.withColumn("__side", F.lit(0)).unionByName(right.withColumn("__side", F.lit(1))).where("__block IS NOT NULL AND id IS NOT NULL")
    # so many tasks in any case: the work is in the pairs, not in the bytes by which small partitions are put together
    return both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__block").sortWithinPartitions("__block", "__side", *order)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[dict[str, np.ndarray], dict[str, np.ndarray]]]:
    """The columns of both sides of every block that has rows on both."""
    held: list[dict[str, np.ndarray]] = []

    def sides() -> Iterator[tuple[dict[str, np.ndarray], dict[str, np.ndarray]]]:
        side = np.concatenate([h["__side"] for h in held])
        cut = int(np.searchsorted(side, 1))
        if 0 < cut < len(side):
            whole = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            yield {c: v[:cut] for c, v in whole.items()}, {c: v[cut:] for c, v in whole.items()}

    for b in batches:
        if not len(b):
            continue
        columns = {c: b[c].to_numpy() for c in b.columns}
        block = columns["__block"]
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if held and held[0]["__block"][0] != block[lo]:
                yield from sides()
                held.clear()
            held.append({c: v[lo:hi] for c, v in columns.items()})
    if held:
        yield from sides()


class _Amounts:
    """Amounts in order; of a given amount the places that lie within a tolerance."""

    def __init__(self, amounts: np.ndarray):
        there = np.flatnonzero(~np.isnan(amounts))
        self.places = there[np.argsort(amounts[there], kind="stable")]
        self.sorted = amounts[self.places]

    def near(self, amounts: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last (excluded) position that may be near each amount, a little too wide."""
        wide = amounts * tolerance + np.abs(amounts) * 1e-9
        with np.errstate(invalid="ignore"):
            lo = np.searchsorted(self.sorted, np.nan_to_num(amounts - wide, nan=-np.inf), "left")
            hi = np.searchsorted(self.sorted, amounts + wide, "right")
        return lo, np.where(np.isnan(amounts), lo, np.maximum(lo, hi))


def _near(theirs: np.ndarray, amount: np.ndarray | float, tolerance: float) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return np.abs(theirs - amount) <= amount * tolerance


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, position) of every position of the ranges."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def _by_name(codes: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of their names, and where the rows of each name begin and end there."""
    order = np.argsort(codes, kind="stable")
    at = np.searchsorted(codes[order], np.arange(names + 1))
    return order, at[:-1], at[1:]


def fuzzy_pairs(official: DataFrame, live: DataFrame, *, ratio: float = 0.8, ratio_with_amount: float = 0.5, tolerance: float = 0.02) -> DataFrame:
    """Scored candidates (oid, lid, score, country): same country, years at most one apart.

    Both sides: id, name, country, year, usd.  Two names pass at ``ratio``, or at a lower one if the amounts
    are within ``tolerance``.  Only pairs that pass leave a block of country and year; inside one the letters that both
    names have, then their longest common subsequence, rule most pairs out, and amounts are looked up in order.
    """
    side = lambda df, year, own: df.select(F.concat_ws("\u0001", "country", year.cast("string")).alias("__key"), "country", "id", word_key(F.col("name")).alias("name"), F.col("usd").cast("double").alias("usd"), year.alias("year"), own.alias("own"))
    keyed = lambda df: df.withColumn("__block", F.when(F.col("country").isNotNull() & F.col("year").isNotNull(), F.col("__key"))).drop("__key")
    near_years = official.withColumn("__own", F.col("year")).withColumn("year", F.explode(F.array("year", F.col("year") - 1, F.col("year") + 1)))
    both = _in_blocks(keyed(side(near_years, F.col("year"), F.col("__own"))), keyed(side(live, F.col("year"), F.col("year"))))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for o, n in _blocks(batches):
            n_code, n_names = pd.factorize(n["name"])
            amounts, known = _Amounts(n["usd"]), Names(list(n_names))
            n_order, n_from, n_to = _by_name(n_code, len(n_names))
            step = max(1, _HELD // len(n["id"]))
            for lo in range(0, len(o["id"]), step):
                part = {c: v[lo : lo + step] for c, v in o.items()}
                o_code, o_names = pd.factorize(part["name"])
                mine = Names(list(o_names))
                o_order, o_from, o_to = _by_name(o_code, len(o_names))
                x, y, r = alike(mine, known, ratio)
                # the rows of both names
                which, at = _spread(o_from[x], o_to[x])
                left, y, r = o_order[at], y[which], r[which]
                which, at = _spread(n_from[y], n_to[y])
                left, right, r = left[which], n_order[at], r[which]
                # rows with close amounts and less similar names
                which, at = _spread(*amounts.near(part["usd"], tolerance))
                at = amounts.places[at]
                close = _near(n["usd"][at], part["usd"][which], tolerance) & (o_code[which] >= 0) & (n_code[at] >= 0)
                which, at = which[close], at[close]
                named, back = np.unique(o_code[which] * max(1, len(n_names)) + n_code[at], return_inverse=True)
                less = ratios(mine, known, named // max(1, len(n_names)), named % max(1, len(n_names)), ratio_with_amount)[back]
                less_left, less_right = (v[(less >= ratio_with_amount) & (less < ratio)] for v in (which, at))
                r = np.r_[r, less[(less >= ratio_with_amount) & (less < ratio)]]
                left, right = np.r_[left, less_left], np.r_[right, less_right]
                close = _near(n["usd"][right], part["usd"][left], tolerance).astype(int)
                score = r + 0.1 * close - 0.01 * np.abs(part["year"][left] - part["own"][left])
                if len(r):
                    yield pd.DataFrame({"oid": part["id"][left], "lid": n["id"][right], "country": part["country"][left], "score": score})

    return both.mapInPandas(scored, "oid long, lid long, country string, score double")


def assign(pairs: DataFrame, left: str, right: str, left_key: Column, right_key: Column) -> DataFrame:
    """One-to-one pairs that a sequential pass would take, found in rounds over all blocks at once.

    In each round a pair stands if it has the greatest ``left_key`` of its left row and the greatest
    ``right_key`` of its right row; the pairs of taken rows drop out.  With one score on both sides this is
    the greedy pass by score; with preferences on the left and a common order on the right it is each left
    row choosing in turn.
    """
    rest = materialize(pairs.withColumn("__a", left_key).withColumn("__b", right_key))
    taken = None
    while True:
        top_l = rest.groupBy(left).agg(F.max("__a").alias("__a"))
        top_r = rest.groupBy(right).agg(F.max("__b").alias("__b"))
        won = materialize(rest.join(top_l, [left, "__a"], "left_semi").join(top_r, [right, "__b"], "left_semi").drop("__a", "__b"))
        taken = won if taken is None else taken.unionByName(won)
        if won.isEmpty():
            return taken
        rest = materialize(rest.join(won.select(left), left, "left_anti").join(won.select(right), right, "left_anti"))


def greedy_one_to_one(pairs: DataFrame, block: str | None = None) -> DataFrame:
    """(oid, lid, score): the pairs that a greedy pass by score takes, ties by the smaller ids.

    Where no row has pairs in two values of ``block``, the pass goes through the sorted pairs of each value and holds
    only the ids taken; else it is found in rounds.
    """
    if block is None:
        key = F.struct("score", (-F.col("oid")).alias("o"), (-F.col("lid")).alias("l"))
        return assign(pairs.select("oid", "lid", "score"), "oid", "lid", key, key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, left, right = None, set(), set()
        for b in batches:
            stays = []
            for where, o, n in zip(b[block].tolist(), b["oid"].tolist(), b["lid"].tolist(), strict=True):
                if where != now:
                    now, left, right = where, set(), set()
                stays.append(o not in left and n not in right)
                if stays[-1]:
                    left.add(o)
                    right.add(n)
            yield b.loc[np.array(stays, dtype=bool), ["oid", "lid", "score"]]

    inside = pairs.select(block, "oid", "lid", "score").repartition(block).sortWithinPartitions(block, F.desc("score"), "oid", "lid")
    return inside.mapInPandas(run, "oid long, lid long, score double")


def absorb(approvals: DataFrame, records: DataFrame, *, tolerance: float = 0.01, ratio: float = 0.8) -> DataFrame:
    """(approval id, record id): approvals in order, each absorbed by at most one free record.

    Both sides: id, name, country, year, amount, ord.  Inside a country and year an approval takes the first
    free record within ``tolerance`` of its amount, else the free record with the most similar name from
    ``ratio`` on; approvals choose in order.  Approvals without a record are the rows to add.

    Each block is one pass: close amounts are looked up in order, names are compared only for approvals that find none.
    """
    there = F.col("country").isNotNull() & F.col("year").isNotNull()
    side = lambda df: df.select(F.when(there, F.concat_ws("\u0001", "country", F.col("year").cast("string"))).alias("__block"), "id", "ord", word_key(F.col("name")).alias("name"), F.col("amount").cast("double").alias("amount"))
    both = _in_blocks(side(approvals), side(records), F.col("ord").asc_nulls_last(), F.col("id")).drop("ord")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for a, r in _blocks(batches):
            taken = _absorbed(a["amount"], a["name"], r["amount"], r["name"], tolerance, ratio)
            yield pd.DataFrame({"aid": a["id"][taken >= 0], "rid": r["id"][taken[taken >= 0]]})

    return both.mapInPandas(run, "aid long, rid long")


def _absorbed(a_amount: np.ndarray, a_name: np.ndarray, r_amount: np.ndarray, r_name: np.ndarray, tolerance: float, ratio: float) -> np.ndarray:
    """Of each approval of a block, in order, the place of its record, or -1."""
    a_code, a_names = pd.factorize(a_name)
    r_code, r_names = pd.factorize(r_name)
    known = Names(list(r_names))
    order, first, last = _by_name(r_code, len(r_names))
    amounts = _Amounts(r_amount)
    lo, hi = amounts.near(np.where(a_amount > 0, a_amount, np.nan), tolerance)
    taken, none = np.zeros(len(r_amount), dtype=bool), len(r_amount)
    free = amounts.places.copy()  # a taken record counts as none
    position = np.zeros(len(r_amount), dtype=np.int64)
    position[amounts.places] = np.arange(len(free))
    alikes: dict[int, list[tuple[float, int]]] = {}

    def compare(codes: np.ndarray) -> None:
        codes = np.array([c for c in np.unique(codes[codes >= 0]) if c not in alikes], dtype=np.int64)
        alikes.update((int(c), []) for c in codes)
        for x, y, r in zip(*alike(Names([a_names[c] for c in codes]), known, ratio), strict=True):
            alikes[int(codes[x])].append((float(r), int(y)))

    compare(a_code[lo == hi])
    out = np.full(len(a_amount), -1)
    for k in range(len(out)):
        hit = none
        if lo[k] < hi[k]:
            near = slice(lo[k], hi[k])
            hit = np.where(_near(amounts.sorted[near], a_amount[k], tolerance), free[near], none).min()
        if hit == none and a_code[k] >= 0:
            if a_code[k] not in alikes:
                compare(a_code[k:])
            best = (-1.0, 0)
            for r, y in alikes[a_code[k]]:
                while first[y] < last[y] and taken[order[first[y]]]:
                    first[y] += 1
                if first[y] < last[y]:
                    best = max(best, (r, -int(order[first[y]])))
            hit = -best[1] if best[0] >= 0 else none
        if hit < none:
            out[k] = hit
            taken[hit] = True
            if not np.isnan(r_amount[hit]):
                free[position[hit]] = none
    return out


def supplement(loans: DataFrame, projects: DataFrame, years: int = 6) -> DataFrame:
    """(loan id, project id or null): loans by number, if country and year do not speak against it.

    ``projects``: id, country, year, ord, numbers (array).  A number belongs to the first project with it.
    """
    numbers = projects.select(F.explode("numbers").alias("number"), F.struct("ord", "id", "country", "year").alias("p")).groupBy("number").agg(F.min("p").alias("p"))
    df = loans.join(numbers, "number", "left")
    place = F.coalesce(F.col("country") == F.col("p.country"), F.lit(True))
    near = F.coalesce(F.abs(F.col("year") - F.col("p.year")) <= years, F.lit(True))
    return df.select("id", F.when(place & near, F.col("p.id")).alias("project_id"))


def loan_terms(loans: DataFrame, *key: str) -> DataFrame:
    """Terms of a project from its loans: one concession flag or Blended, distinct rates, the last repayment."""
    flags = F.collect_set("concessional")
    return loans.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_loans"), F.when(F.size(flags) > 1, "Blended").otherwise(F.get(flags, 0)).alias("concessional"),
        F.array_join(F.array_sort(F.collect_set("interest_rate")), "; ").alias("interest_rates"), F.when(F.countDistinct("interest_rate") == 1, F.max("interest_rate")).alias("single_rate"),
        F.max("last_date").alias("last_date"),
    )


def extra_fields(records: DataFrame, official: DataFrame, fields: list[str], prepend: str) -> DataFrame:
    """Blank fields filled from the official row of the same id without case; its wording put before ours unless contained."""
    o = first_by(official.where("key IS NOT NULL"), [F.lower("key")], F.col("ord")).select(F.lower("key").alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields], F.col(prepend).alias(f"__{prepend}"))
    df = records.join(o, F.lower(records["key"]) == F.col("__k"), "left")
    wording, mine = F.col(f"__{prepend}"), F.coalesce(F.col(prepend), F.lit(""))
    new = F.when((wording != "") & ~F.contains(F.lower(mine), F.lower(wording)), F.concat_ws("; ", wording, F.nullif(mine, F.lit("")))).otherwise(F.col(prepend))
    return df.select("id", "key", *[F.coalesce(F.col(f), F.col(f"__{f}")).alias(f) for f in fields], new.alias(prepend), F.col("__k").isNotNull().cast("int").alias("matched"))
