import math
import random
from collections import Counter
from statistics import median

import pytest

from fundlens.core import tables
from fundlens.operators import quality

COLS = {"a": "amount", "p": "text"}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "load_no int, a double, p string, value string")


def test_profile_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.randint(1, 4), rng.choice([None, -3.0, 0.0, round(rng.lognormvariate(10, 4), 2)]), rng.choice([None, "", "  ", "Aba", "X 1", "O'Neil-Ü.", "--"]), "clash") for _ in range(3000)]
    got = {(r["load_no"], r["column_name"]): r for r in quality.profile(quality.value_counts(_rows(spark, rows), "load_no", COLS), "load_no").collect()}
    for load in range(1, 5):
        values = [a for n, a, _, _ in rows if n == load]
        there = [a for a in values if a is not None]
        r = got[load, "a"]
        assert (r["n_rows"], r["n_filled"], r["n_distinct"]) == (len(values), len(there), len(set(there)))
        assert math.isclose(r["median_positive"], median([x for x in there if x > 0]), rel_tol=1e-12)
        assert float(r["min_value"]) == min(there) and float(r["max_value"]) == max(there)
        c = Counter(there)
        assert math.isclose(r["entropy_bits"], -sum(k / len(there) * math.log2(k / len(there)) for k in c.values()), abs_tol=1e-5)
        texts = [p for n, _, p, _ in rows if n == load and p and p.strip()]
        assert got[load, "p"]["n_filled"] == len(texts) and got[load, "p"]["n_pattern"] == sum(t in ("X 1", "--") for t in texts)


def test_store_and_signed_deltas(spark, tmp_path):
    one, two = _rows(spark, [(1, 5.0, "A", None), (1, None, "B", None)]), _rows(spark, [(2, 7.0, "A", None)])
    store = quality.ValueCountStore(spark, str(tmp_path / "s"))
    store.apply(quality.value_counts(one, "load_no", COLS))
    store.apply(quality.value_counts(two, "load_no", COLS))
    store.apply(quality.value_counts(two, "load_no", COLS, sign=-1))
    state = store.compact(str(tmp_path / "t")).state()
    assert {r["load_no"] for r in state.collect()} == {1} and state.agg({"n": "sum"}).first()[0] == 4


def test_store_starts_from_its_last_state(spark, tmp_path):
    one, two = _rows(spark, [(1, 5.0, "A", None), (1, 5.0, "A", None)]), _rows(spark, [(2, 7.0, None, None)])
    store = quality.ValueCountStore(spark, str(tmp_path / "s"))
    assert store.state().count() == 0
    store.apply(quality.value_counts(_rows(spark, []), "load_no", COLS))
    assert store.state().count() == 0
    for _ in range(2):  # a repeated job counts once
        store.apply(quality.value_counts(one, "load_no", COLS), number=7)
    store.fold().apply(quality.value_counts(one.limit(1), "load_no", COLS, sign=-1))
    store.apply(quality.value_counts(two, "load_no", COLS))
    again = quality.ValueCountStore(spark, str(tmp_path / "s"))  # another process
    assert sorted((r["load_no"], r["column_name"], r["value"], r["n"]) for r in again.state().collect() if r["value"]) == [(1, "a", "5.0000", 1), (1, "p", "A", 1), (2, "a", "7.0000", 1)]
    assert [p.split("-")[1] for p in again._parts()] == ["delta", "delta", "state", "delta", "delta"]


def test_shared_folder_is_required_on_clusters(spark, monkeypatch):
    class Context:
        master = "spark://one:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {"spark.checkpoint.dir": None}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.ensure_checkpoint_dir(Session)


def test_findings_and_empty(spark):
    rows = [(1, 10.0, "A", None)] * 4 + [(2, 40.0, "A1", None)] * 3 + [(2, None, None, None)] + [(5, 9.5e13, "B", None)] + [(6, None, None, None)] * 2
    m = quality.profile(quality.value_counts(_rows(spark, rows), "load_no", COLS), "load_no")
    got = {tuple(r) for r in quality.findings(m, "load_no", not_negative=("a",)).collect()}
    assert {(2, "a", "null_rate"), (2, "a", "shift"), (2, "p", "pattern"), (5, "a", "range"), (6, "a", "null_rate")} <= got
    assert not any(r[0] == 1 for r in got)
    empty = _rows(spark, [])
    assert quality.findings(quality.profile(quality.value_counts(empty, "load_no", COLS), "load_no"), "load_no").count() == 0
