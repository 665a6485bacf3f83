import numpy as np
from pyspark.sql import functions as F

from fundlens.llm import linkage


def _data(spark, n=120):
    kinds = ["Bridge Replacement", "Wind Park", "Rural Water", "Teacher Training"]
    syl = ["ba", "ko", "ra", "mi", "zu", "tel", "vor", "nas"]
    place = lambda k: (syl[k % 8] + syl[k // 8 % 8] + syl[k * 5 % 8] + syl[k // 3 % 8] + syl[(k * 7 + 3) % 8]).title()
    left = [(k, f"{place(k)} {kinds[k % 4]} Project" + (" Phase II" if k % 5 == 0 else ""), f"C{k % 6}", 2000 + k % 20, 1e6 * (k + 1)) for k in range(n)]
    right = [(1000 + k, f"{kinds[k % 4]} ({place(k)})" + (" Ph. 2" if k % 5 == 0 else ""), f"C{k % 6}" if k % 7 else None, 2000 + k % 20 + (k % 3 == 0), None if k % 11 == 0 else 1.01e6 * (k + 1)) for k in range(0, n, 2)]
    right += [(5000 + k, f"{kinds[k % 4]} ({place(k)}) Phase 3", f"C{k % 6}", 2000 + k % 20, 3e6 * (k + 1)) for k in range(1, n, 4)]
    right += [(9000, None, None, None, None), (9001, "", "C1", 2001, 1.0)]
    left += [(7000, None, None, None, None), (7001, "x" * 50_000, "C1", 2001, 0.0)]
    schema = "id long, name string, country string, year int, usd double"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), {(k, 1000 + k) for k in range(0, n, 2)}


def test_links(spark):
    left, right, want = _data(spark)
    got = linkage.link(left, right, []).collect()
    pairs = {(r["lid"], r["rid"]) for r in got}
    assert len({r["lid"] for r in got}) == len({r["rid"] for r in got}) == len(got)
    assert len(pairs & want) >= 0.9 * len(want) and len(pairs - want) <= 3
    assert all(0.5 <= r["confidence"] <= 1 for r in got)


def test_empty(spark):
    left, right, _ = _data(spark, 4)
    assert linkage.link(left.limit(0), right, []).count() == 0


def test_label_model_finds_classes():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    acc = [0.95, 0.9, 0.8, 0.75]
    x = np.stack([np.where(rng.random(4000) < a, y, ~y).astype(int) for a in acc], axis=1)
    x = np.concatenate([x, x[:, 3:]], axis=1)  # a copy: fully dependent
    x[rng.random(x.shape) < 0.1] = -1
    seen, back, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    model = linkage.LabelModel(seen, n, [[-1, 1]] * 5)
    assert ((model.p[back] > 0.5) == y).mean() > 0.93 and (3, 4) in model.groups


def test_stage():
    assert [linkage.stage_of(t.split()) for t in ("a phase ii", "a ph 3", "a b i", "a", "")] == [2, 3, 1, 0, 0]


SCHEMA = "id long, tokens array<string>, country string, year int, usd double"


def _pairs(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    generic, hot = linkage.frequent_words(a, b, [])
    return {(r["lid"], r["rid"]): r["d"] for r in linkage.candidates(a, b, generic, hot).collect()}, generic, hot


def test_candidates_of_a_hot_place(spark):
    kinds = ["bridge", "water", "school"]
    left = [(k, [f"place{chr(97 + k % 26)}{chr(97 + k // 26)}", kinds[k % 3]], f"C{k % 7}", 2000, 1e6) for k in range(120)]
    left += [(1000 + k, ["kobara", kinds[k % 3], f"n{k}"], "C1", 2000 + k % 3, 1e6 * 2 ** (k % 40)) for k in range(60)]
    right = [(1, ["kobara", "bridge"], "C1", 2000, None), (2, ["kobbara"], None, 2001, 4e6), (3, ["kobara"], "C1", None, None), (4, ["kobara"], None, None, 1e6)]
    got, generic, hot = _pairs(spark, left, right)
    assert hot == ["kobara"] and set(kinds) <= set(generic)
    lefts = {r[0]: r for r in left if "kobara" in r[1]}
    assert {p for p in got if p[1] == 1} == {(k, 1) for k, r in lefts.items() if abs(r[3] - 2000) <= 1}
    assert {p for p in got if p[1] == 3} == {(k, 3) for k in lefts}  # the country is all that both have
    assert {k for k, r in lefts.items() if r[4] == 4e6 and r[3] <= 2002} <= {k for k, rid in got if rid == 2}
    assert {k for k, r in lefts.items() if r[4] == 1e6} <= {k for k, rid in got if rid == 4}


def test_candidates_of_copies(spark):
    left = [(k, ["kobara", "bridge"], "C1", 2000, 1e6) for k in range(50)] + [(100, ["miteku", "bridge"], "C2", 2000, 1e6)]
    got, generic, hot = _pairs(spark, left, [(1, ["kobara"], "C1", 2005, 9e6)])
    assert set(got) == {(k, 1) for k in range(50)} and not generic and not hot


def test_candidates_without_a_rare_word(spark):
    left = [(k, [f"place{chr(97 + k % 26)}{chr(97 + k // 26)}", "water"], f"C{k % 7}", 2000 + k % 3, 1e6 * (k + 1)) for k in range(60)]
    left += [(100, ["water"], "C1", 2000, 5e9), (101, ["ur", "water"], "C2", 2000, 1e6)]
    got, generic, _ = _pairs(spark, left, [(1, ["water"], "C1", 2001, 5e9), (2, ["ur", "project"], "C2", 2000, None), (3, ["water"], "C1", 2009, 8e12)])
    assert generic == ["water"]
    assert got[(100, 1)] is None and got[(101, 2)] == 0 and not {p for p in got if p[1] == 3}


def test_assign_to_the_end(spark):
    # every line is first wanted by the row before: a round settles one pair
    chain = [(k, k, 0.9, -0.02 * k) for k in range(10)] + [(k + 1, k, 0.9, -0.02 * k - 0.01) for k in range(9)]
    got = linkage.assign(spark.createDataFrame(chain, "lid long, rid long, confidence double, closeness double")).collect()
    assert {(r["lid"], r["rid"]) for r in got} == {(k, k) for k in range(10)}


def test_links_of_copies(spark):
    left, right, want = _data(spark)
    again = lambda df: df.where("id < 20 OR id BETWEEN 1000 AND 1019").withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(9)))).select((F.col("id") + F.col("c") * 100_000).alias("id"), "name", "country", "year", "usd")
    got = linkage.link(left.union(again(left)), right.union(again(right)), []).collect()
    pairs = [(r["lid"], r["rid"]) for r in got]
    once = {p for p in pairs if p in want and p[0] < 20}
    assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
    assert len(once) >= 8
    assert {(a + c * 100_000, b + c * 100_000) for a, b in once for c in range(10)} <= set(pairs)
