"""The registered queries on the smallest data: SQL where there is some, properties of the whole result elsewhere."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest

from fundlens.core.tables import load
from fundlens.llm import queries, tokens

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def _sql(text):
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return Counter(c.execute(text).fetchall())


def test_survivors(spark):
    got = queries.p1_found(spark, DATA).select("group_id", "survivor_id")
    assert Counter(map(tuple, got.collect())) == _sql(queries.ORACLE_SQL["p1_found"]) and got.count() > 0


def test_every_token_is_placed_once(spark):
    sizes = {r["doc_id"]: r["n_tokens"] for r in tokens.sizes(load(spark, DATA, "documents").select("doc_id", "text")).collect()}
    specs = {r["spec_id"]: r["capacity_tokens"] for r in load(spark, DATA, "pack_specs").collect()}
    held, pieces = Counter(), defaultdict(list)
    for r in queries.p8_containers(spark, DATA).collect():
        held[r["spec_id"], r["container_id"]] += r["n_tokens"]
        pieces[r["spec_id"], r["doc_id"]].append((r["piece_no"], r["start_token"], r["n_tokens"]))
    assert all(n <= specs[s] for (s, _), n in held.items())
    assert set(pieces) == {(s, d) for s in specs for d, n in sizes.items() if n}
    for (s, d), parts in pieces.items():
        at = 0
        for k, (no, start, n) in enumerate(sorted(parts)):
            assert (no, start) == (k, at)
            at += n
        assert at == sizes[d] and (len(parts) == 1 or sizes[d] > specs[s])


def test_mixtures_keep_their_rules(spark):
    targets = {(r["recipe_id"], r["source"]): r for r in load(spark, DATA, "mix_targets").collect()}
    docs = {r["doc_id"]: r for r in tokens.sizes(load(spark, DATA, "documents").select("doc_id", "text", "source"), keep=("source",)).collect()}
    used, seen = Counter(), set()
    for r in queries.p9_mix(spark, DATA).collect():
        key = (r["recipe_id"], r["source"])
        assert 1 <= r["repeats"] <= targets[key]["max_repeats"] and docs[r["doc_id"]]["source"] == r["source"] and docs[r["doc_id"]]["n_tokens"] == r["n_tokens"]
        assert (*key, r["doc_id"]) not in seen
        seen.add((*key, r["doc_id"]))
        used[key] += r["n_tokens"] * r["repeats"]
    shares = {(r["recipe_id"], r["source"]): r for r in queries.p9_shares(spark, DATA).collect()}
    assert set(shares) == set(targets)
    for key, r in shares.items():
        assert r["tokens"] == used[key] <= r["budget"] <= r["wanted"]
        whole = sum(n for (recipe, _), n in used.items() if recipe == key[0])
        assert abs((r["actual_share"] or 0) - used[key] / max(whole, 1)) < 1e-6
    there = {d["source"] for d in docs.values() if d["n_tokens"]}
    for recipe in {k[0] for k in targets}:
        held = sum(t["target_share"] for k, t in targets.items() if k[0] == recipe and k[1] in there)
        longest = max(d["n_tokens"] for d in docs.values())
        whole = sum(n for (x, _), n in used.items() if x == recipe)
        for k, t in targets.items():
            if k[0] == recipe and k[1] in there:
                assert abs(used[k] - whole * t["target_share"] / held) <= longest


def test_pairs_are_one_to_one(spark):
    got = queries.p7_links(spark, DATA).collect()
    assert len({r["row_id"] for r in got}) == len({r["list_id"] for r in got}) == len(got) and all(0.8 <= r["confidence"] <= 1 for r in got)


def test_languages_cover_every_text(spark):
    seg = queries.p10_segments(spark, DATA).collect()
    docs = load(spark, DATA, "documents").where("trim(text) <> ''").select("doc_id").collect()
    assert {r["doc_id"] for r in seg if r["para_no"] == 0} == {r["doc_id"] for r in docs}
    found = {(r["doc_id"], r["para_no"]) for r in queries.p10_found(spark, DATA).collect()}
    assert found <= {(r["doc_id"], r["para_no"]) for r in seg}


def test_typed_countries_all_answered(spark):
    got = queries.p6_found(spark, DATA).collect()
    c = duckdb.connect()
    want = c.execute(f"SELECT row_id FROM '{DATA}/project_records.parquet' WHERE trim(country) <> '' AND country NOT IN (SELECT country_name FROM '{DATA}/ref_countries.parquet')").fetchall()
    assert sorted(r["row_id"] for r in got) == sorted(r[0] for r in want) and all(r["canon_code"] for r in got)
