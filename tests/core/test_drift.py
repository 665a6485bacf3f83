import json
import random
from collections import Counter

from fundlens.operators import drift


def _frames(spark, payloads):
    rows = [(k, f, n, p) for k, (f, n, p) in enumerate(payloads)]
    files = sorted({f for f, _, _ in payloads})
    return spark.createDataFrame(rows, "raw_id long, file_id string, line_no int, payload string"), spark.createDataFrame([(f, 1, "x", f"2021-0{k + 1}-01") for k, f in enumerate(files)], "file_id string, feed_id long, bank_id string, as_of string")


def test_changes(spark):
    one = [{"id": 100 + k, "name": f"Proj {k}", "d": f"2010-01-{k + 10}", "amt": 1500000.5 + k * 1e6, "gone": "x", "same": None} for k in range(8)]
    two = [{"op": 100 + k, "name": [f"Proj {k}"], "approved": f"{k + 10}/01/2010", "amt": f"{1.5 + k:.2f} million", "came": 1, "same": None} for k in range(8)]
    lines = [("f1", k, json.dumps(r)) for k, r in enumerate(one)] + [("f2", k, json.dumps(r)) for k, r in enumerate(two)]
    lines += [("f1", 90, None), ("f1", 91, ""), ("f1", 92, '{"broken": '), ("f1", 93, "[1]"), ("f2", 94, json.dumps(two[0])), ("f3", 0, "nothing readable")]
    got = {tuple(r) for r in drift.changes(*_frames(spark, lines)).collect()}
    assert {g for g in got if g[0] == "f2"} == {
        ("f2", "renamed", "id", "op"), ("f2", "renamed", "d", "approved"), ("f2", "retyped", "name", "name"), ("f2", "retyped", "amt", "amt"),
        ("f2", "removed", "gone", ""), ("f2", "added", "", "came"),
    }
    assert {g[1] for g in got if g[0] == "f3"} == {"removed"} and len([g for g in got if g[0] == "f3"]) == 6
    assert not any(g[0] == "f1" for g in got)


def test_same_data():
    s = drift.same_data
    assert s("number", "1249084800000") == s("string", "01/08/2009") == s("string", "2009-08-01T00:00:00Z") == "2009-08-01"
    assert s("number", "14100000.5") == s("string", "14,100,000.5") == s("string", "14.10 million")
    assert s("object", '{"en": "A b"}') == s("array", '["A b"]') == s("string", " a B ") == "a b"
    assert s("number", "14827100") == "14827100" and s("string", "") == ""


def test_table_and_empty(spark):
    lines = [("f1", 1, '{"Project Number": 5, "APPR_DT": "31/12/2020", "montant": "2.50 million", "extra": "e"}'), ("f1", 2, '{"project_id": "a", "approval_date": "soon", "loan_amount": null}'), ("f1", 3, "x" * 100_000)]
    got = {r["line_no"]: r for r in drift.consistent_table(*_frames(spark, lines)).collect()}
    assert str(got[1]["approval_date"]) == "2020-12-31" and float(got[1]["loan_amount"]) == 2.5e6 and got[1]["project_id"] == "5" and "extra" in got[1]["other_fields"]
    assert got[2]["failed_casts"] == ["approval_date"] and set(got) == {1, 2}
    rows, files = _frames(spark, lines)
    assert drift.changes(rows.limit(0), files).count() == 0 and drift.consistent_table(rows.limit(0), files).count() == 0


def test_table_follows_renames(spark):
    """A spelling no list knows is found through its data; an object's first text is its value; repeats stay."""
    one = [{"project_id": f"P{k}", "title": f"Road {k}", "note": k} for k in range(6)]
    two = [{"ref no": f"P{k}", "denomination": {"en": f"Road {k}", "short": "R"}, "note": None} for k in range(6)]
    three = [{"kennung": f"P{k}", "denomination": f"Road {k}", "misc": True} for k in range(6)]
    lines = [(f"f{n}", k, json.dumps(r)) for n, rows in enumerate((one, two, three), 1) for k, r in enumerate(rows)] + [("f2", 0, json.dumps(two[0])), ("f2", 9, "{}")]
    rows, files = _frames(spark, lines)
    got = drift.consistent_table(rows, files.unionByName(files)).collect()
    assert len(got) == 20
    assert {(r["project_id"], r["project_name"]) for r in got} == {(f"P{k}", f"Road {k}") for k in range(6)} | {(None, None)}
    assert {r["other_fields"] for r in got if r["file_id"] == "f3"} == {'{"misc": "true"}'}
    found = {tuple(r) for r in drift.changes(rows, files).collect()}
    assert found == {
        ("f2", "renamed", "project_id", "ref no"), ("f2", "renamed", "title", "denomination"),
        ("f3", "renamed", "ref no", "kennung"), ("f3", "retyped", "denomination", "denomination"), ("f3", "removed", "note", ""), ("f3", "added", "", "misc"),
    }


def test_changes_against_brute_force(spark):
    """Random layouts: the same changes as counting all values of all fields in one process."""
    rng = random.Random(5)
    names = ["a", "b", "c", "d", "e"]
    lines = []
    for f in range(8):
        kept = rng.sample(names, 3)
        for k in range(12):
            lines.append((f"f{f}", k, json.dumps({n: rng.choice([f"v{k}", k, None, [f"v{k}"], rng.randint(0, 3)]) for n in kept if rng.random() < 0.9})))
    rows, files = _frames(spark, lines)
    want, last = set(), None
    for f in sorted({x[0] for x in lines}):
        held: dict[str, list] = {}
        for _, _, p in (x for x in lines if x[0] == f):
            for n, v in json.loads(p).items():
                held.setdefault(n, []).append(v)
        kinds = {n: "|".join(sorted({"array" if isinstance(v, list) else "string" if isinstance(v, str) else "number" for v in vs if v is not None})) for n, vs in held.items()}
        data = {n: Counter(str(v[0] if isinstance(v, list) else v).lower() for v in vs if v is not None) for n, vs in held.items()}
        if last:
            want |= {(f, "retyped", n, n) for n in kinds.keys() & last[0].keys() if kinds[n] != last[0][n] and kinds[n] and last[0][n]}
            went, came = last[0].keys() - kinds.keys(), kinds.keys() - last[0].keys()
            score = {}
            for o in went:
                for n in came:
                    common, least = sum((last[1][o] & data[n]).values()), min(last[1][o].total(), data[n].total())
                    if least and common / least >= drift.RENAME_OVERLAP:
                        score[o, n] = (-common / least, -common, o, n)
            won = {(o, n) for (o, n), s in score.items() if s == min(v for (x, _), v in score.items() if x == o) == min(v for (_, y), v in score.items() if y == n)}
            want |= {(f, "renamed", o, n) for o, n in won} | {(f, "removed", o, "") for o in went - {o for o, _ in won}} | {(f, "added", "", n) for n in came - {n for _, n in won}}
        last = (kinds, data)
    assert {tuple(r) for r in drift.changes(rows, files).collect()} == want and any(w[1] == "renamed" for w in want)
