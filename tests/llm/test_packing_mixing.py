import itertools
import random
from collections import Counter, defaultdict

from fundlens.llm import mixing, packing, tokens


def test_packing_keeps_everything(spark):
    rng = random.Random(2)
    sizes = [(k, rng.choice([1, 5, 60, 200, 511, 512, 513, 1500, 9000])) for k in range(3000)] + [(9001, 0), (9002, None), (7, 5)]
    specs = spark.createDataFrame([(1, 512), (2, 2048), (3, None)], "spec_id int, capacity_tokens int")
    out = packing.pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long").repartition(3), specs).collect()
    for spec, cap in ((1, 512), (2, 2048)):
        load, pieces = Counter(), defaultdict(list)
        for r in (r for r in out if r["spec_id"] == spec):
            load[r["container_id"]] += r["n_tokens"]
            pieces[r["doc_id"]].append((r["start_token"], r["n_tokens"]))
        assert max(load.values()) <= cap
        want = Counter()
        for k, n in sizes:
            want[k] += n or 0
        assert {k: sum(n for _, n in p) for k, p in pieces.items()} == {k: n for k, n in want.items() if n}
        assert all(len(p) == 1 for k, p in pieces.items() if want[k] <= cap and k != 7)
        total = sum(load.values())
        assert total / (len(load) * cap) > 0.97
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long"), specs).count() == 0


def test_sizes(spark):
    texts = [(1, "The loan was cancelled.", "a"), (2, "", "a"), (3, None, None), (4, "<|endoftext|> x", "b"), (5, "word " * 40_000, "b")]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.sizes(spark.createDataFrame(texts, "doc_id long, text string, source string"), keep=("source",)).collect()}
    twice = spark.createDataFrame([(6, "The loan was cancelled."), (7, "The loan was cancelled."), (7, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_tokens"]) for r in tokens.sizes(twice.coalesce(1)).where("n_tokens >= 0").collect()) == [(6, 5), (7, 0), (7, 5)]
    assert got[2] == got[3] == 0 and got[1] == 5 and got[4] > 2 and got[5] >= 40_000


def test_ranks_and_json_count_alike():
    rng = random.Random(3)
    texts = ["", "a" * 50_000, " " * 60_000 + "x", "x\n" + "\n" * 60_000, "<|endoftext|>", "漢字" * 900, "Prêt à l'État n° 12\t\tUSD 1,000.5 million!!", "\0" * 9]
    texts += ["".join(rng.choice("aé \n.7'x") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    ranks, listed = tokens.counter(tokens.TOKENIZER), tokens.counter("/opt/tokenizers/byte_bpe_50k.json")
    assert ranks(texts) == listed(texts)


def test_subset_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 40), 4))
        counts = [rng.randint(0, 3) for _ in lengths]
        rest = rng.randint(0, sum(n * c for n, c in zip(lengths, counts)))
        best = max(s for t in itertools.product(*[range(c + 1) for c in counts]) if (s := sum(n * x for n, x in zip(lengths, t))) <= rest)
        take = mixing.subset(lengths, counts, rest)
        assert all(0 <= t <= c for t, c in zip(take, counts)) and sum(n * t for n, t in zip(lengths, take)) == best
    lengths, counts = list(range(3, 900)), [50] * 897
    take = mixing.subset(lengths, counts, 9_876_543)
    assert sum(n * t for n, t in zip(lengths, take)) == 9_876_543


def test_mixture(spark):
    rng = random.Random(6)
    docs = [(k, "big", rng.randint(1, 300)) for k in range(2000)] + [(9000 + k, "small", rng.randint(1, 50)) for k in range(30)] + [(5, None, 10), (6, "big", 0)] + [(20000 + k, "big", 7) for k in range(1000)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([(1, "big", 0.7, 2), (1, "small", 0.2, 3), (1, "absent", 0.1, 3), (2, "small", 1.0, 2)], "recipe_id int, source string, target_share double, max_repeats int")
    rows, shares = mixing.mix(sizes, targets)
    used = rows.collect()
    most = {(1, "big"): 2, (1, "small"): 3, (2, "small"): 2}
    assert all(1 <= r["repeats"] <= most[r["recipe_id"], r["source"]] for r in used)
    got = {(r["recipe_id"], r["source"]): r for r in shares.collect()}
    for key in most:
        assert got[key]["tokens"] == sum(r["n_tokens"] * r["repeats"] for r in used if (r["recipe_id"], r["source"]) == key) == got[key]["budget"]
    assert abs(got[1, "big"]["actual_share"] - 0.7 / 0.9) < 1e-3 and got[1, "absent"]["tokens"] == 0 and got[2, "small"]["actual_share"] == 1
    assert mixing.mix(sizes.limit(0), targets)[0].count() == 0


def test_budget_is_met_beyond_the_first_window():
    """A budget that the last tokens alone can't meet: the window grows, up to the optimum."""
    lengths, counts = [1001, 3000], [40, 200]
    rest = 40 * 1001 + 100 * 3000  # only with all the short ones
    take = mixing.subset(lengths, counts, rest, window=2000)
    assert sum(n * t for n, t in zip(lengths, take)) == rest and all(t <= c for t, c in zip(take, counts))
    assert mixing.subset([4, 6], [50_000, 50_000], 100_001) and sum(n * t for n, t in zip([4, 6], mixing.subset([4, 6], [50_000, 50_000], 100_001))) == 100_000
    assert mixing.subset([5], [3], 99) == [3] and mixing.subset([], [], 5) == [] and mixing.subset([7], [0], 7) == [0]


def test_given_size_reports_what_is_short():
    plan = {b["source"]: b for b in mixing.budgets([(1, "big", 0.5, 1), (1, "small", 0.5, 2), (1, "none", 0.0, 2)], {"big": 1000, "small": 10}, size=800)}
    assert (plan["big"]["budget"], plan["small"]["wanted"], plan["small"]["budget"], plan["none"]["budget"]) == (400, 400, 20, 0)
