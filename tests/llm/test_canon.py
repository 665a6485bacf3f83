import random

from hypothesis import given
from hypothesis import strategies as st

from fundlens.llm import canon

REF = [
    ("NK", "NKA", "North Karsia", ["Republic of North Karsia"]), ("SK", "SKA", "South Karsia", ["Republic of South Karsia"]), ("TO", "TRV", "Torvia", ["Republic of Torvia"]),
    ("TR", "TRN", "Torvinia", None), ("ML", "MLN", "Maluna", []), ("MB", "MLS", "Maluna-Bessar", ["Kingdom of Maluna-Bessar"]), ("DR", "DRV", "Republic of Dorvan", ["Upper Sambe"]),
    ("DM", "DMC", "Democratic Republic of Dorvan", []), ("CT", "CTM", "Côte d'Amarel", []), ("SV", "SVR", "São Tivaro", []),
]


def _map(spark, typed):
    ref = spark.createDataFrame(REF, "iso2 string, iso3 string, country_name string, alt_names array<string>")
    rows = spark.createDataFrame([(t, "x") for t in typed], "country string, typed string")
    return {r["typed"]: r["canon_code"] for r in canon.map_values(rows, ref).collect()}


def test_values(spark):
    want = {
        "North Karsia": "NKA", "N. Karsia": "NKA", "Karsia (South)": "SKA", "Karsia, North": "NKA", "SOUH KARSIA": "SKA", "Torviaa": "TRV", "Trvinia": "TRN", "torvia - capital area": "TRV",
        "Torvia (Lower Basin)": "TRV", "TRV": "TRV", "trn - Torvinia": "TRN", "Maluna": "MLN", "Malnua": "MLN", "MALUNA-BESAR": "MLS", "DR Dorvan": "DMC", "Dorvan (Rep.)": "DRV", "Dem. Rep. of Dorvan": "DMC",
        "Republic o Dorvan": "DRV", "C&ocirc;te d'Amarel": "CTM", "CÃ´te d'Amarel": "CTM", "Cote d Amarel": "CTM", "SO TVIARO": "SVR", "​Torvia\xa0": "TRV", "Upper Sambe": "DRV",
        "Republic of Ranonelvo": "UNMATCHED", "Karsian Union area": "UNMATCHED", "Global": "UNMATCHED", "Upper Mamergobad": "UNMATCHED", "Z1": "UNMATCHED", "?": "UNMATCHED", "x" * 20_000: "UNMATCHED",
    }
    got = _map(spark, [*want, *want, None, "", "  "])
    assert {k: v for k, v in got.items() if want.get(k) != v} == {} and len(got) == len(want)


def test_names_without_a_word_of_their_own(spark):
    """Every word of these names is in three entries; together they tell the entry, one alone tells none."""
    ref = [(None, f"{a[0]}{b[0]}".upper(), f"{a} {b}", None) for a in ("Upper", "Lower", "Middle") for b in ("Karsia", "Torvia", "Dorvan")]
    ref = spark.createDataFrame(ref, "iso2 string, iso3 string, country_name string, alt_names array<string>")
    want = {"Upper Karsia": "UK", "Lower Trovia": "LT", "Dorvan (Middle)": "MD", "Karsia": "UNMATCHED", "Upper": "UNMATCHED"}
    rows = spark.createDataFrame([(t,) for t in want], "country string")
    assert {r["typed"]: r["canon_code"] for r in canon.map_values(rows, ref).collect()} == want


def test_list_of_any_length(spark, monkeypatch):
    """A list that is joined gives what a list that is sent to every task gives."""
    many = [(f"X{k}", f"X{k}", f"{a} {b}", [f"Republic of {a} {b}"]) for k, (a, b) in enumerate((x + e, y) for x in ("kor", "vel", "mar", "tus") for e in ("ia", "an", "ova") for y in ("upper", "lower", "island"))]
    ref = spark.createDataFrame([*REF, *many], "iso2 string, iso3 string, country_name string, alt_names array<string>")
    typed = ["N. Karsia", "SOUH KARSIA", "torvia - capital area", "TRV", "trn - Torvinia", "DR Dorvan", "Rep. Dorvan", "MALUNA-BESAR", "Malu Bess", "C&ocirc;te d'Amarel", "Upper Sambe", "Global", "?", "koria upper", "lower velan", "Rep of marova islnd", "koria", "x" * 5000]
    rows = spark.createDataFrame([(t,) for t in typed], "country string")
    small = sorted(tuple(r) for r in canon.map_values(rows, ref).collect())
    monkeypatch.setattr(canon, "MAX_ENTRIES", 20)
    assert sorted(tuple(r) for r in canon.map_values(rows, ref).collect()) == small and len(small) == len(typed)
    assert sum(r[1] != canon.UNMATCHED for r in small) > 12


def test_empty(spark):
    assert _map(spark, []) == {}


@given(st.text("abcd", max_size=7), st.text("abcd", max_size=7))
def test_distance_is_symmetric_and_bounded(a, b):
    assert canon.edits(a, b) == canon.edits(b, a) <= max(len(a), len(b)) and (canon.edits(a, b) == 0) == (a == b)


def test_token_join_against_brute_force(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(2, 9))) for _ in range(60)})
    tokens = sorted({w[:i] + rng.choice("abcde") + w[i + 1 :] for w in words for i in range(2)} | set(words))
    got = {(r["token"], r["word"]) for r in canon.token_repairs(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    for t in tokens:
        for w in words:
            n = max(len(t), len(w))
            if canon.edits(t, w) <= (0 if n < 3 else 1 if n < 5 else 2):
                assert (t, w) in got or len(t) < 4 or len(w) < 4


def test_long_words_are_repaired_too(spark):
    long = "llanfairpwllgwyngyllgogerychwyrndrobwllllantysiliogogogoch"
    words = spark.createDataFrame([(long,), ("short",)], "word string")
    tokens = spark.createDataFrame([(long[:20] + long[21:],), (long + "x",), (long + "xyz",), ("x" * 100_000,), ("shrot",)], "token string")
    got = {(r["token"], r["word"]) for r in canon.token_repairs(tokens, words).collect()}
    assert got == {(long[:20] + long[21:], long), (long + "x", long), ("shrot", "short")}
