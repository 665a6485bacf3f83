import random

from fundlens.operators.packed import CodeCover, Segmenter, learn_dictionary, split_cells, split_codes

NAMES = ["Alpha Fund", "Ministry of Finance, Velmora", "Pool A; Pool B Vehicle", "Blue/Green Window", 'Fund "Amber"; Series 2', "Meridian | Desk", "Beta Trust"]


def test_rules():
    s = Segmenter(NAMES)
    assert s.split("Alpha Fund; Beta Trust") == ["Alpha Fund", "Beta Trust"]
    assert s.split("Alpha Fund, Ministry of Finance, Velmora, Beta Trust") == ["Alpha Fund", "Ministry of Finance, Velmora", "Beta Trust"]
    assert s.split('"Pool A; Pool B Vehicle", "Alpha Fund",Beta Trust') == ["Pool A; Pool B Vehicle", "Alpha Fund", "Beta Trust"]
    assert s.split('"Fund ""Amber""; Series 2"; Alpha Fund') == ['Fund "Amber"; Series 2', "Alpha Fund"]
    assert s.split("Alpha Fund / Blue/Green Window / Beta Trust") == ["Alpha Fund", "Blue/Green Window", "Beta Trust"]
    assert s.split("Unknown One, Ltd; Alpha Fund") == ["Unknown One, Ltd", "Alpha Fund"]
    assert s.split("Unknown One, Unknown Two") == ["Unknown One", "Unknown Two"]
    assert s.split(" ;; Alpha Fund ;\n") == ["Alpha Fund"]
    assert s.split("Alpha Fund\r\nAlpha Fund") == ["Alpha Fund", "Alpha Fund"]
    assert s.split(None) == s.split("  ") == []


def test_round_trip():
    rng, s = random.Random(1), Segmenter(NAMES)
    for _ in range(300):
        items = [rng.choice(NAMES) for _ in range(rng.randint(1, 6))]
        for sep in ("; ", ",", "|", "\n", " / "):
            cell = sep.join('"' + x.replace('"', '""') + '"' for x in items)
            assert s.split(cell) == items, cell


def test_long_cell():
    items = Segmenter([]).split(",".join(["a, b"] * 20_000))
    assert len(items) == 40_000


def test_frames(spark):
    df = spark.createDataFrame([(1, "A Fund; B Fund"), (2, "A Fund"), (3, None), (4, ""), (5, "A Fund, B Fund"), (6, "B Fund"), (7, "C, Inc; A Fund"), (8, '"C, Inc"')], "id long, cell string")
    assert {"A Fund", "B Fund", "C, Inc"} <= set(learn_dictionary(df, "cell"))
    got = sorted(map(tuple, split_cells(df.withColumnRenamed("cell", "pos"), "id", "pos").collect()))
    assert (1, 1, 2, "A Fund") in got and (5, 2, 2, "B Fund") in got and (7, 1, 2, "C, Inc") in got and not any(r[0] in (3, 4) for r in got)
    codes = spark.createDataFrame([(1, "['z1', 'aa']"), (2, "None"), (3, "AA BB"), (4, '"AA","ZZ"'), (5, None), (6, "AA - BB/AA")], "id long, cell string")
    ref = spark.createDataFrame([("AA",), ("BB",)], "iso2 string")
    got = sorted(map(tuple, split_codes(codes, "id", "cell", ref).collect()))
    assert [r[3] for r in got] == ["Z1", "AA", "AA", "BB", "AA", "ZZ", "AA", "BB", "AA"]


def test_dictionary_decides():
    """Cells that separators and quotes alone don't tell: each comes out wrong without the dictionary."""
    cells = {
        "Alpha Fund, Ministry of Finance, Velmora": ["Alpha Fund", "Ministry of Finance, Velmora"],
        "Pool A; Pool B Vehicle; Beta Trust": ["Pool A; Pool B Vehicle", "Beta Trust"],
        "Alpha Fund / Meridian | Desk": ["Alpha Fund", "Meridian | Desk"],
        "Ministry of Finance, Velmora,Ministry of Finance, Velmora": ["Ministry of Finance, Velmora"] * 2,
    }
    for cell, items in cells.items():
        assert Segmenter(NAMES).split(cell) == items and Segmenter([]).split(cell) != items, cell


def test_join_beyond_the_bound(spark):
    """The join to the names gives what the automaton of all names gives, on learnt names and hard cells."""
    rng = random.Random(6)
    cells = ['"' + n.replace('"', '""') + '"; Alpha Fund' for n in NAMES for _ in range(2)] + NAMES + ["", " ;; ", "x" * 50_000 + ", y", None]
    cells += [rng.choice(["; ", ", ", " / ", "|"]).join(rng.choice([n, '"' + n.replace('"', '""') + '"', "New, Co", "Other"]) for n in rng.choices(NAMES, k=rng.randint(1, 5))) for _ in range(150)]
    df = spark.createDataFrame([(k % 150, c, "clash") for k, c in enumerate(cells)], "id long, cell string, item string")
    one, other = (sorted(map(tuple, split_cells(df, "id", "cell", most=m).collect())) for m in (1000, 1))
    assert one == other and len(one) > 300
    assert one != sorted(map(tuple, split_cells(df, "id", "cell", names=[]).collect()))
    assert split_cells(df.limit(0), "id", "cell", most=0).count() == 0


def test_codes_without_separators(spark):
    cover = CodeCover(["AA", "AB", "BA", "ABA", "Z1"])
    assert cover.cut("AAZ1AB") == ["AA", "Z1", "AB"] and cover.cut("ABA") == ["ABA"] and cover.cut("ABABA") == ["ABA", "BA"]
    assert cover.cut("AAX") == ["AAX"] and CodeCover([]).cut("AB") == ["AB"]
    cells = [(1, "aaz1"), (2, "Z1;AA"), (3, "z1"), (4, "none, AB"), (5, "NONE"), (6, "AAQQ"), (7, None), (8, ""), (9, "AB" * 20_000), (9, "AA_AB")]
    codes = spark.createDataFrame([("aa",), ("AB",), (None,), ("",), ("AB",)], "iso2 string")
    df = spark.createDataFrame(cells, "id long, cell string")
    got = split_codes(df, "id", "cell", codes)
    held = {}
    for r in sorted(map(tuple, got.where("row_key < 9").collect())):
        held.setdefault(r[0], []).append(r[3])
    assert held == {1: ["AA", "Z1"], 2: ["Z1", "AA"], 3: ["Z1"], 4: ["AB"], 6: ["AAQQ"]}
    assert got.where("row_key = 9").count() == 20_002
    assert {r["item"] for r in split_codes(df.where("id = 1"), "id", "cell", codes.limit(0)).collect()} == {"AAZ1"}
    assert split_codes(df.limit(0), "id", "cell", codes).count() == 0
