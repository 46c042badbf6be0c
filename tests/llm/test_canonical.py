import random

import pytest

from fluelake.llm import canonical as C

FUELS = [(101, ["Natural Gas", "NG"]), (102, ["Propane", "LPG"]), (103, ["#2 Fuel Oil"]), (104, ["#6 Fuel Oil"]), (105, ["Diesel"]), (113, ["Petroleum Coke"]), (119, ["Biodiesel"]), (118, ["Coke Oven Gas"])]
UNITS = [(301, ["Water Tube Boiler"]), (302, ["Fire Tube Boiler"]), (303, ["Process Heater"]), (306, ["Emergency Generator"]), (319, ["Cyclone Separator"]), (322, ["Fixed Roof Tank"]), (323, ["Floating Roof Tank"])]


@pytest.mark.parametrize(
    ("entries", "value", "want"),
    [
        (FUELS, "pipeline natural gas", 101), (FUELS, "gas, naatural", 101), (FUELS, "nat. gas", 101), (FUELS, "ng", 101), (FUELS, "no. 2 fuel oil", 103), (FUELS, "Fuel oil #6", 104),
        (FUELS, "bio-diesel", 119), (FUELS, "bio dieesel", 119), (FUELS, "DESSEL OIL", 105), (FUELS, "petcoke", 113), (FUELS, "pproane gas", 102), (FUELS, "corn stover", 0), (FUELS, "gas", 0),
        (FUELS, "fuel oil", 0), (FUELS, "process off-gas", 0), (FUELS, "", 0), (UNITS, "WT boiler", 301), (UNITS, "boiler, fire tube (see note)", 302), (UNITS, "process htr", 303), (UNITS, "emerg. gen", 306),
        (UNITS, "cyclone", 319), (UNITS, "boiler", 0), (UNITS, "roof tank", 0), (UNITS, "(2) watertube boiler #3", 301), ([], "coal", 0),
    ],
)
def test_values(entries, value, want):
    assert C.Matcher(entries).find(value)[0] == want


def test_longest_mention_wins():
    m = C.Matcher([(1, ["coke"]), (2, ["coke oven gas"])])
    assert m.find("hot coke oven gas blend")[0] == 2


def test_distance_against_brute_force():
    def full(a, b):
        d = {}
        for i in range(-1, len(a)):
            for j in range(-1, len(b)):
                if i < 0 or j < 0:
                    d[i, j] = i + j + 2
                    continue
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
                if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    rng = random.Random(2)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in "ab")
        for most in range(4):
            assert C.distance(a, b, most) == min(full(a, b), most + 1)


def frames(spark, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_id long, fuel_type string")
    ref = spark.createDataFrame([(r, "fuel_type", n[0], n[1:] or None) for r, n in FUELS] + [(9, None, "x", None), (10, "fuel_type", None, None)], "ref_id long, field_name string, canonical_value string, known_aliases array<string>")
    return rows, ref


def test_rows(spark):
    rows, ref = frames(spark, "Natural Gas", "natural gas", None, " ", "N/A", "solar", "solar", "z" * 100_000)
    got = sorted((r.id, r.ref_id) for r in C.mapped(rows, ref, "row_id", ["fuel_type"]).collect())
    assert got == [(1, 101), (5, 0), (6, 0), (7, 0)]
    clash = rows.selectExpr("*", "1 as id", "2 as value", "3 as field_name", "4 as m")
    assert C.mapped(clash, ref, "row_id", ["fuel_type"]).count() == 4
    assert C.mapped(rows.limit(0), ref, "row_id", ["fuel_type"]).count() == 0
    assert {r.ref_id for r in C.mapped(rows, ref.limit(0), "row_id", ["fuel_type"]).collect()} == {0}
    with pytest.raises(ValueError):
        C.mapped(rows, ref, "row_id", ["fuel_type"], most_entries=2)


def planted_list(n=300, seed=8):
    rng = random.Random(seed)
    parts = ["ther", "mal", "oxid", "boil", "er", "gen", "dry", "ing", "kiln", "fur", "nace", "tur", "bine", "press", "ure", "flu", "id", "bed", "no", "2"]
    vocabulary = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(120)]
    entries = [(i + 1, [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 5)))]) for i in range(n)]
    values = []
    for _ in range(400):
        w = list(rng.choice(entries)[1][0])
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(w))
            w[k : k + 1] = rng.choice([[], [w[k], w[k]], ["x"], [" "], ["1"]]) if len(w) > 2 else [w[k]]
        values.append("".join(w) + rng.choice(["", "", " old", " zzz unit"]))
    return entries, [*values, "", "#", "t b", "ob", "gd er", "7"]


def test_index_loses_no_word_and_no_name():
    """The index reaches every word of positive likeness, and the bound hides none of the two best names."""
    entries, values = planted_list()
    m = C.Matcher(entries)
    for v in {w for x in values for w in C.words(x)}:
        brute = {v: 1.0} if v in m.weight else {c: s for c in m.weight if (s := C.likeness(v, c)) > 0}
        assert m.near(v) == brute, v
    whole = C.Matcher(entries)
    whole.reached = lambda v, joins: [(9.0, i) for i in range(len(whole.names))]  # every name is scored
    for v in values:
        assert m.find(v)[:2] == whole.find(v)[:2], v


def test_long_words_are_split():
    a, b = "polychlorinatedbiphenyl", "decontaminationchamber"
    m = C.Matcher([(1, [f"{a} {b}"]), (2, ["boiler"])])
    assert len(a + b) > 40 and m.find(f"the {a}{b[:-1]}x")[0] == 1
    assert m.find("q" * 50_000) == (0, "none", 0.0)
