import pytest

from fluelake.llm import addresses as A

SCHEMA = "filename string, facility_address string, facility_city string, facility_zip_code string, facility_state_abbreviation string"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def pairs(d):
    return sorted((r.file_a, r.file_b) for r in A.same_place(d).collect())


@pytest.mark.parametrize(
    ("address", "want"),
    [
        ("784 Orchard Park Rd", ("784", ("orchardpark", "road", None))), ("BRAMBLE CREEK AVENUE, NO. 378", ("378", ("bramblecreek", "avenue", None))), ("Hwy. 93 3552", ("3552", ("statehighway93", None, None))),
        ("Gate # 32, 789 Millrace", ("789", ("millrace", None, None))), ("4235 No. Carding Ridge Street, Suite 7", ("4235", ("cardingridge", "street", "north"))), ("8316 S.W. Lantern St.", ("8316", ("lantern", "street", "southwest"))),
        ("799 c.r. 694", ("799", ("countyroad694", None, None))), ("264 5TH STR W", ("264", ("fifth", "street", "west"))), ("P.O. Box 6788", None), ("various locations statewide", None), (None, None), ("", None), ("N/A", None),
    ],
)
def test_reading(address, want):
    got = A.parsed(address, "Town", "12345", "TX")
    assert (got and (got[0], A.street(A.rewritten(got[1], A.SEED)))) == want


def test_tail_of_address():
    got = A.parsed("789 Millrace Dr., New Town, LA 36508-1234", None, None, None)
    assert (got[2], got[3], got[4]) == ("36508", "newtown", "la")


def test_same_and_different(spark):
    d = rows(
        spark,
        ("a", "5792 Gantry Park Blvd, Suite 4", "St. Ember", "32184", "NC"), ("b", "5792  GANTRY PARK", "SAINT EMBER", "32184-1111", None), ("c", "5792 Gantyr Park Boulevard", None, "32184", "NC"),
        ("d", "5792 Gantry Park Road", "St. Ember", "32184", "NC"), ("e", "5793 Gantry Park Blvd", "St. Ember", "32184", "NC"), ("f", "7080 West Amber Hill Road", "X", "76409", "NC"), ("g", "7080 East Amber Hill Road", "X", "76409", "NC"),
        ("h", "P.O. Box 5792", "St. Ember", "32184", "NC"), ("i", "5792 Gantry Park Blvd", "Elsewhere", "99999", "NC"), ("a", "5792 Gantry Park Blvd, Suite 4", "St. Ember", "32184", "NC"),
    )
    got = pairs(d)
    assert [p for p in got if "d" not in p] == [("a", "b"), ("a", "c"), ("b", "c")]
    assert ("a", "d") not in got


def test_rewrites_are_mined(spark):
    r = []
    for i in range(12):
        r += [(f"a{i}", f"{100 + i} Quarry Ldg Road", "T", f"1{i:04d}", "TX"), (f"b{i}", f"{100 + i} Quarry Landing Rd", "T", f"1{i:04d}", "TX")]
    d = rows(spark, *r)
    places, found = A.mined(A.cut(A.files(d)))
    assert any("ldg" in k + v and "landing" in k + v for k, v in found.items())  # as common as each other: either way
    assert pairs(d) == sorted((f"a{i}", f"b{i}") for i in range(12))


def test_edges(spark):
    d = rows(spark, ("a", "1 A Street", None, None, None), ("b", "1 A Street", None, None, None), (None, "1 A Street", "T", "12345", "TX"), ("c", "2 " + "long " * 2000 + "Street", "T", "12345", "TX"), ("d", None, None, None, None))
    assert pairs(d) == []
    assert A.same_place(d.limit(0)).count() == 0
    clash = rows(spark, ("a", "1 A Street", "T", "12345", "TX"), ("b", "1 A St", "T", "12345", "TX")).selectExpr("*", "1 as file", "2 as r", "3 as number", "4 as words")
    assert pairs(clash) == [("a", "b")]


def test_every_two_runs_of_a_frame_are_paired(spark):
    r = []
    for i in range(12):  # the commonest run of each frame is another street
        r += [(f"{x}{i}", f"{100 + i} {n} Road", "T", f"1{i:04d}", "TX") for x, n in (("a", "Qldg"), ("b", "Quarrylanding"), ("c", "Mill"))]
    r += [(f"d{i}", f"{200 + i} Mill Road", "T", f"2{i:04d}", "TX") for i in range(12)]
    assert A.mined(A.cut(A.files(rows(spark, *r))))[1] == {"qldg": "quarrylanding", "qldg road": "quarrylanding road"}


def test_addresses_without_postal_code_and_long_ones_are_mined(spark):
    far = "behind the old mill yard near the river bend by lower fields"
    r = []
    for i in range(12):
        r += [(f"a{i}", f"{100 + i} Quarry Ldg Road", f"Town {chr(97 + i)}", None, "TX"), (f"b{i}", f"{100 + i} Quarry Landing Rd", f"Town {chr(97 + i)}", None, "TX")]
        r += [(f"c{i}", f"{300 + i} Xbr {far} Road", "T", f"1{i:04d}", "TX"), (f"d{i}", f"{300 + i} Xanderbruck {far} Road", "T", f"1{i:04d}", "TX")]
    found = A.mined(A.cut(A.files(rows(spark, *r))))[1]
    assert found.get("landing") == "ldg" or found.get("ldg") == "landing"
    assert found.get("xbr") == "xanderbruck" or found.get("xanderbruck") == "xbr"


def test_rounds_end_only_when_none_is_new(spark, monkeypatch):
    monkeypatch.setattr(A, "_accepted", lambda _, rules: {f"w{len(rules)}": f"w{len(rules) + 1}"} if len(rules) < 10 else {})
    places = A.cut(A.files(rows(spark, ("a", "1 W0 Road", "T", "12345", "TX"))))
    out, found = A.mined(places)
    assert len(found) == 10 and out.first().words == ["w10", "road"]


def test_abbreviations_of_types_are_mined(spark, monkeypatch):
    monkeypatch.setattr(A, "SEED", {})
    names = ["Lantern", "Quarry", "Orchard", "Millrace", "Gantry", "Carding", "Bramble", "Amber", "Foundry", "Kestrel"]
    r = []
    for i, n in enumerate(names):
        r += [(f"a{i}", f"{100 + i} {n} Rd", "T", f"1{i:04d}", "TX"), (f"b{i}", f"{100 + i} {n} Road", "T", f"1{i:04d}", "TX")]
        r += [(f"c{i}", f"{300 + i} N {n} Road", "T", f"2{i:04d}", "TX"), (f"d{i}", f"{300 + i} North {n} Road", "T", f"2{i:04d}", "TX")]
    places, found = A.mined(A.cut(A.files(rows(spark, *r))))
    assert (found["rd"], found["n"]) == ("road", "north")
    assert pairs(rows(spark, *r)) == sorted([(f"a{i}", f"b{i}") for i in range(10)] + [(f"c{i}", f"d{i}") for i in range(10)])


def test_corrections_need_more_than_chance():
    from types import SimpleNamespace as N

    few = [N(a=a, f_a=1, b=b, f_b=500) for a, b in (("lanterm", "lantern"), ("hall", "hill"))] + [N(a="zzzzzzzz", f_a=1, b=f"word{i}", f_b=500) for i in range(300)]
    assert A._corrections(few, {}) == {"lanterm": "lantern"}
