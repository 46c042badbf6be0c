import random

from pyspark.sql import functions as F

from fluelake.llm import survivors as S

COLUMNS = ["row_id", "filename", "status", "processing_date", "model_used", "pieces_failed", *S.UNIT_FIELDS]


def rows(spark, *dicts):
    data = [tuple({"row_id": i, "filename": "f", "status": "Success", **d}.get(c) for c in COLUMNS) for i, d in enumerate(dicts, 1)]
    return spark.createDataFrame(data, ", ".join(f"{c} {'long' if c == 'row_id' else 'string'}" for c in COLUMNS))


def key(spark, *ids):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, c string")
    return [r.k for r in d.select("i", S.unit_key(F.col("c")).alias("k")).orderBy("i").collect()]


def test_spellings_of_ids(spark):
    assert key(spark, "P-013", "p 0013", "PO13", "# P.013", "Emission Unit P_13", "P013A", "P-13B", None, " ", "N/A") == ["P13"] * 5 + ["P13A", "P13B", None, None, None]


def test_survivor_and_fill(spark):
    d = rows(
        spark,
        {"unit_id": "P-01", "unit_description": "Steam boiler #1, yard", "unit_make": "A", "processing_date": "2020-01-01"},
        {"unit_id": "p01", "unit_description": "Steam boiler #1, yard", "unit_make": "n/a", "processing_date": "2021-01-01", "fuel_type": "Coal", "unit_type": "Boiler"},
        {"unit_id": None, "unit_description": "Coal-fired steam boilr No. 1 (yard), vent 3", "processing_date": None},
        {"unit_id": "P-02", "unit_description": "Kiln"},
        {"unit_id": "ERROR", "unit_description": "ERROR", "status": "Processing Error"},
        {"unit_id": None, "unit_description": None},
    )
    assert [(r.unit, r.row_id, r.rows) for r in S.survivors(d).collect()] == [("id:P1", 2, 3)]
    got = {r.unit: r for r in S.records(d).collect()}
    assert (got["id:P1"].unit_make, got["id:P1"].fuel_type, got["id:P1"].rows) == ("A", "Coal", 3)
    assert set(got) == {"id:P1", "id:P2"}


def test_ties_repeats_empty_and_clashes(spark):
    same = {"unit_id": "X1", "processing_date": "2020-01-01", "fuel_type": "y" * 100_000}
    d = rows(spark, same, same, same)
    assert [r.row_id for r in S.survivors(d).collect()] == [1]
    clash = d.selectExpr("*", "1 as unit", "2 as __c", "3 as rows", "4 as __id")
    assert [r.row_id for r in S.survivors(clash).collect()] == [1] and S.records(clash).count() == 1
    assert S.survivors(d.limit(0)).count() == 0 and S.records(d.limit(0)).count() == 0


def test_against_brute_force(spark):
    rng = random.Random(5)
    data = [{"unit_id": f"U-{rng.randrange(12)}", "model_used": rng.choice([None, "small", "Large 2"]), "pieces_failed": rng.choice([None, "0", "3"]), "processing_date": rng.choice([None, "2020-01-01", "2020-01-02"]), **{f: rng.choice([None, "v", "N/A"]) for f in S.UNIT_FIELDS[2:8]}} for _ in range(200)]
    got = {r.unit: r.row_id for r in S.survivors(rows(spark, *data)).collect()}
    groups = {}
    for i, d in enumerate(data, 1):
        filled = sum(d.get(f) == "v" for f in S.UNIT_FIELDS) + 1
        groups.setdefault("id:" + d["unit_id"].replace("-", ""), []).append((-filled, [-ord(c) for c in d["processing_date"] or "\0"], i))
    want = {}
    for k, v in groups.items():
        if len(v) > 1:
            best = min(v, key=lambda x: (x[0], [-y for y in [0]], x[1], x[2]))
            want[k] = best[2]
    assert got == want


def test_trust_breaks_no_tie(spark):
    same = {"unit_id": "X1", "processing_date": "2020-01-01"}
    d = rows(spark, {"unit_id": "Y"}, same | {"model_used": "small"}, same | {"model_used": "large"}, {"unit_id": "X1", "processing_date": "2019-01-01", "model_used": "large", "pieces_failed": "0"})
    assert [(r.row_id, r.rows) for r in S.survivors(d).collect()] == [(2, 3)]


def test_names_meet_through_pieces(spark):
    """Every pair within the edits forgiven has a common piece; by brute force over all pairs."""
    rng = random.Random(9)
    names = ["".join(rng.choice("ab ") for _ in range(rng.randrange(0, 14))) for _ in range(60)] + ["auxiliary steam boiler of the north", "auxilliary steem boiler of the nroth", "steam boilers"]
    d = spark.createDataFrame([(x,) for x in sorted(set(names))], "x string")
    off = F.levenshtein("x", "y")
    pairs = d.crossJoin(d.withColumnRenamed("x", "y"))  # a small fixture, by brute force
    want = {(r.x, r.y) for r in pairs.where((off <= S._edits(F.col("x"))) & (F.length("x") >= S.SHORT_NAME)).collect()}
    met = d.select("x", F.explode(S._pieces(F.col("x"))).alias("k")).join(d.select(F.col("x").alias("y"), F.explode(S._grams(F.col("x"))).alias("k")), "k").select("x", "y").distinct()
    got = {(r.x, r.y) for r in met.where(off <= S._edits(F.col("x"))).collect()}
    assert got == want and len(want) > 60
