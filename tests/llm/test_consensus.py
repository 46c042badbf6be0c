import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluelake.llm import consensus as C

SCHEMA = "record_id long, reviewer string, filename string, recorded_at timestamp, field_summary map<string, struct<complete_models:array<string>, agreeing_models:array<string>, chosen_value:string, needs_review:boolean>>"
T0 = datetime.datetime(2024, 1, 1)


def sheet(i, reviewer, file, answers, hour=0):
    return (i, reviewer, file, T0 + datetime.timedelta(hours=hour), {k: ([], [], v, False) for k, v in answers.items()})


def test_normalised(spark):
    v = ["05/30/2012", " Title  V ", "May 3, 2020", "n/a", None, "2013-05-30 ", "5/1/2020"]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, c string")
    assert [r.x for r in d.select("i", C.normalised(F.col("c")).alias("x")).orderBy("i").collect()] == ["2012-05-30", "title v", "2020-05-03", None, None, "2013-05-30", "2020-05-01"]


def test_last_sheet_counts(spark):
    rows = [sheet(1, "a", "f", {"k": "x", "m": "old"}), sheet(2, "a", "f", {"k": "y"}, 2), sheet(3, "a", "f", {"k": "z"}, 1), sheet(4, "b", "f", {"k": " "}), sheet(5, None, "f", {"k": "q"}), sheet(6, "b", None, {"k": "q"})]
    got = C.votes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.annotator, r.field, r.label) for r in got] == [("a", "k", "y")]


def planted(seed=7, items=150):
    rng = random.Random(seed)
    skill = {f"r{i:02d}": s for i, s in enumerate([0.97, 0.95, 0.9, 0.9, 0.85, 0.3, 0.3, 0.25, 0.3, 0.3])}
    truth, rows = {}, []
    for f in range(items):
        for field in ("k", "m"):
            truth[f"f{f:03d}", field] = f"v{rng.randrange(9)}"
        popular = f"v{rng.randrange(9)}"
        for r in rng.sample(sorted(skill), 4):
            ans = {}
            for field in ("k", "m"):
                t = truth[f"f{f:03d}", field]
                ans[field] = t if rng.random() < skill[r] else rng.choice([popular, f"v{rng.randrange(9)}"])
            rows.append(sheet(len(rows), r, f"f{f:03d}", ans))
    return skill, truth, rows


def test_beats_majority_and_finds_the_careless(spark):
    skill, truth, rows = planted()
    found, reviewers = C.run(spark.createDataFrame(rows, SCHEMA))
    found = {(r.item, r.field): r for r in found.collect()}
    assert set(found) == set(truth)
    right = np.mean([found[k].label == v for k, v in truth.items()])
    votes = {}
    for _, r, f, _, s in rows:
        for field, x in s.items():
            votes.setdefault((f, field), []).append(x[2])
    majority = np.mean([max(sorted(set(v)), key=v.count) == truth[k] for k, v in votes.items()])
    assert right > majority + 0.03 and right > 0.85
    rel = {}
    for r in reviewers.collect():
        rel.setdefault(r.annotator, []).append(r.reliability)
    rel = {k: np.mean(v) for k, v in rel.items()}
    assert min(rel[r] for r in skill if skill[r] > 0.8) > max(rel[r] for r in skill if skill[r] < 0.5)
    one = found["f000", "k"]
    assert one.votes == 4 and 0 <= one.agreement <= 1


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found, reviewers = C.run(empty, tolerance=9.0)
    assert found.count() == 0 and reviewers.count() == 0
    rows = [sheet(1, "a", "f", {"k": "x"}), sheet(2, "b", "g", {"k": "b"}), sheet(3, "c", "g", {"k": "a"}), sheet(4, "a", "h", {"k": "N/A"}), sheet(5, "a", "long", {"k": "z" * 50_000})]
    d = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as item", "2 as annotator", "3 as label")
    got = {r.item: r for r in C.run(d, tolerance=9.0)[0].collect()}
    assert set(got) == {"f", "g", "long"} and got["f"].label == "x" and got["f"].agreement is None
    assert got["g"].agreement == 0.0 and got["g"].label in ("a", "b")


def test_joined_sigma_gives_the_same(spark):
    _, _, rows = planted(items=30)
    items = C.cut(C._items(C.votes(spark.createDataFrame(rows, SCHEMA))))
    a = {(r.annotator, r.field): r.sigma for r in C.fitted(items, 0.5).collect()}
    b = {(r.annotator, r.field): r.sigma for r in C.fitted(items, 0.5, most=1).collect()}
    assert a == pytest.approx(b)


def test_ascent_ends_when_nothing_moves(spark):
    _, _, rows = planted(items=40)
    items = C.cut(C._items(C.votes(spark.createDataFrame(rows, SCHEMA))))
    fine = {(r.annotator, r.field): r for r in C.fitted(items, 0.002).collect()}
    assert max(r.change for r in fine.values()) < 0.002
    coarse = {(r.annotator, r.field): r.sigma for r in C.fitted(items).collect()}
    assert coarse == pytest.approx({k: r.sigma for k, r in fine.items()}, abs=0.2)
