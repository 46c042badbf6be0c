import numpy as np
import pytest

from fluelake.llm import mixing as M

DOC = "doc_id long, text string, source string, lang string, section string"


def frames(spark, docs, targets):
    return spark.createDataFrame(docs, DOC), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_raking_holds_margins():
    rng = np.random.default_rng(1)
    t = rng.integers(1, 100, 24).astype(float)
    a, b = np.repeat(np.arange(4), 6), np.tile(np.arange(6), 4)
    m1 = np.array([0.1, 0.2, 0.3, 0.4]) * t.sum()
    m2 = np.bincount(b, t)
    w = M.raked(t, [a, b], [m1, m2], np.full(24, 50.0))
    assert np.allclose(np.bincount(a, w * t), m1) and np.allclose(np.bincount(b, w * t), m2, rtol=1e-3)
    w = M.raked(t, [a, b], [m1, m2], np.full(24, 1.0))
    assert (w <= 1 + 1e-12).all()


def test_shares_caps_and_determinism(spark):
    docs = [(i, "water " * (5 + i % 30), s, "en" if i % 3 else "es", f"t{i % 4}") for i, s in enumerate(["big"] * 900 + ["mid"] * 200 + ["small"] * 20 + ["other"] * 50)]
    docs += [(5000, None, "big", "en", "t0"), (5001, "", "big", "en", "t0"), (5002, "x", None, "en", "t0"), (5003, "x", "big", None, None)]
    targets = [("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 5), ("absent", 0.05, 2), ("zero", 0.0, 3)]
    d, t = frames(spark, docs, targets)
    chosen, report = M.mix(d, t)
    rows = chosen.collect()
    r = {x.source: x for x in report.collect()}
    assert set(r) == {x[0] for x in targets} and r["absent"].actual_share == 0
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert r[s].actual_share == pytest.approx(share / 0.95, abs=0.02)
        assert max(x.repeats for x in rows if x.source == s) <= r[s].max_repeats
    assert not {x.id for x in rows} & {5000, 5001, 5002} and {x.source for x in rows} == {"big", "mid", "small"}
    again = M.mix(d.repartition(7), t)[0].collect()
    assert sorted((x.id, x.repeats) for x in rows) == sorted((x.id, x.repeats) for x in again)


def test_edges(spark):
    d, t = frames(spark, [(1, "a b c", "s", None, None), (1, "a b c", "s", None, None)], [("s", 1.0, 2)])
    assert sorted(x.repeats for x in M.mix(d, t)[0].collect()) == [2, 2]
    assert M.mix(d.limit(0), t)[0].count() == 0 and M.mix(d.limit(0), t)[1].first().actual_share == 0
    assert M.mix(d, t.limit(0))[0].count() == 0
    assert M.mix(d.selectExpr("*", "1 as id", "2 as weight", "3 as bin", "4 as tokens"), t)[0].count() == 2
    one, t1 = frames(spark, [(1, "x " * 30_000, "s", "en", "t")], [("s", 1.0, 1)])
    assert M.mix(one, t1)[0].count() == 1


def test_many_cells_are_raked_alike(spark):
    """As grouped sums over the cluster the cells get the weights that one array gives, topics included."""
    docs = [(i, "water " * (1 + i % 9), f"s{i % 4}" if i % 11 else "s0", ["en", "es", None][i % 3], f"t{i // 3 % 3}" if i % 5 else None) for i in range(400)]
    d, t = frames(spark, docs, [("s0", 0.5, 1), ("s1", 0.2, 3), ("s2", 0.2, 2), ("s3", 0.1, 1)])
    key = lambda r: (r.source, r.lang or "", r.topic or "")
    sized = M.cut(M.sized(d, t))
    one = {key(r): r.weight for r in M.weights(sized, t, rounds=3)[0].collect()}
    many = {key(r): r.weight for r in M.weights(sized, t, most=3, rounds=3)[0].collect()}
    assert len(one) > 30 and many == pytest.approx(one, abs=1e-6)
