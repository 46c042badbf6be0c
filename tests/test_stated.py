"""Values sought in the texts of their key: against brute force, and a hot key in about the time of reading it."""

import random
import time

import pytest

from fluelake.operators.quality import found_in, stated_in


def both(spark, values, texts):
    return spark.createDataFrame(values, "k string, v string"), spark.createDataFrame(texts, "k string, t string")


@pytest.mark.parametrize("limits", [{}, {"block": 7, "most_bytes": 50}])
def test_stated_in_equals_brute_force(spark, limits):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("aBé0.") for _ in range(n))
    values = [(k, word(rng.randint(0, 5))) for k in "xyz" for _ in range(300)] + [("x", None), (None, "a"), ("w", "a"), ("z", "ß€"), ("z", " ")]
    texts = [(k, word(n)) for k in "xy" for n in (0, 1, 40, 60, 60)] * 2 + [("z", "Aß€ "), ("z", None), (None, "a"), ("v", "a")]
    v, t = both(spark, values, texts)
    want = {(k, x.lower()) for k, x in values if k and x is not None for m, y in texts if m == k and y is not None and x.lower() in y.lower()}
    got = [(r.k, r.v) for r in stated_in(v, t, "k", "v", "t", **limits).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


def test_automaton_finds_what_a_search_finds():
    values, texts = [b"", b"a", b"ab", b"bab", b"\xc3\xa9", b"c", b"abc"], [b"xbabx", b"\xc3\xa9"]
    want = [b"", b"a", b"ab", b"bab", b"\xc3\xa9"]
    assert found_in(values, texts) == found_in(values, texts, few=0) == want
    assert found_in(values, [], few=0) == found_in(values, []) == []


def test_hot_key_does_not_cost_values_times_texts(spark):
    rng = random.Random(6)
    values = [("hot", f"{i}-{i * 7}") for i in range(10_000)]
    texts = [("hot", " ".join(str(rng.randrange(10**6)) for _ in range(700)) + f" {i}-{i * 7} ") for i in range(400)]
    v, t = both(spark, values, texts)
    stated_in(*both(spark, values[:1], texts[:1]), "k", "v", "t").count()  # the workers start
    began = time.time()
    got = {r.v for r in stated_in(v, t, "k", "v", "t").collect()}
    took = time.time() - began
    assert got == {f"{i}-{i * 7}" for i in range(400)}
    assert took < 15  # 28 billion comparisons if each value is sought in each text
