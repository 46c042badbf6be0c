import random

import pytest

from fluelake.llm import tokens as T


@pytest.fixture(scope="module")
def ranks():
    with open(f"{T.TOKENIZERS}/{T.VOCABULARY}", "rb") as f:
        return T.read_ranks(f.read())


TEXTS = ["", "don't 'S 12345 ½", "  \n\n  x\r\n", "日本語テキスト😀", "_" * 3000 + "<|endoftext|>", "a" * 2000, "ab" * 500, "  tab\t\t", "Émissions à 5 µg/m³"]


def test_against_library(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    lib = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
    e = T.Encoder(ranks)
    rng = random.Random(1)
    more = ["".join(rng.choice("aeirtsnl  \n.,09éß漢") for _ in range(rng.randrange(400))) for _ in range(200)]
    for t in TEXTS + more:
        assert e.encode(t) == lib.encode_ordinary(t)


def test_both_merges_agree(ranks):
    rng = random.Random(2)
    for _ in range(300):
        w = bytes(rng.choice(b"aeirtsnlq_ \xc3\xa9") for _ in range(rng.randrange(1, 260)))
        assert T.merge_short(w, ranks) == T.merge_long(w, ranks)


def test_round_trip(ranks):
    back = {v: k for k, v in ranks.items()}
    e = T.Encoder(ranks)
    for t in TEXTS:
        assert b"".join(back[i] for i in e.encode(t)).decode() == t


def test_rows(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "water"), (3, "water"), (4, "x" * 50_000)], "doc_id long, text string")
    got = T.encoded(d.selectExpr("*", "1 as t", "2 as count")).collect()
    assert [r.ids for r in got if r.doc_id < 3] == [[], []]
    assert [r.ids for r in got if r.doc_id == 3][0] == [r.ids for r in got if r.doc_id == 3][1]
    assert T.encoded(d.limit(0)).count() == 0
