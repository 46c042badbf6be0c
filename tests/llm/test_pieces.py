import random
import re

import numpy as np

from fluelake.llm import pieces as P


def blocks(text, pattern):
    return [b.strip(" \t\n") for b in re.split(pattern, text)]


def kind(text, limit):
    """The statement of the problem, by splitting."""
    page = r"(?m)^[ \t]*--- Page Break ---[ \t]*$|\f"
    for name, p in (("page", page), ("paragraph", page + r"|(?:\n|\A)[ \t]*(?=\n)"), ("line", page + r"|\n"), ("word", page + r"|[ \t\n]")):
        if max(map(len, blocks(text, p))) <= limit:
            return name
    return "none"


def texts(n=250):
    rng = random.Random(9)
    for _ in range(n):
        out = []
        for _ in range(rng.randrange(1, 60)):
            out.append(rng.choice(["a" * rng.randrange(1, 40), "\n", "\n\n", "\n \n", " ", "\t", "\n--- Page Break ---\n", "\f", "word and word"]))
        yield "".join(out)


def test_kind_against_splitting():
    for t in texts():
        for limit in (8, 20, 60):
            assert P.coarsest(t, limit, 3)[0] == kind(t, limit), (t, limit)


def test_pieces_are_whole_and_small():
    for t in texts():
        for limit, overlap in ((20, 5), (60, 15)):
            _, got = P.pieces(t, limit, overlap)
            b = [tuple(x) for x in P.coarsest(t, limit, overlap)[1]]
            assert [g[1] for g in got] == [s for s, _ in b if s in {g[1] for g in got}]
            covered = []
            for k, (s, fresh, e) in enumerate(got):
                assert e - s <= limit and s <= fresh < e
                if k:
                    assert s <= got[k - 1][2] or s == fresh
                    assert got[k - 1][2] - s <= overlap
                    # greedy: the next block would not have fitted
                    assert e == len(t) or got[k - 1][2] < e
                covered += [x for x in b if fresh <= x[0] and x[1] <= e]
            assert covered == b, t  # every block in exactly one fresh part
            for (s, f, e), (s2, f2, e2) in zip(got, got[1:]):
                nxt = next(x for x in b if x[0] == f2)
                assert nxt[1] - s > limit  # maximal


def test_squaring_equals_stepping():
    rng = random.Random(4)
    for n in [1, 2, 3, *(rng.randrange(1, 400) for _ in range(200))]:
        successor = np.array([rng.randrange(i + 1, min(n, i + 1 + rng.choice([1, 3, 50])) + 1) for i in range(n)])
        want, at = [], 0
        while at < n:
            want.append(at)
            at = successor[at]
        assert P.chain(successor).tolist() == want
    t = " ".join("w" * (1 + i % 7) for i in range(3000))
    _, got = P.pieces(t, 100, 20)
    assert len(got) > 100 and all(e - s <= 100 for s, _, e in got)


def test_rows(spark):
    d = spark.createDataFrame([(1, "x" * 20000), (2, None), (3, ""), (4, " " * 9000), (5, "short"), (6, "a b " * 4000), (6, "a b " * 4000)], "text_id long, source string")
    got = P.split(d.selectExpr("*", "0 as id", "'q' as piece"), "text_id", "source").collect()
    assert {r.id for r in got} == {1, 4, 6}
    assert [(r.piece_no, r.piece) for r in got if r.id == 4] == [(0, "")]
    assert len([r for r in got if r.id == 6 and r.piece_no == 1]) == 2
    assert P.split(d.limit(0), "text_id", "source").count() == 0
    kinds = P.boundaries(d.selectExpr("*", "0 as id", "'q' as pieces"), "text_id", "source").collect()
    assert sorted((r.id, r.boundary, r.pieces) for r in kinds) == sorted((i, next(r.boundary for r in got if r.id == i), max(r.piece_no for r in got if r.id == i)) for i in (1, 4, 6, 6))
    assert P.boundaries(d.limit(0), "text_id", "source").count() == 0
