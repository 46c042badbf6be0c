from fluelake.llm import truncation as U

BODY = ["The owner shall inspect the {} at least once per shift and record the results.", "Emissions of {} from the kiln shall not exceed 40 pounds per hour on a daily average.", "Records of {} must be kept on site and made available to inspectors upon request."]
THINGS = ["scrubber", "baghouse", "cyclone", "ammonia", "fuel use", "coating usage", "dust", "lime"]


def corpus():
    out = []
    for i, a in enumerate(THINGS):
        for j, b in enumerate(THINGS):
            out.append(" ".join([BODY[0].format(a), BODY[1].format(b), BODY[2].format(a)]) + ("\nPermit Section Manager" if (i + j) % 2 else f"\n- {b} for each month"))
    return out


def run(spark, texts):
    d = spark.createDataFrame([(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    return d, {r.id: r for r in U.judged(d, "doc_id", "text", "source").collect()}


def test_cuts_and_complete_endings(spark):
    texts = corpus()
    n = len(texts)
    cuts = [texts[0][:100], texts[3][:130], texts[5][:61], texts[9][:70] + "…", texts[11][:75] + " [...]", BODY[2].format("steam") + " Emissions of dust from the kiln sha"]
    d, got = run(spark, texts + cuts + [None, "", " \xa0\n", texts[0], BODY[0].format("scrubber")])
    assert [i for i in range(n) if got[i].cut] == []
    assert [got[n + k].cut for k in range(len(cuts))] == [True] * len(cuts)
    assert [got[n + len(cuts) + k].cut for k in range(5)] == [False] * 5
    s = {r.source: r for r in U.shares(U.judged(d, "doc_id", "text", "source")).collect()}
    assert sum(r["cut"] for r in s.values()) == len(cuts) and None in s and sum(r.documents for r in s.values()) == len(got)


def test_prefixes_against_all_pairs(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    base = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    long = "".join(rng.choice("abc") for _ in range(3000))
    base += [long[: rng.randrange(1, 3000)] + rng.choice(["", "x"]) for _ in range(60)]
    t = spark.createDataFrame([(x,) for x in sorted(set(base))], "plain string").withColumn("h", F.unhex(F.sha2("plain", 256)))
    want = {a: min(b for b in base if b != a and b.startswith(a))[len(a) : len(a) + 8] for a in set(base) if any(b != a and b.startswith(a) for b in base)}
    for most in (10_000, 1):  # small tables sent, and all joined by shuffle
        got = U._longer(t, most).join(t, "h").collect()
        assert {r.plain: r.after for r in got} == want and len(got) == len(want)


def test_edges(spark):
    d, _ = run(spark, ["x"])
    assert U.judged(d.limit(0), "doc_id", "text", "source").count() == 0
    clash = d.selectExpr("*", "1 as id", "2 as h", "3 as plain", "4 as ends", "5 as w")
    assert U.judged(clash, "doc_id", "text", "source").count() == 1
    _, got = run(spark, ["word " * 60_000 + "end.", "word " * 60_000 + "end."])
    assert len(got) == 2


def test_segment_prefixes_against_brute_force(spark):
    import random

    rng = random.Random(5)
    seg = {"".join(rng.choice("ab é") for _ in range(rng.randrange(1, 9))).strip() or "a": rng.randrange(1, 9) for _ in range(200)}
    d = spark.createDataFrame(list(seg.items()), "segment string, c long")
    got = {r.segment: (r.equal, r.begun) for r in U._prefixes(d, d.where("c < 6").unionByName(d.limit(0))).collect()}
    assert got == {s: (c, sum(n for x, n in seg.items() if x.startswith(s))) for s, c in seg.items() if c < 6}


def test_marks_before_any_space_and_long_fragments(spark):
    word = "di" + "methyl" * 10 + "amine"
    whole = [f"The unit number {i} uses {word} as its only solvent here." for i in range(14)]
    cuts = ["Owner keeps records [truncated]" + "\n" * 61, "Owner keeps records…\xa0" + " \t" * 90, "This record says it uses " + word[:50]]
    _, got = run(spark, corpus() + whole + cuts)
    n = len(corpus()) + len(whole)
    assert [(got[n + k].marked, got[n + k].cut) for k in range(3)] == [(True, True), (True, True), (False, True)]


def test_planted_copies_only_the_prefixes_find(spark):
    """Cuts after a word that usually ends a segment: counts of endings say nothing, the longer copy does."""
    import random

    rng = random.Random(6)
    name = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 6)))
    whole = [" ".join([*(name() for _ in range(rng.randrange(8, 20))), "Manager", *(name() for _ in range(12))]) + "." for _ in range(40)]
    cuts = [w[: w.index("Manager") + 7] for w in whole[:30]]
    _, got = run(spark, corpus() + whole + cuts)
    n = len(corpus())
    planted = [got[n + len(whole) + k] for k in range(len(cuts))]
    only = [r for r in planted if r.cut and not r.goes_on and not r.marked]
    assert len(only) >= 0.9 * len(cuts) and all(r.inside and r.prefix for r in only)
    assert not any(got[n + k].cut for k in range(len(whole)))
