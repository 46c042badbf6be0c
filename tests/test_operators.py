"""Edge rows of the core operators, against plain Python."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fluelake.functions import text as T
from fluelake.functions.blank import is_blank
from fluelake.operators import classify, dedup, match, merge, nested, quality, sampling, stats
from fluelake.sources import io


def one(spark, column, *values, kind="string"):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.x for r in d.select("i", column.alias("x")).orderBy("i").collect()]


def test_blank(spark):
    assert one(spark, is_blank(F.col("c")), None, "", " \xa0", "nan", "N/A", "none of it", "0") == [True] * 5 + [False] * 2


def test_zip(spark):
    assert one(spark, T.normalize_zip(F.col("c")), "12345", "123456789", "12345-678", "1234", None, "nan", " ") == ["12345", "12345-6789", "12345", "1234", None, None, None]


def test_dates(spark):
    assert one(spark, T.normalize_date(F.col("c")), "2020-02-30", "3/7/2019", "May 1, 2020", "soon", None, "") == [None, "2019-03-07", "2020-05-01", None, None, None]


def test_hours(spark):
    v = ["8,760 hr/yr", "24 hours/day", "8760.0 hours per year", "hours/yr 5", None, "nan"]
    assert one(spark, T.hours_value(F.col("c")), *v) == ["8760", "24", "8760", "5", None, None]
    assert one(spark, T.hours_basis(F.col("c")), *v) == ["hours/year", None, "hours/year", "hours/yr", None, None]


def test_case(spark):
    assert one(spark, T.city_case(F.col("c")), "O'BRIEN 3M-CO", "Ada", "AJO", "", None) == ["O'Brien 3M-Co", "Ada", "AJO", None, None]
    assert one(spark, T.fold_label(F.col("c")), " Winery . ", "WINERY;,", "", None, "...") == ["winery ", "winery", None, None, None]


def test_unit_key_of_nothing(spark):
    assert one(spark, T.unit_key(F.lit(" "), F.col("c")), "", None) == ["desc_d41d8cd98f00"] * 2


def test_latest_row(spark):
    d = spark.createDataFrame([("a", "2020", 1), ("a", None, 2), ("a", "2021", 3), ("a", "2021", 4), (None, None, 5)], "k string, d string, i int")
    assert sorted(r.i for r in dedup.keep_latest(d, [F.col("k")], F.col("d"), F.col("i")).collect()) == [4, 5]
    assert sorted(r.i for r in dedup.keep_ties(d, [F.col("k")], F.col("d")).collect()) == [3, 4]
    assert sorted(r.i for r in dedup.latest_or_keyless(d, F.col("k"), F.col("i")).collect()) == [4, 5]
    assert dedup.last_by(d.limit(0), [F.col("k")], F.col("i")).count() == 0


def test_additive_merge(spark):
    empty = "Success (No Units Found)"
    s = "f string, s string, u string"
    old = spark.createDataFrame([("a", "Success", "1"), ("b", "Failed", None), ("c", empty, None), ("d", "Failed", None), ("x", "Success", "9")], s)
    new = spark.createDataFrame([("a", "Success", "1"), ("a", "Success", "2"), ("b", "Success", "1"), ("c", "Success", "3"), ("d", empty, None), ("a", empty, None)], s)
    got = sorted((r.f, r.s, r.u or "") for r in merge.additive(old, new, "f", F.col("u"), "s").collect())
    assert got == [("a", "Success", "1"), ("a", "Success", "2"), ("b", "Success", "1"), ("c", "Success", "3"), ("d", empty, ""), ("x", "Success", "9")]


@settings(max_examples=60, deadline=None)
@given(st.text("ab \n", max_size=120), st.integers(6, 30), st.integers(0, 5))
def test_chunks_cover_and_progress(text, most, overlap):
    spans = nested.chunk_spans(text, most, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b and b - c <= overlap and b - a <= most and d > b - overlap


def test_chunk_breaks():
    t = "a" * 85 + "\n\n" + "b" * 5 + " " + "c" * 100
    assert nested.chunk_spans(t, 100, 10)[0] == (0, 85)
    assert nested.chunk_spans("a" * 85 + " " + "c" * 100, 100, 10)[0] == (0, 85)
    assert nested.chunk_spans("a" * 250, 100, 10)[0] == (0, 100)


def test_halving(spark):
    d = spark.createDataFrame([("x" * 100,), ("y" * 10,)], "text string")
    got = nested.halved_until(d, F.length("text") < 30, least=5).collect()
    assert sorted(len(r.text) for r in got) == [10, 25, 25, 25, 25]


def test_parse_flatten(spark):
    form = nested.schema(["name"], ["id"])
    replies = ['```json\n{"name": "a", "emission_units": [{"id": "1"}, {"id": "2"}]}\n```', '{"name": "b"}', "no json", None]
    d = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string").select("i", nested.parsed(F.col("r"), form).alias("doc"))
    assert sorted((r.i, r.name or "", r.id or "") for r in nested.flattened(d, "doc", ["name"]).collect()) == [(0, "a", "1"), (0, "a", "2"), (1, "b", ""), (2, "", ""), (3, "", "")]
    assert nested.field_names(["Control Device(s)", "a  b"]) == {"Control Device(s)": "Control_Device_s", "a  b": "a_b"}
    with pytest.raises(ValueError):
        nested.field_names(["a b", "a_b"])


def test_fuzzy_against_all_pairs(spark):
    rng = random.Random(4)
    names = ["NORTH HOLLINDALE", "EAST TAMBERMERE", "KETTLEMERE", "SAINT OTTERPORT MILLS", "OTTERPORT", "AB CD"]

    def typed(n):
        i = rng.randrange(len(n))
        return rng.choice([n, n[:i] + n[i + 1 :], n[:i] + "X" + n[i:], " ".join(reversed(n.split()))]).strip()

    left = [(rng.choice("ab"), typed(rng.choice(names))) for _ in range(80)] + [("a", ""), (None, "KETTLEMERE")]
    right = [(b, n) for b in "ab" for n in names[:5]]
    got = {(r.block, r.name): (r.matched, round(r.score, 6)) for r in match.blocked_fuzzy(spark.createDataFrame(left, "b string, n string"), spark.createDataFrame(right, "b string, n string"), "b", "n", 88).collect()}
    want = {}
    for b, n in set(left):
        if not n or b is None:
            continue
        pool = [m for c, m in right if c == b]
        if n in pool:
            want[b, n] = (n, 100.0)
        elif len(n) >= 6:
            s = sorted((-match.token_set_ratio(n, m), m) for m in pool)
            if -s[0][0] >= 88:
                want[b, n] = (s[0][1], round(-s[0][0], 6))
    assert got == want


def test_ranked_places(spark):
    d = spark.range(500).select(((F.col("id") * 37) % 101).alias("v"), "id")
    got = [(r.v, r.id) for r in sampling.ranked(d, [F.col("v"), F.col("id")], "p").orderBy("p").collect()]
    assert got == sorted(got) and len(got) == 500


def test_quota_repair():
    assert sampling.repaired({"a": 5, "b": 3, "c": 1}, {"a": 50, "b": 30, "c": 1}, 7) == {"a": 3, "b": 3, "c": 1}
    assert sampling.repaired({"a": 1, "b": 1}, {"a": 9, "b": 2}, 5) == {"a": 4, "b": 1}
    assert sampling.repaired({"a": 1, "b": 1}, {"a": 1, "b": 2}, 9) == {"a": 1, "b": 2}


def test_columns(spark):
    from fluelake.functions import columns as N

    d = spark.createDataFrame([("x", "y", 1)], "state string, make string, i int")
    assert N.aligned(N.renamed(d), ["unit_make", "nothing"]).columns == ["unit_make", "nothing", "facility_state_abbreviation", "i"]
    with pytest.raises(ValueError):
        N.inserted_after(d, "make", {"i": F.lit(1)})


def test_spearman_is_exact(spark):
    rng = random.Random(1)
    x, y = [rng.randrange(9) for _ in range(60)], [rng.randrange(9) for _ in range(60)]
    import pandas as pd

    r = stats.spearman(spark.createDataFrame(list(zip(x, y)), "x int, y int"), "x", "y").first()
    assert r.rho == pytest.approx(pd.Series(x).rank().corr(pd.Series(y).rank()))


def test_polygon(spark):
    d = spark.createDataFrame([(0.5, 0.5), (2.0, 2.0), (1.5, 0.2)], "x double, y double")
    assert [r.i for r in d.select(match.inside_polygon(F.col("x"), F.col("y"), [(0, 0), (1, 0), (1, 1), (0, 1)]).alias("i")).collect()] == [True, False, False]


def test_rules_and_classes(spark):
    assert one(spark, classify.rule_code(F.col("c")), "Portland cement plant, associated limestone quarry", "Crushed stone quarrying", "unheard of", None) == ["327310", "212312", None, None]
    assert one(spark, classify.is_manufacturing(F.col("c")), "2911", "4911", "311221", "221112.0", None, "") == [True, False, True, False, False, False]
    assert one(spark, classify.first_valid_code(F.col("c")), "9999; 324110", "000000", None) == ["324110", None, None]
    assert one(spark, quality.match_type(F.col("c"), F.lit("a b c d e")), "A b c d e ", "a b c d e f", "x", None) == ["exact", "partial", "different", "missing"]


def test_links(spark):
    cell = one(spark, io.named_links(F.col("c")), "Permit A (https://x.org/a.pdf), B (http://y.org/b)", "none")
    assert [[(x.name, x.url) for x in c] for c in cell] == [[("Permit A", "https://x.org/a.pdf"), ("B", "http://y.org/b")], []]
    assert one(spark, io.safe_member(F.col("c")), "a/b.pdf", "../b.pdf", "/b.PDF", "a/b.txt") == [True, False, False, False]
    assert one(spark, io.state_of(F.col("c")), "/data/TX/x.txt", "/data/or_123.txt", "/data/zz.txt") == ["TX", "OR", "unknown"]
    assert one(spark, io.links(F.col("c")), '<a href="u.pdf">x</a><A HREF=\'v\'>') == [["u.pdf", "v"]]


def test_csv_policies(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('x,y\n,nan\n"a\nb",caf\xe9\n'.encode("latin-1"))
    p = str(tmp_path / "a.csv")
    assert [tuple(r) for r in io.read_csv(spark, p, "words", "ISO-8859-1").collect()] == [(None, None), ("a\nb", "café")]
    assert [tuple(r) for r in io.read_csv(spark, p, "none", "ISO-8859-1").collect()][0] == ("", "nan")
    assert io.read_csv_any(spark, p).collect()[1].y == "café"


def test_stream_resumes(spark, tmp_path):
    from fluelake.streaming import log as L

    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        s = spark.readStream.schema("filename string, n int").parquet(src)
        done = spark.createDataFrame([("done",)], "file string")
        L.pending(s, done).writeStream.option("checkpointLocation", ck).trigger(availableNow=True).format("parquet").start(out).awaitTermination()

    spark.createDataFrame([("a.pdf", 1), ("DONE.pdf", 2)], "filename string, n int").write.parquet(src)
    run()
    spark.createDataFrame([("b", 3)], "filename string, n int").write.mode("append").parquet(src)
    run()
    run()
    assert sorted(r.file for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_llm_is_imported_by_nothing_else():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "fluelake"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "fluelake.llm" in p.read_text()]


def test_halving_goes_on_until_all_fit(spark):
    d = spark.createDataFrame([("x" * 6400,), ("y" * 10,)], "text string")
    got = nested.halved_until(d, F.length("text") <= 100, least=50).collect()
    assert sorted(len(r.text) for r in got) == [10] + [100] * 64 and max(r.halvings for r in got) == 6


def test_error_classes_of_messages(spark):
    cases = {
        "Prompt exceeds the context window": "token_limit", "max_tokens must be at least 1": "token_limit", "finish_reason=length": "token_limit", "max_tokens: got -5": "token_limit", "token beyond context": "token_limit",
        "HTTP 502": "retryable", "internal server error": "retryable", "request timed out": "retryable", "timeout": "other", "temporarily away": "other", "invalid JSON": "parse", None: None,
    }
    d = spark.createDataFrame([(m,) for m in cases], "m string").select("m", classify.error_class(F.col("m")).alias("k"))
    assert {r.m: r.k for r in d.collect()} == cases


def test_backfill_takes_the_first_stated(spark):
    old = spark.createDataFrame([(1, "f", " "), (2, "f", "zeta"), (3, "f", "alpha"), (4, "h", "x")], "i long, f string, m string")
    new = spark.createDataFrame([(5, "f", "NaN"), (6, "f", "own"), (7, "g", None)], "i long, f string, m string")
    got = merge.select_source(new, old, "f", "run", ("new", "old"), {"m": "unknown"}, "i").collect()
    assert sorted((r.i, r.m, r.run) for r in got) == [(4, "x", "old"), (5, "zeta", "new"), (6, "own", "new"), (7, "unknown", "new")]


def test_values_are_sought_in_all_texts(spark):
    values = spark.createDataFrame([("f", f"Name {i}") for i in range(1200)] + [("g", "Name 1"), ("f", None), (None, "x")], "k string, v string")
    texts = spark.createDataFrame([("f", f"here NAME {i}.") for i in (3, 700, 700, 1199)] + [("g", "nothing"), ("f", None), ("h", "Name 1")], "k string, t string")
    got = {(r.k, r.v) for r in quality.stated_in(values, texts, "k", "v", "t").collect()}
    assert got == {("f", f"name {i}") for i in (3, 7, 70, 700, 1, 11, 119, 1199)}


def test_decisions_with_reasons(spark):
    form = "i int, s map<string, struct<needs_review:boolean>>, ratio double, ok int, failed int"
    rows = [(1, {}, 0.9, 1, 0), (2, {}, 0.9, 2, 2), (3, {"Permit Type": (True,), "Facility Name": (True,)}, 0.1, 3, 1), (4, {"Other": (True,)}, 0.555, 3, 0), (5, None, None, 3, 0)]
    d = spark.createDataFrame(rows, form)
    got = {r.i: (r.a, r.b) for r in d.select("i", *[c.alias(n) for c, n in zip(quality.validation_decision(F.col("s"), F.col("ratio"), F.col("ok"), F.col("failed")), "ab")]).collect()}
    review = "REVIEW_REQUIRED"
    assert got == {1: (review, "Fewer than two models succeeded"), 2: (review, "Two or more models failed"), 3: (review, "General field 'Facility Name' needs review"), 4: (review, "Unit field agreement ratio 0.56 < 0.7"), 5: ("SUCCESS", None)}


def test_outside_codes(spark):
    prior = spark.createDataFrame([(1, "a", "31-1221"), (2, "b", "12"), (3, "c", "327310")], "o long, f string, c string")
    new = spark.createDataFrame([(1, "a", ""), (2, "b", None), (3, "c", "327320"), (4, "c", "x"), (5, "d", "5"), (6, None, "111111")], "o long, f string, c string")
    got = {(r.f, r.c, r.origin) for r in classify.merge_codes(prior, new, "f", "c", "o").collect()}
    assert got == {("a", "311221", "prior"), ("b", "", "new"), ("c", "327320", "new"), ("d", "", "new")}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from fluelake import runtime

    none = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False, isEmpty=lambda: True))
    far = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://x", _jsc=SimpleNamespace(sc=lambda: none)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=far.sparkContext))
