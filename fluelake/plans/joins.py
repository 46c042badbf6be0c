"""Queries of joins, set operations and merges of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluelake.functions import columns as N
from fluelake.functions import text as T
from fluelake.operators import dedup, match, merge
from fluelake.plans import sqltools as S
from fluelake.runtime import table

P, LOG, MAN = "permit_data_extracted", "processing_log", "text_manifest"
POLYGON = [(0.0, 0.0), (6000.0, 200.0), (9000.0, 900.0), (4000.0, 1400.0), (2000.0, 700.0)]
GENERAL = ["facility_name", "owner_operator_name", "facility_address", "facility_city", "facility_state_abbreviation", "facility_zip_code", "naics_code", "permit_number"]
UNIT = ["unit_make", "unit_model", "unit_type", "fuel_type", "capacity_value", "capacity_unit"]


def _runs(spark, sf_dir, *runs):
    d = table(spark, sf_dir, P)
    return [d.where(F.col("source_run") == r) for r in runs]


def left_centroids(spark, sf_dir):
    """Documents with the median length of their source and language."""
    d = table(spark, sf_dir, "documents")
    mid = d.where("n_chars > 0").groupBy("source", "lang").agg(F.median("n_chars").alias("middle"))
    return d.select("doc_id", "source", "lang").join(mid, ["source", "lang"], "left").select("doc_id", "middle")


def fill_zero_join(spark, sf_dir):
    """Every state of the permits with its failed log entries, 0 for none."""
    s = table(spark, sf_dir, P).where("facility_state_abbreviation is not null").select(F.lower("facility_state_abbreviation").alias("state")).distinct()
    n = table(spark, sf_dir, LOG).where("status = 'failed'").groupBy(F.lower(F.substring(F.trim("filename"), 1, 2)).alias("s")).agg(F.count("*").alias("failed"))
    return s.join(n, s.state == n.s, "left").select("state", F.coalesce("failed", F.lit(0)).alias("failed"))


def fanout_join(spark, sf_dir):
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return n.join(s, n.n_nationkey == s.s_nationkey, "left").select("n_name", "s_suppkey")


def semi_registry(spark, sf_dir):
    files = table(spark, sf_dir, P).select(F.col("filename").alias("file")).distinct()
    return table(spark, sf_dir, MAN).withColumn("file", T.file_key(F.col("filename"))).join(files, "file", "left_semi").select("file", "status", "pages")


def anti_pending(spark, sf_dir):
    """Files with text that no log entry reports as done."""
    done = table(spark, sf_dir, LOG).where("status = 'success'").select(T.file_key(F.col("filename")).alias("file")).distinct()
    return table(spark, sf_dir, MAN).where("status = 'ok'").select(T.file_key(F.col("filename")).alias("file")).distinct().join(done, "file", "left_anti")


def lookup_first(spark, sf_dir):
    """The first resolved industry code of each file, looked up for the text manifest."""
    d = table(spark, sf_dir, P).where("naics_resolved is not null")
    codes = d.groupBy("filename").agg(F.min_by("naics_resolved", "row_id").alias("code"), F.min_by("naics_source", "row_id").alias("origin"))
    m = table(spark, sf_dir, MAN).select(T.file_key(F.col("filename")).alias("filename"), "chars")
    return m.join(codes, "filename", "left")


def chained_left(spark, sf_dir):
    """States with their permits, texts and log entries, each joined in turn."""
    p = table(spark, sf_dir, P).groupBy(F.substring("filename", 1, 2).alias("state")).agg(F.countDistinct("filename").alias("files"))
    m = table(spark, sf_dir, MAN).groupBy(F.substring(T.file_key(F.col("filename")), 1, 2).alias("state")).agg(F.sum("pages").alias("pages"))
    g = table(spark, sf_dir, LOG).groupBy(F.substring(T.file_key(F.col("filename")), 1, 2).alias("state")).agg(F.count("*").alias("entries"))
    return p.join(m, "state", "left").join(g, "state", "left").select("state", "files", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("entries", F.lit(0)).alias("entries"))


def full_outer_align(spark, sf_dir):
    """Rows of two runs per file, side by side, 0 where a run has none."""
    a, b = _runs(spark, sf_dir, "run_a", "run_d")
    n = lambda d, c: d.groupBy("filename").agg(F.count("*").alias(c))
    return n(a, "rows_a").join(n(b, "rows_d"), "filename", "full_outer").na.fill(0)


def unit_key_anti(spark, sf_dir):
    """Units of run b that run a does not have."""
    a, b = [d.where("status = 'Success'").withColumn("unit", T.unit_key(F.col("unit_id"), F.col("unit_description"))) for d in _runs(spark, sf_dir, "run_a", "run_b")]
    return b.join(a.select("filename", "unit").distinct(), ["filename", "unit"], "left_anti").select("row_id", "filename", "unit")


def key_set_stats(spark, sf_dir):
    a, b = [d.where("status = 'Success'").withColumn("unit", T.unit_key(F.col("unit_id"), F.col("unit_description"))) for d in _runs(spark, sf_dir, "run_a", "run_b")]
    return merge.key_sets(a, b, "filename", "unit")


def fuzzy_match(spark, sf_dir):
    """Towns of single files matched, state by state, to the towns of three files or more."""
    d = table(spark, sf_dir, P).where("facility_state_abbreviation is not null").select("filename", F.col("facility_state_abbreviation").alias("state"), T.company_name(F.col("facility_city")).alias("town"))
    n = d.groupBy("state", "town").agg(F.countDistinct("filename").alias("files"))
    return match.blocked_fuzzy(n.where("files < 3"), n.where("files >= 3"), "state", "town").withColumnsRenamed({"block": "state", "name": "town"})


def two_hop_lookup(spark, sf_dir):
    """Customers to their nation and on to its region."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("c_custkey", "r_name")


def align_models(spark, sf_dir):
    """Units of each file aligned over the runs that found them: which models, and their makes side by side."""
    d = table(spark, sf_dir, P).where("status = 'Success'").withColumn("unit", T.unit_key(F.col("unit_id"), F.col("unit_description")))
    one = d.groupBy("filename", "unit", "model_used").agg(F.max("unit_make").alias("make"))
    g = one.groupBy("filename", "unit").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_used", "make")))).alias("by_model"))
    return g.where(F.size("by_model") > 1).select("filename", "unit", F.array_join(F.map_keys("by_model"), ",").alias("models"), F.array_join(F.map_values("by_model"), "|", "?").alias("makes"))


def propagate_flag(spark, sf_dir):
    """All documents of sources that deliver any document without text."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "source").join(d.where("text is null").select("source").distinct(), "source", "left_semi")


def point_in_polygon(spark, sf_dir):
    d = table(spark, sf_dir, "customer")
    return d.where(match.inside_polygon(F.col("c_acctbal"), F.col("c_custkey").cast("double"), POLYGON)).select("c_custkey")


def judge_pairing(spark, sf_dir):
    """Files that at least two of three reviewers answered, with their record ids."""
    d = table(spark, sf_dir, "validation_run")
    r = [d.where(F.col("reviewer") == v).groupBy("filename").agg(F.max("record_id").alias(c)) for v, c in (("rev_20", "a"), ("rev_10", "b"), ("rev_13", "c"))]
    j = r[0].join(r[1], "filename", "full_outer").join(r[2], "filename", "full_outer")
    return j.where(sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in "bc"), F.when(F.col("a").isNotNull(), 1).otherwise(0)) >= 2)


def key_set_algebra(spark, sf_dir):
    """Files in the manifest or the log, in both, and in one only."""
    m, g = (table(spark, sf_dir, t).select(T.file_key(F.col("filename")).alias("file")) for t in (MAN, LOG))
    parts = {"union": m.union(g).distinct(), "both": m.intersect(g), "manifest_only": m.subtract(g), "log_only": g.subtract(m)}
    out = None
    for k, d in parts.items():
        d = d.select("file", F.lit(k).alias("part"))
        out = d if out is None else out.unionByName(d)
    return out


def aligned_columns(spark, sf_dir):
    """Rows under older headings renamed, aligned to a wider order, with a code inserted behind its anchor."""
    d = table(spark, sf_dir, P).select("row_id", F.col("facility_name").alias("facility"), F.col("fuel_type").alias("fuel"), "naics_code", "unit_id")
    d = N.aligned(N.renamed(d), ["row_id", "facility_name", "unit_id", "unit_model", "naics_code"])
    return N.inserted_after(d, "naics_code", {"naics_digits": T.digits_only(F.col("naics_code"))})


def merge_replace(spark, sf_dir):
    a, b = _runs(spark, sf_dir, "run_a", "run_d")
    return merge.replace_by_key(a.select("row_id", "filename", "unit_id"), b.select("row_id", "filename", "fuel_type"), "filename")


def append_new_only(spark, sf_dir):
    a, b = _runs(spark, sf_dir, "run_d", "run_a")
    return merge.append_new(a.select("row_id", "filename"), b.select("row_id", "filename"), "filename")


def merge_source_selection(spark, sf_dir):
    a, b = _runs(spark, sf_dir, "run_d", "run_a")
    c = ["row_id", "filename", "model_used"]
    return merge.select_source(a.select(c), b.select(c), "filename", "run", ("newer", "older"), {"model_used": "unknown (newer run)"}, "row_id")


def merge_carry_over(spark, sf_dir):
    a, b = _runs(spark, sf_dir, "run_a", "run_b")
    c = ["row_id", "filename", "naics_resolved", "naics_source", "source_sheet"]
    return merge.replace_carrying(a.select(c), b.select(c), "filename", "row_id", ["naics_resolved", "naics_source", "source_sheet"])


def merge_additive(spark, sf_dir):
    a, b = _runs(spark, sf_dir, "run_a", "run_c")
    c = ["row_id", "filename", "status", "unit_id", "unit_description"]
    return merge.additive(a.select(c), b.select(c), "filename", T.unit_key(F.col("unit_id"), F.col("unit_description")), "status").select("row_id", "filename", "status")


def merge_chunks(spark, sf_dir):
    """Each file's runs as chunks: general fields by the first value in run order."""
    d = table(spark, sf_dir, P).where("status = 'Success'")
    return merge.merge_chunks(d, "filename", ["source_run", "row_id"], GENERAL, "unit_id", UNIT)[0]


def merge_chunk_units(spark, sf_dir):
    d = table(spark, sf_dir, P).where("status = 'Success'").withColumn("unit", T.unit_key(F.col("unit_id"), F.col("unit_description")))
    d = d.withColumn("chunk", F.when(F.col("source_run") == "run_d", -1).otherwise(F.ascii(F.substring("source_run", 5, 1)) - 97))  # the second pass comes first
    return merge.merge_chunks(d, "filename", ["chunk", "row_id"], GENERAL, "unit", UNIT)[1].select("filename", "unit", "row_id")


def reassemble_chunks(spark, sf_dir):
    """Markers of chunks parsed back; chunks that never came are counted."""
    d = table(spark, sf_dir, LOG).select(F.concat(F.lit("[[DOC:"), T.file_key(F.col("filename")), F.lit("::chunk"), F.col("log_id") % 4, F.lit("/4]]")).alias("marker"), "status")
    pattern = r"\[\[DOC:(.+)::chunk([0-9]+)/([0-9]+)\]\]"
    d = d.select(*[F.regexp_extract("marker", pattern, i).alias(c) for i, c in ((1, "file"), (2, "chunk"), (3, "of"))], "status")
    one = d.groupBy("file", "chunk", "of").agg(F.max(F.when(F.col("status") == "success", 1).otherwise(0)).alias("ok"))
    g = one.groupBy("file").agg(F.max(F.col("of").cast("bigint")).alias("n"), F.sum("ok").alias("ok"), F.count("*").alias("came"))
    return g.select("file", "n", "ok", (F.col("came") - F.col("ok")).alias("failed"), (F.col("n") - F.col("came")).alias("missing"))


def clean_pass(spark, sf_dir):
    """Successful rows of each facility's latest file, cleaned again."""
    c = F.col
    d = table(spark, sf_dir, P).where(F.col("status").startswith("Success") & c("facility_name").isNotNull())
    key = T.joined_key(c("facility_name"), c("facility_address"), sep="|", upper=False)
    d = dedup.keep_all_of_best(d.select("row_id", "filename", "processing_date", "facility_name", "facility_address", "facility_city", "fuel_type", "issuance_date"), [key], c("processing_date"), c("filename"))
    return d.select("row_id", T.city_case(c("facility_city")).alias("city"), T.canonical_fuel(c("fuel_type")).alias("fuel"), T.normalize_date(c("issuance_date")).alias("issued"))


def log_surgery(spark, sf_dir):
    """The log without the successes of one day."""
    t = F.col("logged_at").cast("timestamp")
    d = table(spark, sf_dir, LOG)
    return d.where(~((F.col("status") == "success") & (t >= F.lit("2024-01-02").cast("timestamp")) & (t < F.lit("2024-01-03").cast("timestamp")))).select("log_id", "status")


def side_by_side(spark, sf_dir):
    """Answers of files and fields, one column per model of the panel: did it give the reviewer's value."""
    d = table(spark, sf_dir, "validation_run").select("record_id", F.explode("field_summary").alias("field", "s")).select("record_id", "field", F.explode("s.complete_models").alias("model"), F.col("s.agreeing_models").alias("agreeing"))
    d = d.withColumn("agrees", F.array_contains("agreeing", F.col("model")).cast("int"))
    models = ["ext-large-a", "ext-large-b", "ext-mini-d", "ext-small-c"]
    p = d.groupBy("record_id", "field").pivot("model", models).agg(F.max("agrees"))
    return p.withColumnsRenamed({m: m.replace("-", "_") for m in models})


QUERIES = {f.__name__: f for f in (left_centroids, fill_zero_join, fanout_join, semi_registry, anti_pending, lookup_first, chained_left, full_outer_align, unit_key_anti, key_set_stats, fuzzy_match, two_hop_lookup, align_models, propagate_flag, point_in_polygon, judge_pairing, key_set_algebra, aligned_columns, merge_replace, append_new_only, merge_source_selection, merge_carry_over, merge_additive, merge_chunks, merge_chunk_units, reassemble_chunks, clean_pass, log_surgery, side_by_side)}

_U = S.unit_key("unit_id", "unit_description")
_FILE = r"regexp_replace(lower(trim(filename)), '\.(pdf|txt|json|html?)$', '')"
_EDGES = " + ".join(f"(CASE WHEN ({y1} > y) <> ({y2} > y) AND x < (y - {y1}) * ({(x2 - x1) / (y2 - y1)!r}) + {x1} THEN 1 ELSE 0 END)" for (x1, y1), (x2, y2) in zip(POLYGON, POLYGON[1:] + POLYGON[:1]) if y1 != y2)


def _more_sql():
    from fluelake.plans.scalars import _CITY, _FKEY as fuel_key, _FUEL, _HELD, _sql_date

    run = lambda r: f"(SELECT * FROM {P} WHERE source_run = '{r}')"
    key = f"lower({S.strip('coalesce(facility_name, chr(32))')}) || '|' || lower({S.strip('coalesce(facility_address, chr(32))')})"
    filled = " + ".join(f"({c} IS NOT NULL)::INT" for c in UNIT)
    pick = lambda v, r: f"(SELECT filename, max(record_id) AS {v} FROM validation_run WHERE reviewer = '{r}' GROUP BY 1)"
    return {
        "left_centroids": "WITH m AS (SELECT source, lang, median(n_chars) AS middle FROM documents WHERE n_chars > 0 GROUP BY ALL) SELECT doc_id, middle FROM documents d LEFT JOIN m ON d.source = m.source AND d.lang = m.lang",
        "fill_zero_join": f"WITH s AS (SELECT DISTINCT lower(facility_state_abbreviation) AS state FROM {P} WHERE facility_state_abbreviation IS NOT NULL), n AS (SELECT lower(substr(trim(filename), 1, 2)) AS s, count(*) AS failed FROM {LOG} WHERE status = 'failed' GROUP BY 1) SELECT state, coalesce(failed, 0) AS failed FROM s LEFT JOIN n ON state = s",
        "fanout_join": "SELECT n_name, s_suppkey FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey",
        "semi_registry": f"SELECT {_FILE} AS file, status, pages FROM {MAN} WHERE {_FILE} IN (SELECT filename FROM {P})",
        "anti_pending": f"SELECT DISTINCT {_FILE} AS file FROM {MAN} WHERE status = 'ok' AND {_FILE} NOT IN (SELECT {_FILE} FROM {LOG} WHERE status = 'success')",
        "lookup_first": f"WITH c AS (SELECT filename, arg_min(naics_resolved, row_id) AS code, arg_min(naics_source, row_id) AS origin FROM {P} WHERE naics_resolved IS NOT NULL GROUP BY 1) SELECT m.f AS filename, chars, code, origin FROM (SELECT {_FILE} AS f, chars FROM {MAN}) m LEFT JOIN c ON c.filename = m.f",
        "chained_left": f"""
            WITH p AS (SELECT substr(filename, 1, 2) AS state, count(DISTINCT filename) AS files FROM {P} GROUP BY 1), m AS (SELECT substr({_FILE}, 1, 2) AS state, CAST(sum(pages) AS BIGINT) AS pages FROM {MAN} GROUP BY 1),
            g AS (SELECT substr({_FILE}, 1, 2) AS state, count(*) AS entries FROM {LOG} GROUP BY 1)
            SELECT p.state, files, coalesce(pages, 0) AS pages, coalesce(entries, 0) AS entries FROM p LEFT JOIN m ON p.state = m.state LEFT JOIN g ON p.state = g.state""",
        "full_outer_align": f"SELECT filename, count(*) FILTER (WHERE source_run = 'run_a') AS rows_a, count(*) FILTER (WHERE source_run = 'run_d') AS rows_d FROM {P} WHERE source_run IN ('run_a', 'run_d') GROUP BY 1",
        "unit_key_anti": f"WITH d AS (SELECT row_id, filename, source_run, {_U} AS unit FROM {P} WHERE status = 'Success') SELECT row_id, filename, unit FROM d b WHERE source_run = 'run_b' AND NOT EXISTS (SELECT 1 FROM d a WHERE a.source_run = 'run_a' AND a.filename = b.filename AND a.unit = b.unit)",
        "key_set_stats": f"""
            WITH d AS (SELECT filename, {_U} AS unit, max((source_run = 'run_a')::INT) AS o, max((source_run = 'run_b')::INT) AS n FROM {P} WHERE status = 'Success' AND source_run IN ('run_a', 'run_b') GROUP BY ALL)
            SELECT filename, CAST(sum(o * n) AS BIGINT) AS shared, CAST(sum((1 - o) * n) AS BIGINT) AS added, CAST(sum(o * (1 - n)) AS BIGINT) AS old_only FROM d GROUP BY 1""",
        "two_hop_lookup": "SELECT c_custkey, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
        "align_models": f"""
            WITH d AS (SELECT filename, {_U} AS unit, model_used, max(unit_make) AS make FROM {P} WHERE status = 'Success' GROUP BY ALL)
            SELECT filename, unit, string_agg(model_used, ',' ORDER BY model_used) AS models, string_agg(coalesce(make, '?'), '|' ORDER BY model_used) AS makes FROM d GROUP BY ALL HAVING count(*) > 1""",
        "propagate_flag": "SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents WHERE text IS NULL)",
        "point_in_polygon": f"WITH d AS (SELECT c_custkey, c_acctbal AS x, CAST(c_custkey AS DOUBLE) AS y FROM customer) SELECT c_custkey FROM d WHERE x BETWEEN 0 AND 9000 AND y BETWEEN 0 AND 1400 AND ({_EDGES}) % 2 = 1",
        "judge_pairing": f"SELECT filename, a, b, c FROM {pick('a', 'rev_20')} FULL JOIN {pick('b', 'rev_10')} USING (filename) FULL JOIN {pick('c', 'rev_13')} USING (filename) WHERE (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT >= 2",
        "key_set_algebra": f"""
            WITH m AS (SELECT {_FILE} AS file FROM {MAN}), g AS (SELECT {_FILE} AS file FROM {LOG})
            SELECT file, 'union' AS part FROM (SELECT file FROM m UNION SELECT file FROM g) UNION ALL SELECT file, 'both' FROM (SELECT file FROM m INTERSECT SELECT file FROM g)
            UNION ALL SELECT file, 'manifest_only' FROM (SELECT file FROM m EXCEPT SELECT file FROM g) UNION ALL SELECT file, 'log_only' FROM (SELECT file FROM g EXCEPT SELECT file FROM m)""",
        "aligned_columns": f"SELECT row_id, facility_name, unit_id, CAST(NULL AS VARCHAR) AS unit_model, naics_code, nullif(regexp_replace(naics_code, '[^0-9]', '', 'g'), '') AS naics_digits, fuel_type FROM {P}",
        "merge_replace": f"SELECT row_id, filename, unit_id, NULL AS fuel_type FROM {run('run_a')} WHERE filename NOT IN (SELECT filename FROM {run('run_d')}) UNION ALL SELECT row_id, filename, NULL, fuel_type FROM {run('run_d')}",
        "append_new_only": f"SELECT row_id, filename FROM {run('run_d')} UNION ALL SELECT row_id, filename FROM {run('run_a')} WHERE filename NOT IN (SELECT filename FROM {run('run_d')})",
        "merge_source_selection": f"""
            SELECT row_id, n.filename, coalesce(CASE WHEN NOT {S.blank('model_used', ['', 'nan', 'none', 'null'])} THEN model_used END, o, 'unknown (newer run)') AS model_used, 'newer' AS run
            FROM {run('run_d')} n LEFT JOIN (SELECT filename, arg_min(model_used, row_id) FILTER (WHERE NOT {S.blank('model_used', ['', 'nan', 'none', 'null'])}) AS o FROM {run('run_a')} GROUP BY 1) k ON n.filename = k.filename
            UNION ALL SELECT row_id, filename, model_used, 'older' FROM {run('run_a')} WHERE filename NOT IN (SELECT filename FROM {run('run_d')})""",
        "merge_carry_over": f"""
            WITH k AS (SELECT filename, {', '.join(f'arg_min({c}, row_id) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in ('naics_resolved', 'naics_source', 'source_sheet'))} FROM {run('run_a')} GROUP BY 1)
            SELECT row_id, filename, naics_resolved, naics_source, source_sheet FROM {run('run_a')} WHERE filename NOT IN (SELECT filename FROM {run('run_b')})
            UNION ALL SELECT n.row_id, n.filename, k.naics_resolved, k.naics_source, k.source_sheet FROM {run('run_b')} n LEFT JOIN k ON n.filename = k.filename""",
        "merge_additive": f"""
            WITH o AS (SELECT *, {_U} AS u FROM {run('run_a')}), n AS (SELECT *, {_U} AS u FROM {run('run_c')}),
            failed AS (SELECT DISTINCT filename FROM n WHERE filename NOT IN (SELECT filename FROM o WHERE starts_with(status, 'Success'))),
            fresh AS (SELECT row_id, filename, status FROM n WHERE status = 'Success' AND (filename IN (SELECT filename FROM failed) OR NOT EXISTS (SELECT 1 FROM o WHERE o.status = 'Success' AND o.filename = n.filename AND o.u = n.u))),
            units AS (SELECT filename FROM o WHERE status = 'Success' AND filename IN (SELECT filename FROM n) UNION SELECT filename FROM fresh)
            SELECT row_id, filename, status FROM o WHERE filename NOT IN (SELECT filename FROM n) OR (filename NOT IN (SELECT filename FROM failed) AND NOT (status = 'Success (No Units Found)' AND filename IN (SELECT filename FROM units)))
            UNION ALL SELECT * FROM fresh UNION ALL SELECT row_id, filename, status FROM n WHERE status = 'Success (No Units Found)' AND filename IN (SELECT filename FROM failed) AND filename NOT IN (SELECT filename FROM fresh)""",
        "merge_chunks": f"SELECT filename, {', '.join(f'arg_min({c}, (source_run, row_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in GENERAL)} FROM {P} WHERE status = 'Success' GROUP BY 1",
        "merge_chunk_units": f"""
            WITH d AS (SELECT filename, {_U} AS unit, row_id, CASE WHEN source_run = 'run_d' THEN -1 ELSE ascii(source_run[5:5]) - 97 END AS chunk, {filled} AS filled FROM {P} WHERE status = 'Success')
            SELECT filename, unit, row_id FROM d QUALIFY row_number() OVER (PARTITION BY filename, unit ORDER BY filled DESC, chunk, row_id) = 1""",
        "reassemble_chunks": f"""
            WITH d AS (SELECT {_FILE} AS file, log_id % 4 AS chunk, max((status = 'success')::INT) AS ok FROM {LOG} GROUP BY ALL)
            SELECT file, CAST(4 AS BIGINT) AS n, CAST(sum(ok) AS BIGINT) AS ok, CAST(count(*) - sum(ok) AS BIGINT) AS failed, 4 - count(*) AS missing FROM d GROUP BY 1""",
        "clean_pass": f"""
            WITH d AS (SELECT *, {key} AS k FROM {P} WHERE starts_with(status, 'Success') AND facility_name IS NOT NULL),
            w AS (SELECT k, filename AS won FROM d QUALIFY row_number() OVER (PARTITION BY k ORDER BY processing_date DESC NULLS LAST, filename DESC) = 1)
            SELECT row_id, CASE WHEN {_CITY} <> '' THEN CASE WHEN {_CITY} = upper({_CITY}) AND {_CITY} <> lower({_CITY}) AND length({_CITY}) > 3 THEN {S.title_case(_CITY)} ELSE {_CITY} END END AS city,
                CASE WHEN {_FUEL} <> '' THEN coalesce({S.lookup(fuel_key, T.FUEL_SYNONYMS)}, CASE {_HELD} END, {_FUEL}) END AS fuel, {_sql_date('issuance_date')} AS issued FROM d JOIN w USING (k) WHERE filename = won""",
        "log_surgery": f"SELECT log_id, status FROM {LOG} WHERE NOT (status = 'success' AND logged_at >= TIMESTAMP '2024-01-02' AND logged_at < TIMESTAMP '2024-01-03')",
        "side_by_side": """
            WITH e AS (SELECT record_id, unnest(map_keys(field_summary)) AS field, unnest(map_values(field_summary)) AS s FROM validation_run), d AS (SELECT record_id, field, unnest(s.complete_models) AS model, s.agreeing_models AS g FROM e)
            SELECT record_id, field, """ + ", ".join(f"max(CASE WHEN model = '{m}' THEN list_contains(g, model)::INT END) AS {m.replace('-', '_')}" for m in ("ext-large-a", "ext-large-b", "ext-mini-d", "ext-small-c")) + " FROM d GROUP BY ALL",
    }


SQL = _more_sql()
