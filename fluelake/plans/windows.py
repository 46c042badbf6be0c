"""Queries of deduplication, ranking and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fluelake.functions import text as T
from fluelake.operators import dedup, sampling
from fluelake.plans import sqltools as S
from fluelake.runtime import table

P, LOG = "permit_data_extracted", "processing_log"


def keep_latest(spark, sf_dir):
    d = table(spark, sf_dir, P).select("row_id", "filename", "unit_id", "unit_description", "processing_date")
    d = d.withColumn("unit", T.unit_key(F.col("unit_id"), F.col("unit_description")))
    return dedup.keep_latest(d, [F.col("filename"), F.col("unit")], F.col("processing_date"), F.col("row_id")).select("row_id", "filename", "unit", "processing_date")


def latest_file_per_facility(spark, sf_dir):
    c = F.col
    d = table(spark, sf_dir, P).where("status = 'Success'").select("row_id", "filename", "processing_date", "facility_name", "facility_state_abbreviation")
    key = T.joined_key(c("facility_name"), c("facility_state_abbreviation"), sep="|", upper=False)
    return dedup.keep_all_of_best(d, [key], c("processing_date"), c("filename")).select("row_id", "filename")


def last_wins_log(spark, sf_dir):
    d = table(spark, sf_dir, LOG).where("status in ('success', 'failed')").withColumn("file", T.file_key(F.col("filename")))
    return dedup.last_by(d, [F.col("file")], F.col("logged_at"), F.col("log_id")).select("file", "log_id", "status", "model_used")


def first_wins(spark, sf_dir):
    d = table(spark, sf_dir, P).where("status = 'Success'").select("filename", "row_id", "facility_name")
    return dedup.first_by(d, [F.col("filename")], F.col("row_id"))


def highest_revision(spark, sf_dir):
    """Of each permit (a file name without its revision) the file of the highest revision number."""
    d = table(spark, sf_dir, P).select("filename").distinct()
    base, rev = F.regexp_extract("filename", r"^([a-z]{2}_[0-9]+)", 1), F.regexp_extract("filename", r"_v?([0-9]+)$", 1).try_cast("int")
    d = d.select("filename", base.alias("permit"), F.coalesce(rev, F.lit(0)).alias("revision"))
    return dedup.last_by(d, [F.col("permit")], F.col("revision"), F.col("filename"))


def tied_revision(spark, sf_dir):
    """All files of a state that have its highest revision."""
    d = table(spark, sf_dir, P).select("filename").distinct()
    d = d.select("filename", F.substring("filename", 1, 2).alias("state"), F.regexp_extract("filename", r"_v?([0-9]+)$", 1).try_cast("int").alias("revision"))
    return dedup.keep_ties(d, [F.col("state")], F.col("revision"))


def latest_by_written_date(spark, sf_dir):
    """Of each facility the permit whose date text is longest, then greatest."""
    d = table(spark, sf_dir, P).where("facility_name is not null and issuance_date is not null").select("facility_name", "filename", "issuance_date").distinct()
    return dedup.last_by(d, [F.col("facility_name")], F.length("issuance_date"), F.col("issuance_date"), F.col("filename"))


def latest_or_keyless(spark, sf_dir):
    d = table(spark, sf_dir, P).select("row_id", "permit_number", "permit_type", "issuance_date").withColumn("day", T.normalize_date(F.col("issuance_date")))
    key = F.when(F.col("permit_number").isNotNull(), F.concat_ws("|", "permit_number", "permit_type"))
    return dedup.latest_or_keyless(d, key, F.col("day"), F.col("row_id")).select("row_id", "permit_number", "day")


def tiered_pick(spark, sf_dir):
    """Of each facility the renewal, else the title V permit, else any, then the latest."""
    d = table(spark, sf_dir, P).where("facility_name is not null").select("facility_name", "filename", "permit_type", "issuance_date").distinct()
    tier = F.when(F.col("permit_type").contains("Renewal"), 3).when(F.col("permit_type").rlike("Initial|Title V"), 2).otherwise(1)
    d = d.withColumns({"tier": tier, "day": T.normalize_date(F.col("issuance_date"))})
    return dedup.tiered(d, [F.col("facility_name")], F.col("tier"), F.col("day"), F.col("filename")).select("facility_name", "filename", "tier", "day")


def qcut_bins(spark, sf_dir):
    """Documents by quartile of their length at interpolated edges, right-closed."""
    d = table(spark, sf_dir, "documents").where("n_chars is not null").select("doc_id", "n_chars")
    return sampling.quantile_bins(d, "n_chars", 4).select("doc_id", "n_chars", "bin")


def positional_bins(spark, sf_dir):
    """Files ranked by text length and cut into five runs of floor(k * n / 5)."""
    d = table(spark, sf_dir, "extracted_text").where("source is not null").select("text_id", F.length("source").alias("chars"))
    return sampling.positional_bins(d, [F.col("chars"), F.col("text_id")], 5).select("text_id", "bin")


def stratified_sample(spark, sf_dir):
    """60 files by state in proportion, at least one a state, drawn by hash."""
    d = table(spark, sf_dir, P).where("facility_state_abbreviation is not null").select("filename", F.col("facility_state_abbreviation").alias("state")).groupBy("filename").agg(F.min("state").alias("state"))
    return sampling.stratified(d, "state", "filename", 60, "permits")


def simple_sample(spark, sf_dir):
    """40 successful files by hash order."""
    d = table(spark, sf_dir, P).where("status = 'Success'").select("filename").distinct()
    return sampling.simple(d, "filename", 40, "permits")


def top_by_measure(spark, sf_dir):
    """The ten files with the most rows."""
    d = table(spark, sf_dir, P).groupBy("filename").agg(F.count("*").alias("rows"))
    return d.orderBy(F.desc("rows"), "filename").limit(10)


def majority_value(spark, sf_dir):
    """The commonest permit type of each file, of equals the first in the alphabet; UNKNOWN for none."""
    d = table(spark, sf_dir, P).groupBy("filename", "permit_type").agg(F.count("*").alias("n"))
    best = F.min_by("permit_type", F.when(F.col("permit_type").isNotNull(), F.struct(-F.col("n"), F.col("permit_type"))))
    return d.groupBy("filename").agg(F.coalesce(best, F.lit("UNKNOWN")).alias("permit_type"))


def ranked_first(spark, sf_dir):
    """Counties' rank by files, ties in the order of their names."""
    d = table(spark, sf_dir, P).where("facility_county is not null").groupBy("facility_county").agg(F.countDistinct("filename").alias("files"))
    return d.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("files"), "facility_county")))  # one row a county


QUERIES = {f.__name__: f for f in (keep_latest, latest_file_per_facility, last_wins_log, first_wins, highest_revision, tied_revision, latest_by_written_date, latest_or_keyless, tiered_pick, qcut_bins, positional_bins, stratified_sample, simple_sample, top_by_measure, majority_value, ranked_first)}


def _day(c):
    from fluelake.plans.scalars import _sql_date

    return _sql_date(c)


_REV = "try_cast(nullif(regexp_extract(filename, '_v?([0-9]+)$', 1), '') AS INTEGER)"
_FKEY = f"lower({S.strip('coalesce(facility_name, chr(32))')}) || '|' || lower({S.strip('coalesce(facility_state_abbreviation, chr(32))')})"
SQL = {
    "keep_latest": f"SELECT row_id, filename, {S.unit_key('unit_id', 'unit_description')} AS unit, processing_date FROM {P} QUALIFY row_number() OVER (PARTITION BY filename, unit ORDER BY processing_date DESC NULLS LAST, row_id DESC) = 1",
    "latest_file_per_facility": f"""
        WITH d AS (SELECT row_id, filename, processing_date AS pd, {_FKEY} AS k FROM {P} WHERE status = 'Success'),
        w AS (SELECT k, filename AS won FROM d QUALIFY row_number() OVER (PARTITION BY k ORDER BY pd DESC NULLS LAST, filename DESC) = 1)
        SELECT row_id, filename FROM d JOIN w USING (k) WHERE filename = won""",
    "last_wins_log": r"SELECT regexp_replace(lower(trim(filename)), '\.(pdf|txt|json|html?)$', '') AS file, log_id, status, model_used FROM processing_log WHERE status IN ('success', 'failed') QUALIFY row_number() OVER (PARTITION BY file ORDER BY logged_at DESC, log_id DESC) = 1",
    "first_wins": f"SELECT filename, row_id, facility_name FROM {P} WHERE status = 'Success' QUALIFY row_number() OVER (PARTITION BY filename ORDER BY row_id) = 1",
    "highest_revision": f"WITH d AS (SELECT DISTINCT filename, regexp_extract(filename, '^([a-z]{{2}}_[0-9]+)', 1) AS permit, coalesce({_REV}, 0) AS revision FROM {P}) SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY permit ORDER BY revision DESC, filename DESC) = 1",
    "tied_revision": f"WITH d AS (SELECT DISTINCT filename, substr(filename, 1, 2) AS state, {_REV} AS revision FROM {P}) SELECT * FROM d QUALIFY revision = max(revision) OVER (PARTITION BY state)",
    "latest_by_written_date": f"WITH d AS (SELECT DISTINCT facility_name, filename, issuance_date FROM {P} WHERE facility_name IS NOT NULL AND issuance_date IS NOT NULL) SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY facility_name ORDER BY length(issuance_date) DESC, issuance_date DESC, filename DESC) = 1",
    "latest_or_keyless": f"""
        WITH d AS (SELECT row_id, permit_number, {_day('issuance_date')} AS day, CASE WHEN permit_number IS NOT NULL THEN concat_ws('|', permit_number, permit_type) END AS k FROM {P})
        SELECT row_id, permit_number, day FROM d WHERE k IS NULL OR k = '' UNION ALL
        (SELECT row_id, permit_number, day FROM d WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY day DESC NULLS LAST, row_id DESC) = 1)""",
    "tiered_pick": f"""
        WITH d AS (SELECT DISTINCT facility_name, filename, permit_type, issuance_date FROM {P} WHERE facility_name IS NOT NULL),
        t AS (SELECT facility_name, filename, CASE WHEN contains(permit_type, 'Renewal') THEN 3 WHEN regexp_matches(permit_type, 'Initial|Title V') THEN 2 ELSE 1 END AS tier, {_day('issuance_date')} AS day FROM d)
        SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY facility_name ORDER BY tier DESC, day DESC NULLS LAST, filename DESC) = 1""",
    "qcut_bins": """
        WITH d AS (SELECT doc_id, n_chars FROM documents WHERE n_chars IS NOT NULL), e AS (SELECT quantile_cont(n_chars, [0.25, 0.5, 0.75]) AS q FROM d)
        SELECT doc_id, n_chars, CASE WHEN n_chars <= q[1] THEN 1 WHEN n_chars <= q[2] THEN 2 WHEN n_chars <= q[3] THEN 3 ELSE 4 END AS bin FROM d, e""",
    "positional_bins": "WITH d AS (SELECT text_id, row_number() OVER (ORDER BY length(source), text_id) - 1 AS r, count(*) OVER () AS n FROM extracted_text WHERE source IS NOT NULL) SELECT text_id, CAST((SELECT count(*) FROM generate_series(1, 4) g(k) WHERE r >= k * n // 5) + 1 AS INTEGER) AS bin FROM d",
    "stratified_sample": f"""
        WITH d AS (SELECT filename, min(facility_state_abbreviation) AS state FROM {P} WHERE facility_state_abbreviation IS NOT NULL GROUP BY filename),
        s AS (SELECT state, count(*) AS n, sum(count(*)) OVER () AS t FROM d GROUP BY state),
        q AS (SELECT state, greatest(1, CAST(floor(60 * n / t + 0.5) AS BIGINT)) AS quota FROM s),
        r AS (SELECT filename, state, row_number() OVER (PARTITION BY state ORDER BY md5('permits|' || filename), filename) AS k FROM d)
        SELECT filename, state FROM r JOIN q USING (state) WHERE k <= quota""",
    "simple_sample": f"SELECT DISTINCT filename FROM {P} WHERE status = 'Success' ORDER BY md5('permits|' || filename), filename LIMIT 40",
    "top_by_measure": f"SELECT filename, count(*) AS rows FROM {P} GROUP BY filename ORDER BY rows DESC, filename LIMIT 10",
    "majority_value": f"""
        WITH c AS (SELECT filename, permit_type, count(*) AS n FROM {P} WHERE permit_type IS NOT NULL GROUP BY ALL), m AS (SELECT filename, permit_type FROM c QUALIFY row_number() OVER (PARTITION BY filename ORDER BY n DESC, permit_type) = 1)
        SELECT f.filename, coalesce(m.permit_type, 'UNKNOWN') AS permit_type FROM (SELECT DISTINCT filename FROM {P}) f LEFT JOIN m ON m.filename = f.filename""",
    "ranked_first": f"WITH d AS (SELECT facility_county, count(DISTINCT filename) AS files FROM {P} WHERE facility_county IS NOT NULL GROUP BY 1) SELECT *, CAST(row_number() OVER (ORDER BY files DESC, facility_county) AS INTEGER) AS rank FROM d",
}
