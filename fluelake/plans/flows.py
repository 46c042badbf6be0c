"""Queries of sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluelake.plans import sqltools as S
from fluelake.sources import io
from fluelake.streaming import log as L
from fluelake.runtime import table

P = "permit_data_extracted"
SOME = ["row_id", "filename", "status", "facility_name", "facility_address", "unit_id", "fuel_type"]


def csv_round_trip(spark, sf_dir):
    """Rows written as delimited text in a fixed order with an absent column, and read back as text."""
    d = table(spark, sf_dir, P).select(*SOME)
    path = io.write_csv(d, io.fresh_folder(spark, "csv"), [*SOME, "never_there"])
    return io.read_csv(spark, path, columns=[*SOME, "never_there"])


def json_round_trip(spark, sf_dir):
    """The log appended as JSON lines in two parts and read back, malformed lines left out."""
    d = table(spark, sf_dir, "processing_log").select("log_id", "filename", "status", "error_text")
    path = io.fresh_folder(spark, "json")
    for s in ("success", "failed"):
        io.append_json_lines(d.where(F.col("status") == s), path)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(path)
    return io.read_json_lines(spark, path, d.schema)


def parquet_round_trip(spark, sf_dir):
    """Two runs written apart and read together, with the number of files they came from."""
    d = table(spark, sf_dir, P).select("row_id", "source_run")
    path = io.fresh_folder(spark, "runs")
    for r in ("run_a", "run_b"):
        io.write_parquet(d.where(F.col("source_run") == r), f"{path}/{r}")
    return io.read_runs(spark, path).where("source_file is not null and source_mtime is not null").groupBy("source_run").agg(F.count("*").alias("rows"))


def sheet_round_trip(spark, sf_dir):
    """Rows split by sheet, scrubbed and sorted, read back under their tag."""
    d = table(spark, sf_dir, P).select("row_id", "filename", "facility_name", "source_sheet", "naics_resolved")
    path = io.write_sheets(d, io.fresh_folder(spark, "sheets"), "source_sheet", [F.asc_nulls_last("naics_resolved"), F.asc_nulls_last("filename")], "facility_name")
    sheets = {s: f"{path}/source_sheet={s}" for s in ("manufacturing", "other", "absent")}
    return io.read_sheets(spark, sheets).select("row_id", "facility_name", "source_sheet")


def texts_back(spark, sf_dir):
    """(text_id, state, chars, chars_read): every text that is not empty, written as a file under its id and read back."""
    d = table(spark, sf_dir, "extracted_text").where("source is not null and source <> ''").select("text_id", F.substring("filename", 1, 2).alias("state"), "source")
    path = io.fresh_folder(spark, "texts")
    d.select("text_id", F.col("source").alias("text")).write.partitionBy("text_id").option("lineSep", "\u0001").text(path)
    back = io.read_texts(spark, path).select(F.regexp_extract(F.input_file_name(), "text_id=([^/]+)/", 1).cast(d.schema["text_id"].dataType).alias("text_id"), (F.col("n_chars") - 1).cast("bigint").alias("chars_read"))
    return d.select("text_id", "state", F.length("source").cast("bigint").alias("chars")).join(back, "text_id", "full")


def text_round_trip(spark, sf_dir):
    """All texts written as files and read back, a text of another size is an error; the longest size by state."""
    same = F.col("chars").eqNullSafe(F.col("chars_read"))
    return texts_back(spark, sf_dir).groupBy("state").agg(F.max(F.when(same, F.col("chars_read")).otherwise(F.raise_error(F.concat(F.lit("changed text "), F.col("text_id").cast("string"))).cast("bigint"))).alias("chars"))


def preview_rows(spark, sf_dir):
    return io.preview(table(spark, sf_dir, P).select("row_id", "filename", "processing_date"), [F.desc_nulls_last("processing_date"), F.col("row_id")])


def stream_log_upsert(spark, sf_dir):
    """The last status of each file, kept up by a stream."""
    s = L.latest_status(L.stream_of(spark, f"{sf_dir}/processing_log.parquet"))
    path = io.fresh_folder(spark, "status")
    L.finish(s, "complete", L.upsert_to(path))
    return L.newest(spark, path, L.latest_status(table(spark, sf_dir, "processing_log")))


def stream_windows(spark, sf_dir):
    """Events by type and day, from a stream."""
    s = L.windowed(L.stream_of(spark, f"{sf_dir}/events.parquet"), "1 day")
    path = io.fresh_folder(spark, "windows")
    L.finish(s, "complete", L.upsert_to(path))
    return L.newest(spark, path, L.windowed(table(spark, sf_dir, "events"), "1 day")).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_sliding(spark, sf_dir):
    """Events by type in windows of two days that begin every day."""
    s = L.windowed(L.stream_of(spark, f"{sf_dir}/events.parquet"), "2 days", "1 day")
    path = io.fresh_folder(spark, "windows")
    L.finish(s, "complete", L.upsert_to(path))
    return L.newest(spark, path, L.windowed(table(spark, sf_dir, "events"), "2 days", "1 day")).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def session_windows(spark, sf_dir):
    """Users' sessions, parted by two hours of silence."""
    d = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    w = d.groupBy("user_id", F.session_window("at", "2 hours")).agg(F.count("*").alias("n"))
    return w.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def stream_failure_guard(spark, sf_dir):
    """The longest run of failures of each model."""
    s = L.failure_runs(L.stream_of(spark, f"{sf_dir}/processing_log.parquet"), most=5)
    path = io.fresh_folder(spark, "guard")

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/{number:06d}")

    L.finish(s, "update", write)
    d = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return d.groupBy("model_used").agg(F.max("longest").alias("longest"), F.max("tripped").alias("tripped"))


QUERIES = {f.__name__: f for f in (csv_round_trip, json_round_trip, parquet_round_trip, sheet_round_trip, text_round_trip, preview_rows, stream_log_upsert, stream_windows, stream_sliding, session_windows, stream_failure_guard)}
_WINDOW = "SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS n"
SQL = {
    "csv_round_trip": f"SELECT CAST(row_id AS VARCHAR) AS row_id, {', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in SOME[1:])}, CAST(NULL AS VARCHAR) AS never_there FROM {P}",
    "json_round_trip": "SELECT log_id, filename, status, error_text FROM processing_log WHERE status IN ('success', 'failed')",
    "parquet_round_trip": f"SELECT source_run, count(*) AS rows FROM {P} WHERE source_run IN ('run_a', 'run_b') GROUP BY 1",
    "sheet_round_trip": f"SELECT row_id, facility_name, source_sheet FROM {P} WHERE trim(facility_name) <> ''",
    "text_round_trip": "SELECT substr(filename, 1, 2) AS state, CAST(max(length(source)) AS BIGINT) AS chars FROM extracted_text WHERE source IS NOT NULL AND source <> '' GROUP BY 1",
    "preview_rows": f"SELECT row_id, filename, processing_date FROM {P} ORDER BY processing_date DESC NULLS LAST, row_id LIMIT 500",
    "stream_log_upsert": r"SELECT regexp_replace(lower(trim(filename)), '\.(pdf|txt|json|html?)$', '') AS file, log_id, status, model_used FROM processing_log WHERE status IN ('success', 'failed') QUALIFY row_number() OVER (PARTITION BY file ORDER BY logged_at DESC, log_id DESC) = 1",
    "stream_windows": f"{_WINDOW}, round(sum(value), 4) AS total FROM (SELECT date_trunc('day', ts) AS d, event_type, value FROM events) GROUP BY ALL",
    "stream_sliding": f"{_WINDOW} FROM (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS d, event_type FROM events) GROUP BY ALL",
    "session_windows": """
        WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g), n AS (SELECT user_id, k, count(*) AS n FROM s GROUP BY ALL)
        SELECT user_id, count(*) AS sessions, max(n) AS longest FROM n GROUP BY 1""",
    "stream_failure_guard": """
        WITH d AS (SELECT model_used, status, row_number() OVER (PARTITION BY model_used ORDER BY logged_at, log_id) AS a, row_number() OVER (PARTITION BY model_used, status = 'failed' ORDER BY logged_at, log_id) AS b FROM processing_log WHERE model_used IS NOT NULL),
        r AS (SELECT model_used, count(*) FILTER (WHERE status = 'failed') AS n FROM d GROUP BY model_used, a - b, status = 'failed') SELECT model_used, max(n) AS longest, max(n) >= 5 AS tripped FROM r GROUP BY 1""",
}
