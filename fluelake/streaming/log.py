"""The processing log as a stream: latest status, windows, resumption, and a guard against runs of failures."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fluelake.functions.text import file_key
from fluelake.sources.io import fresh_folder


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream; a bounded number of files a batch. The path is given
    as a pattern of itself, as a stream takes no single file otherwise."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 64).parquet(f"{path[:-1]}[{path[-1]}]")


def finish(stream: DataFrame, mode: str, write) -> None:
    """Run what is there and stop; the checkpoint lies in the shared folder."""
    spark = stream.sparkSession
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", fresh_folder(spark, "stream")).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()


def latest_status(stream: DataFrame) -> DataFrame:
    """The last success or failure of each file: state is one row a file."""
    d = stream.where("status in ('success', 'failed')").withColumn("file", file_key(F.col("filename")))
    last = F.max_by(F.struct("log_id", "status", "model_used"), F.struct("logged_at", "log_id"))
    return d.groupBy("file").agg(last.alias("l")).select("file", "l.*")


def upsert_to(path: str):
    """A batch writer that keeps, under ``path``/<batch>, the latest whole table; a repeated batch writes the same."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number:06d}")

    return write


def newest(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """The table of the last batch under ``path``; ``empty``'s columns without rows if none came."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().toString() for s in fs.listStatus(root)) if fs.exists(root) else []
    return spark.read.parquet(names[-1]) if names else empty.limit(0)


def windowed(events: DataFrame, width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events by type in tumbling or sliding windows; rows later than ``late`` are past."""
    d = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    w = F.window("at", width, slide) if slide else F.window("at", width)
    return d.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def pending(stream: DataFrame, done: DataFrame) -> DataFrame:
    """Entries of files that an earlier run has not finished."""
    return stream.withColumn("file", file_key(F.col("filename"))).join(done.select("file").distinct(), "file", "left_anti")


def failure_runs(stream: DataFrame, key: str = "model_used", most: int = 15) -> DataFrame:
    """(key, longest, tripped): per key the longest run of consecutive failures so far, and whether it reached
    ``most``. The state is the current run, the longest one and the last time seen. Late entries count at their batch."""

    def count(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, longest = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values(["logged_at", "log_id"])
        for s in rows["status"]:
            run = run + 1 if s == "failed" else 0
            longest = max(longest, run)
        state.update((run, longest))
        yield pd.DataFrame({key: [k[0]], "longest": [longest], "tripped": [longest >= most]})

    d = stream.where(F.col(key).isNotNull()).select(key, "log_id", "logged_at", "status")
    return d.groupBy(key).applyInPandasWithState(count, f"{key} string, longest long, tripped boolean", "run long, longest long", "update", GroupStateTimeout.NoTimeout)
