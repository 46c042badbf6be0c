"""Session, table access and lineage cutting shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "fluelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; ``conf`` overrides them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return b.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or the context's. Where neither is set a
    local master gets a new temporary folder, as in tests; a cluster gets an error, as its executors share no such one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context._jsc.sc().getCheckpointDir()
        folder = folder.get() if folder.isDefined() else None
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="fluelake-checkpoint-")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder


def own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that holds what this application stores."""
    return f"{checkpoint_dir(spark).rstrip('/')}/fluelake-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes what this application stored in the shared folder; results not yet written are lost with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder; a lost executor costs nothing that was done."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a compressed table in the shared folder and read from there; for wide rows such as
    texts, which a checkpoint would keep uncompressed."""
    path = f"{own_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def input_name(name: str, taken: list[str]) -> str:
    """``name``, prolonged until no column of ``taken`` has it (names compare without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def repo_root() -> str:
    return os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def squashed(col):
    """Lower case, every kind of space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(col), r"[\s\u00a0\u2007\u202f]+", " "))
