"""Sources and sinks of extraction runs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluelake.functions.text import CONTROL
from fluelake.runtime import checkpoint_dir

#: How a delimited file spells null: "blank" makes empty cells null, "words" also nan and its like, "none" keeps all text.
NULL_POLICIES = ("blank", "words", "none")
_WORDS = ["", "nan", "NaN", "NULL", "null", "None", "N/A", "n/a", "NA", "#N/A"]


def read_csv(spark: SparkSession, path: str | list[str], nulls: str = "blank", encoding: str = "UTF-8", columns: list[str] | None = None) -> DataFrame:
    """A delimited file with every column as text; only ``columns`` are kept, the scan is pruned to them."""
    if nulls not in NULL_POLICIES:
        raise ValueError(f"nulls is one of {NULL_POLICIES}")
    d = spark.read.csv(path, header=True, inferSchema=False, encoding=encoding, multiLine=True, escape='"', emptyValue="", nullValue="\x00", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if columns:
        d = d.select(*columns)
    words = {"blank": [""], "words": _WORDS, "none": []}[nulls]
    return d.select(*[F.when(~F.col(c).isin(words), F.col(c)).alias(c) if words else F.coalesce(c, F.lit("")).alias(c) for c in d.columns])


def read_csv_any(spark: SparkSession, path: str, encodings=("UTF-8", "ISO-8859-1", "windows-1252"), **options) -> DataFrame:
    """The file by the first encoding that leaves no replacement character in its cells."""
    d = None
    for e in encodings:
        d = read_csv(spark, path, encoding=e, **options)
        broken = reduce(lambda a, b: a | b, [F.col(c).contains("�") for c in d.columns])
        if d.where(broken).limit(1).isEmpty():
            return d
    return d


def read_sheets(spark: SparkSession, sheets: dict[str, str], tag: str = "source_sheet") -> DataFrame:
    """Files of one table each, united by name under a tag; absent files are skipped, missing columns null."""
    found = []
    for name, path in sheets.items():
        try:
            found.append(spark.read.parquet(path).withColumn(tag, F.lit(name)))
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
    if not found:
        raise FileNotFoundError("none of the sheets exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Parquet runs with the file they came from and its time; unreadable files are skipped."""
    d = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(path)
    return d.withColumns({"source_file": F.col("_metadata.file_name"), "source_mtime": F.col("_metadata.file_modification_time")})


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON records one a line; lines that are no record are left out."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    d = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return d.where("_corrupt is null").drop("_corrupt")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(stem, text, n_chars, state): whole text files; the state is that of the folder, else of the file name."""
    d = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"))
    return d.select(F.regexp_replace("name", r"\.[A-Za-z]+$", "").alias("stem"), F.col("value").alias("text"), F.length("value").alias("n_chars"), state_of(F.col("path")).alias("state"))


_STATES = "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY PR".split()


def state_of(path: Column) -> Column:
    """A state's letters as a folder, else before the file name's first underscore, else "unknown"."""
    parts = F.split(F.upper(path), "/")
    folder = F.get(F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: p.isin(_STATES)), F.lit(0))
    prefix = F.regexp_extract(F.element_at(parts, -1), "^([A-Z]{2})_", 1)
    return F.coalesce(folder, F.when(prefix.isin(_STATES), prefix), F.lit("unknown"))


def links(html: Column) -> Column:
    """The targets of a page's links, in order."""
    return F.regexp_extract_all(html, F.lit(r"(?i)href\s*=\s*[\"']([^\"'>]+)[\"']"), 1)


def named_links(cell: Column) -> Column:
    """array<struct<name, url>> of a cell of "name(url)" entries."""
    p = r"([^(),][^()]*?)\s*\(\s*(https?://[^)\s]+)\s*\)"
    return F.transform(F.arrays_zip(F.regexp_extract_all(cell, F.lit(p), 1).alias("name"), F.regexp_extract_all(cell, F.lit(p), 2).alias("url")), lambda x: F.struct(F.trim(F.regexp_replace(x["name"], r"^[\s,;]+", "")).alias("name"), x["url"].alias("url")))


def is_relevant_link(url: Column, words: tuple[str, ...] = ("permit", "title v", "titlev", "operating", "air")) -> Column:
    """A document link that names a permit."""
    return url.rlike(r"(?i)\.pdf(\?|$)") & url.rlike("(?i)" + "|".join(words))


def safe_member(path: Column) -> Column:
    """A document inside an archive whose path stays inside."""
    return ~path.startswith("/") & ~path.rlike(r"(^|[/\\])\.\.([/\\]|$)") & path.rlike(r"(?i)\.pdf$")


def scrubbed(df: DataFrame) -> DataFrame:
    """Text columns without illegal control characters."""
    return df.select(*[F.regexp_replace(c, CONTROL, "").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, columns: list[str]) -> str:
    """The columns in their order; those the rows lack are null, others are left out."""
    d = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    d.write.csv(path, header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def append_json_lines(df: DataFrame, path: str) -> str:
    df.write.mode("append").json(path)
    return path


def write_sheets(df: DataFrame, path: str, sheet: str, order: list[Column], required: str) -> str:
    """One folder per sheet, rows without ``required`` left out, sorted within files, scrubbed. The committer makes
    the result visible as a whole."""
    scrubbed(df).where(F.coalesce(F.trim(required) != "", F.lit(False))).sortWithinPartitions(*order).write.partitionBy(sheet).parquet(path)
    return path


def preview(df: DataFrame, order: list[Column], n: int = 500) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A small result as a Markdown table; more than ``most`` rows is an error, as a report is no export."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    head = f"| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}"
    return f"## {title}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows) + "\n"
