"""Nested extraction documents: parse, flatten, rebuild; chunks of long texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CHUNK, CHUNK_OVERLAP = 320_000, 4_000


def schema(general: list[str], unit: list[str], units: str = "emission_units") -> T.StructType:
    """A nullable string field for each name, and an array of units."""
    inner = T.StructType([T.StructField(u, T.StringType()) for u in unit])
    return T.StructType([*[T.StructField(g, T.StringType()) for g in general], T.StructField(units, T.ArrayType(inner))])


def field_names(names: list[str]) -> dict[str, str]:
    """Each name with only letters, digits and single underscores; an error if two become one."""
    import re

    out = {n: re.sub(r"[^A-Za-z0-9_]+", "_", n).strip("_") for n in names}
    if len(set(out.values())) < len(out):
        raise ValueError("two fields have one name after cleaning")
    return out


def unfenced(text: Column) -> Column:
    """The text inside a code fence, or the whole text."""
    body = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(body != "", body).otherwise(text)


def parsed(text: Column, form: T.StructType, units: str = "emission_units") -> Column:
    """A fenced or bare JSON document as a struct, null for what is none; missing units are an empty array."""
    d = F.from_json(unfenced(text), form, {"mode": "PERMISSIVE"})
    some = F.coalesce(*[d[f.name].cast("string") for f in form.fields if f.name != units], F.when(d[units].isNotNull(), ""))
    return F.when(some.isNotNull(), d.withField(units, F.coalesce(d[units], F.array().cast(form[units].dataType))))


def flattened(df: DataFrame, document: str, general: list[str], units: str = "emission_units") -> DataFrame:
    """One row per unit with the general fields repeated; a document without units keeps one row with null units."""
    keep = [c for c in df.columns if c != document]
    d = df.select(*keep, *[F.col(f"{document}.{g}").alias(g) for g in general], F.explode_outer(f"{document}.{units}").alias("__unit"))
    return d.select(*keep, *general, "__unit.*")


def rebuilt(df: DataFrame, key: str, general: list[str], unit: list[str], order: str, units: str = "emission_units") -> DataFrame:
    """Rows grouped back to documents: general fields by the first row, units in order, all-empty units left out. A
    document is one value; files beyond the size of a value must be split first."""
    some = F.coalesce(*unit).isNotNull()
    row = F.when(some, F.struct(order, *unit))
    g = df.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in general], F.array_sort(F.collect_list(row)).alias("__u"))
    return g.select(key, *general, F.transform("__u", lambda x: F.struct(*[x[u].alias(u) for u in unit])).alias(units))


def chunk_spans(text: str, most: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of chunks of at most ``most`` characters: broken in the last fifth at the last blank line, else
    newline, else space, else at the limit; each begins ``overlap`` before the end of the one before."""
    out, start, n = [], 0, len(text)
    while True:
        end = start + most
        if end >= n:
            out.append((start, n))
            return out
        low = start + int(most * 0.8)
        at = next((p for s in ("\n\n", "\n", " ") if (p := text.rfind(s, low, end)) >= 0), end)
        out.append((start, at))
        start = max(at - overlap, start + 1)


def chunked(df: DataFrame, id_col: str, text: str, most: int = MAX_CHUNK, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(id, chunk from 0, start, end, text) of every non-null text."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, k, a, b, t[a:b]) for i, t in zip(pdf["id"], pdf["text"]) for k, (a, b) in enumerate(chunk_spans(t, most, overlap))]
            yield pd.DataFrame(rows, columns=["id", "chunk", "start", "end", "text"])

    d = df.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return d.mapInPandas(run, f"id {kind}, chunk int, start int, end int, text string")


def halved_until(df: DataFrame, fits: Column, text: str = "text", least: int = 10_000) -> DataFrame:
    """Chunks whose ``fits`` is false are halved, and again, until they fit or are too short to give halves of ``least``
    characters; the longest text says how often that can be."""
    out = None
    longest = df.agg(F.max(F.length(text))).first()[0] or 0
    rounds = 1
    while longest >> rounds >= least:
        rounds += 1
    todo = df.withColumn("__rounds", F.lit(0))
    for r in range(rounds):
        ok = todo.where(fits | (F.length(text) < 2 * least))
        out = ok if out is None else out.unionByName(ok)
        half = F.floor(F.length(text) / 2).cast("int")
        parts = F.array(F.substring(text, F.lit(1), half), F.substring(F.col(text), half + 1, F.length(text)))
        todo = todo.where(~(fits | (F.length(text) < 2 * least))).withColumn(text, F.explode(parts)).withColumn("__rounds", F.lit(r + 1))
    return out.unionByName(todo).withColumnRenamed("__rounds", "halvings")
