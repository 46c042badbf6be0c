"""Quality checks of extracted records."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from fluelake.functions.text import strip

# Rules of required, length, pattern and number per field.
RULES = {
    "facility_name": {"required": True, "least": 1, "most": 200, "pattern": r"^[a-zA-Z0-9\s\-\.&,()]+$"},
    "permit_number": {"required": True, "least": 3, "most": 50, "pattern": r"^[A-Z0-9\-]+$"},
    "facility_address": {"required": True, "least": 5, "most": 200},
    "issuance_date": {"required": True, "pattern": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"},
    "expiration_date": {"required": True, "pattern": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"},
    "naics_code": {"pattern": r"^[0-9]{6}$"},
    "unit_id": {"required": True, "least": 1, "most": 20, "pattern": r"^[A-Z0-9\-]+$"},
    "capacity_value": {"number": True},
    "year_of_manufacture": {"pattern": r"^(19|20)[0-9]{2}$"},
}
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Forms and words of values that may be made up (the doubled alternative is as it must be).
SUSPICIOUS = [r"^(test|example|sample|demo|placeholder)", r"^(lorem|ipsum)", r"^(xxx|xxx|zzz)", r"^(n/a|na|none|null|undefined)"]
GENERIC = ["unknown", "not specified", "tbd", "to be determined"]
ROWS_AT_ONCE = 64  # turned into Python objects together


def rule_errors(rules: dict[str, dict] = RULES) -> Column:
    """Names of the fields that break their rule, in the rules' order."""
    out = []
    for f, r in rules.items():
        c = F.col(f)
        missing = c.isNull() | (c == "")
        bad = [F.length(c) < r["least"]] if "least" in r else []
        bad += [F.length(c) > r["most"]] if "most" in r else []
        bad += [~c.rlike(r["pattern"])] if "pattern" in r else []
        bad += [~c.rlike(NUMBER)] if r.get("number") else []
        broken = reduce(lambda a, b: a | b, bad)
        out.append(F.when(F.when(missing, F.lit(bool(r.get("required")))).otherwise(broken), F.lit(f)))
    return F.array_compact(F.array(*out))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of the distinct words; 0 if a side is empty."""
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    both, either = F.size(F.array_intersect(words(a), words(b))), F.size(F.array_union(words(a), words(b)))
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.coalesce(F.try_divide(both, either), F.lit(0.0)))


def match_type(extracted: Column, truth: Column) -> Column:
    """exact, partial (over 0.8 of the words), different, missing or extra."""
    a, b = F.lower(strip(extracted)), F.lower(strip(truth))
    return (
        F.when(extracted.isNull() & truth.isNull(), "exact").when(extracted.isNull(), "missing").when(truth.isNull(), "extra")
        .when(a == b, "exact").when(jaccard(a, b) > 0.8, "partial").otherwise("different")
    )


def accuracy(types: list[Column]) -> Column:
    """Exact as one, partial as a half, over all fields."""
    return reduce(lambda a, b: a + b, [F.when(t == "exact", 1.0).when(t == "partial", 0.5).otherwise(0.0) for t in types]) / len(types)


def found_in(values: list[bytes], texts: list[bytes], few: int = 200) -> list[bytes]:
    """The values that stand in any of the texts: up to ``few`` are sought one by one, more by an automaton of them all,
    which reads each text once whatever their number. Bytes are read as letters, one each."""
    if len(values) <= few:
        return [v for v in values if any(v in t for t in texts)]
    automaton = ahocorasick.Automaton()
    for v in values:
        if v:
            automaton.add_word(v.decode("latin-1"), v)
    automaton.make_automaton()
    found = {v for t in texts for _, v in automaton.iter(t.decode("latin-1"))}
    return [v for v in values if v in found or (not v and texts)]


def stated_in(values: DataFrame, texts: DataFrame, key: str, value: str, text: str, block: int = 50_000, most_bytes: int = 4_000_000) -> DataFrame:
    """(key, value): the values, in lower case, that stand in any text of their key. A key's values meet its texts in
    parts of about ``block`` values and ``most_bytes`` of text, so that a hot key is no single task; a part costs its
    values and its texts once each, not their product. Keys of several parts are few (each has more than a part holds),
    so their numbers of parts are broadcast."""
    v = values.select(key, F.lower(value).cast("binary").alias(value)).where(F.col(key).isNotNull() & F.col(value).isNotNull()).distinct()
    t = texts.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.lower(text).alias("__text"))
    blocks = v.groupBy(key).agg(F.ceil(F.count("*") / block).alias("__blocks")).where("__blocks > 1")
    parts = t.groupBy(key).agg(F.ceil(F.sum(F.octet_length("__text")) / most_bytes).alias("__parts")).where("__parts > 1")
    part = lambda x, n: F.pmod(F.xxhash64(x), F.coalesce(F.col(n), F.lit(1)))
    v = v.join(F.broadcast(blocks), key, "left").groupBy(key, part(value, "__blocks").alias("__block")).agg(F.collect_list(value).alias("__values"))
    v = v.join(F.broadcast(parts), key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("__parts"), F.lit(1)) - 1)))
    t = t.join(F.broadcast(parts), key, "left").groupBy(key, part("__text", "__parts").alias("__part")).agg(F.collect_set("__text").cast("array<binary>").alias("__texts"))
    met = t.join(v, [key, "__part"]).select(key, "__values", "__texts")
    kind = met.schema[key].dataType
    form = to_arrow_schema(StructType([StructField(key, kind), StructField(value, BinaryType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(a, ROWS_AT_ONCE)
                found = [found_in(x.as_py(), y.as_py()) for x, y in zip(rows.column(1), rows.column(2))]
                keys = rows.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
                yield pa.RecordBatch.from_arrays([keys.cast(form.field(0).type), pa.array([x for f in found for x in f], pa.binary())], schema=form)

    found = met.mapInArrow(run, StructType([StructField(key, kind), StructField(value, BinaryType())]))
    return found.select(key, F.col(value).cast("string").alias(value)).distinct()


def invention_risk(field: str, value: Column, stated: Column) -> Column:
    """0 to 1, ``stated`` being whether a text of the file has the value: not in the text .3, a suspicious form .4 each, a generic word .2, an unlikely value .3."""
    low = F.lower(value)
    unlikely = F.lit(False)
    if "date" in field:
        unlikely = ~value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    elif "year" in field:
        unlikely = ~F.coalesce(F.when(value.rlike("^[0-9]+$"), value.try_cast("bigint")).between(1900, 2030), F.lit(False))
    elif "capacity" in field:
        n = F.when(value.rlike(NUMBER), F.trim(value).try_cast("double"))
        unlikely = F.coalesce((n <= 0) | (n > 10000), F.lit(False))
    tenths = F.when(stated, 0).otherwise(3)
    for p in SUSPICIOUS:
        tenths = tenths + F.when(low.rlike(p), 4).otherwise(0)
    tenths = tenths + F.when(low.isin(GENERIC), 2).otherwise(0) + F.when(unlikely, 3).otherwise(0)
    return F.when(strip(value) != "", F.least(tenths, F.lit(10)) / 10)


def present(c: Column) -> Column:
    return F.coalesce(strip(c) != "", F.lit(False))


def missing_shares(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, missing, share): one pass over the rows, then one row per field."""
    d = df.agg(F.count("*").alias("__n"), *[F.sum(F.when(present(F.col(f)), 0).otherwise(1)).alias(f) for f in fields])
    long = d.unpivot(["__n"], fields, "field", "missing")
    return long.select("field", "missing", F.round(F.col("missing") / F.col("__n"), 4).alias("share"))


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of keys that more than one row has: keys are counted first, so that a hot key is one row there."""
    n = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*keys)
    return df.join(n, keys, "left_semi")


# Words for equipment, the edges of text sizes, and when a long text with few units is suspect.
EQUIPMENT = r"(?i)\b(boiler|furnace|heater|oven|dryer|kiln|incinerator|turbine|engine|generator|melter|calciner|cracker|reformer)s?\b"
SIZE_EDGES = [0, 25_000, 50_000, 100_000, 150_000, 250_000, 400_000, 700_000, 10**9]
LEAST_CHARS, LEAST_MENTIONS, MOST_UNITS = 150_000, 40, 5


def recall_by_size(sized: DataFrame, edges: list[int] = SIZE_EDGES) -> DataFrame:
    """Units found by size of the text, of files (units, chars), in right-closed bins between the edges."""
    d = sized.where(F.col("chars") > edges[0])
    size = reduce(lambda w, i: w.when(F.col("chars") <= edges[i + 1], i + 1), range(1, len(edges) - 1), F.when(F.col("chars") <= edges[1], 1))
    d = d.withColumns({"bin": size, "rate": F.col("units") / (F.col("chars") / 1000)})
    return d.groupBy("bin").agg(F.count("*").alias("files"), F.percentile("units", F.lit(0.5)).alias("median_units"), F.round(F.avg("units"), 4).alias("mean_units"), F.percentile("units", F.lit(0.9)).alias("p90_units"), F.round(F.avg(F.when(F.col("units") <= 3, 1.0).otherwise(0.0)), 4).alias("few"), F.round(F.percentile("rate", F.lit(0.5)), 6).alias("median_rate"))


def recall_suspects(sized: DataFrame, least_chars: int = LEAST_CHARS, least_mentions: int = LEAST_MENTIONS, most_units: int = MOST_UNITS) -> DataFrame:
    """Long texts, of files (units, chars, mentions), that name much equipment and gave few units."""
    d = sized.where((F.col("chars") >= least_chars) & (F.col("mentions") >= least_mentions) & (F.col("units") <= most_units))
    return d.withColumn("per_unit", F.round(F.col("mentions") / F.greatest("units", F.lit(1)), 4))


# The fields that must agree, and the least share of unit fields.
KEY_FIELDS = [
    "Facility Name", "Facility Address", "Facility City", "Facility State Abbreviation", "Facility Zip Code", "Permit Number", "Permit Type", "Issuance Date",
    "Expiration Date", "Regulatory Authority", "Primary Applicable Regulations (e.g., Title V, PSD, NESHAP Subpart)",
]
LEAST_AGREEMENT = 0.7


def validation_decision(summary: Column, ratio: Column, succeeded: Column, failed: Column, fields: list[str] = KEY_FIELDS, least: float = LEAST_AGREEMENT) -> tuple[Column, Column]:
    """(status, reason): the first test that fails asks for review: fewer than two models succeeded, two or more failed,
    a key field needs review, too few unit fields agree (a null ratio is full agreement, as of no shared unit)."""
    tests = [(succeeded < 2, F.lit("Fewer than two models succeeded")), (failed >= 2, F.lit("Two or more models failed"))]
    tests += [(F.coalesce(F.try_element_at(summary, F.lit(f))["needs_review"], F.lit(False)), F.lit(f"General field '{f}' needs review")) for f in fields]
    shown = F.round(ratio.cast("decimal(12,6)"), 2).cast("string")
    tests.append((F.coalesce(ratio < least, F.lit(False)), F.concat(F.lit("Unit field agreement ratio "), shown, F.lit(f" < {least}"))))
    reason = reduce(lambda w, t: w.when(*t), tests[1:], F.when(*tests[0]))
    return F.when(reason.isNull(), "SUCCESS").otherwise("REVIEW_REQUIRED"), reason


def documents_with(df: DataFrame, key: str, file: str, test: Column) -> DataFrame:
    """``df`` with ``documents``, the number of distinct files of its key in which a row passes the test, 0 for none."""
    n = df.where(test).select(key, file).distinct().groupBy(key).agg(F.count("*").alias("documents"))
    return df.join(n, key, "left").na.fill(0, ["documents"])
