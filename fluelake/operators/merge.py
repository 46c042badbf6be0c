"""Merges of extraction runs. Keys join by hash or merge as Catalyst sees fit; none is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluelake.functions.blank import is_blank
from fluelake.operators.dedup import last_by

EMPTY = ["", "nan", "none", "null"]


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows of the keys that come in are dropped, the new rows appended; missing columns are null."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows of keys the old rows do not have."""
    return old.unionByName(new.join(old.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def select_source(newer: DataFrame, older: DataFrame, key: str, tag: str, names: tuple[str, str], backfill: dict[str, str], order: str) -> DataFrame:
    """The newer run wins per key, the older one fills the absent keys; ``tag`` names the run. A blank of a ``backfill``
    column takes the older run's first value of the key, in the given order, that is not blank, or the given text."""
    known = older.groupBy(key).agg(*[F.min_by(c, F.when(~is_blank(F.col(c), EMPTY), F.col(order))).alias(f"__{c}") for c in backfill])
    stated = lambda c: F.when(~is_blank(F.col(c), EMPTY), F.col(c))
    a = newer.join(known, key, "left").withColumns({c: F.coalesce(stated(c), f"__{c}", F.lit(text)) for c, text in backfill.items()}).drop(*[f"__{c}" for c in backfill])
    b = older.join(newer.select(key).distinct(), key, "left_anti")
    return a.withColumn(tag, F.lit(names[0])).unionByName(b.withColumn(tag, F.lit(names[1])), allowMissingColumns=True)


def replace_carrying(old: DataFrame, new: DataFrame, key: str, order: str, carried: list[str]) -> DataFrame:
    """``replace_by_key`` in which the new rows take, per key, the old rows' first non-null values of some columns."""
    first = old.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__{c}") for c in carried])
    n = new.drop(*carried).join(first, key, "left").withColumnsRenamed({f"__{c}": c for c in carried})
    return replace_by_key(old, n, key)


def additive(old: DataFrame, new: DataFrame, file: str, unit: Column, status: str, success: str = "Success", empty: str = "Success (No Units Found)") -> DataFrame:
    """Nothing found is lost: files that had succeeded keep their rows and gain new units only; files that had failed
    are replaced; the row that says a file has no units goes once it has some, and comes in only for replaced files
    without any. Files of the old rows only pass through."""
    scope = new.select(file).distinct()
    passed = old.join(scope, file, "left_anti")
    inside = old.join(scope, file, "left_semi")
    good = inside.where(F.col(status).startswith("Success")).select(file).distinct()
    failed = scope.join(good, file, "left_anti")
    old_units = inside.where(F.col(status) == success).withColumn("__unit", unit)
    new_units = new.where(F.col(status) == success).withColumn("__unit", unit)
    fresh = new_units.join(failed, file, "left_semi").unionByName(new_units.join(failed, file, "left_anti").join(old_units.select(file, "__unit").distinct(), [file, "__unit"], "left_anti"))
    gaining = fresh.select(file).distinct()
    with_units = old_units.select(file).unionByName(gaining).distinct()
    kept = inside.join(failed, file, "left_anti")
    kept = kept.where(~F.col(status).eqNullSafe(F.lit(empty))).unionByName(kept.where(F.col(status) == empty).join(with_units, file, "left_anti"))
    placeholders = new.where(F.col(status) == empty).join(failed, file, "left_semi").join(gaining, file, "left_anti")
    return passed.unionByName(kept).unionByName(fresh.drop("__unit")).unionByName(placeholders)


def merge_chunks(chunks: DataFrame, document: str, order: list[str], general: list[str], unit: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """General fields by the first non-null value in chunk order; units once per key, the version with the most
    non-null fields, of equals the first."""
    at = F.struct(*order)
    head = chunks.groupBy(document).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in general])
    filled = sum((F.when(F.col(f).isNotNull(), 1).otherwise(0) for f in fields[1:]), F.when(F.col(fields[0]).isNotNull(), 1).otherwise(0))
    units = last_by(chunks.where(F.col(unit).isNotNull()), [F.col(document), F.col(unit)], filled, *[-F.col(o) for o in order])
    return head, units


def key_sets(old: DataFrame, new: DataFrame, group: str, key: str) -> DataFrame:
    """(group, shared, added, old_only): counts of keys per group over both sides."""
    a = old.select(group, key).distinct().withColumn("o", F.lit(1))
    b = new.select(group, key).distinct().withColumn("n", F.lit(1))
    j = a.join(b, [group, key], "full_outer").na.fill(0, ["o", "n"])
    n = lambda o, w: F.sum(F.when((F.col("o") == o) & (F.col("n") == w), 1).otherwise(0))
    return j.groupBy(group).agg(n(1, 1).alias("shared"), n(0, 1).alias("added"), n(1, 0).alias("old_only"))
