"""One row, or the tied rows, of each key by an order.

Every operator takes an explicit total order, so that a rerun or another partitioning gives the same rows. Where one row
is enough it is found by an aggregate that combines before the shuffle, so that a hot key never meets whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluelake.runtime import input_name


def _one(df: DataFrame, keys: list[Column], order: Column, last: bool) -> DataFrame:
    k = [input_name(f"__k{i}", df.columns) for i in range(len(keys))]
    row = F.struct(*df.columns)
    pick = (F.max_by if last else F.min_by)(row, order)
    out = df.groupBy(*[c.alias(n) for c, n in zip(keys, k)]).agg(pick.alias("__row"))
    return out.select("__row.*")


def last_by(df: DataFrame, keys: list[Column], *order: Column) -> DataFrame:
    """Of each key (null is a key) the row with the greatest order; null counts as least."""
    return _one(df, keys, F.struct(*[F.struct(o.isNotNull(), o) for o in order]), True)


def first_by(df: DataFrame, keys: list[Column], *order: Column) -> DataFrame:
    """Of each key (null is a key) the row with the least order; null counts as greatest."""
    return _one(df, keys, F.struct(*[F.struct(o.isNull(), o) for o in order]), False)


def keep_latest(df: DataFrame, keys: list[Column], date: Column, *ties: Column) -> DataFrame:
    """Of each key the row of the latest date, null dates last, then by the greatest ties."""
    return last_by(df, keys, date, *ties)


def keep_all_of_best(df: DataFrame, keys: list[Column], best: Column, group: Column) -> DataFrame:
    """All rows of the one group (a file, say) that wins a key: greatest ``best``, of equals the greatest group name."""
    k = [input_name(f"__k{i}", df.columns) for i in range(len(keys))]
    d = df.withColumns(dict(zip(k, keys)) | {"__best": best, "__group": group})
    winner = d.groupBy(*k).agg(F.max(F.struct(F.col("__best").isNotNull(), "__best", "__group")).alias("__w"))
    w = winner.select(*[F.col(x).alias(f"w{x}") for x in k], F.col("__w.__group").alias("__won"))
    same = [d[x].eqNullSafe(w[f"w{x}"]) for x in k] + [d["__group"].eqNullSafe(w["__won"])]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return d.join(w, on, "left_semi").drop(*k, "__best", "__group")


def keep_ties(df: DataFrame, keys: list[Column], value: Column) -> DataFrame:
    """All rows of each key whose value is the key's greatest; keys without a value keep nothing."""
    top = input_name("__top", df.columns)
    names = [input_name(f"__k{i}", df.columns) for i in range(len(keys))]
    d = df.withColumns({n: k for n, k in zip(names, keys)} | {top: value})
    best = d.groupBy(*names).agg(F.max(top).alias(top)).where(F.col(top).isNotNull())  # combined before the shuffle
    on = [d[n].eqNullSafe(best[n]) for n in names] + [d[top] == best[top]]
    return d.join(best, on, "left_semi").drop(*names, top)


def tiered(df: DataFrame, keys: list[Column], tier: Column, *order: Column) -> DataFrame:
    """Of each key the row of the highest tier, then of the greatest order."""
    return last_by(df, keys, tier, *order)


def latest_or_keyless(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The last row of each key, and every row whose key is null or empty."""
    keyless = key.isNull() | (key == "")
    return last_by(df.where(~keyless), [key], *order).unionByName(df.where(keyless))
