"""Bins and samples that a rerun repeats: ranks by hash, edges by exact quantiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantile_bins(df: DataFrame, value: str, q: int) -> DataFrame:
    """``bin`` 1 to q by interpolated quantile edges, right-closed; the edges are one small row."""
    edges = df.agg(F.percentile(value, F.array(*[F.lit(i / q) for i in range(1, q)])).alias("edges"))
    d = df.join(F.broadcast(edges), F.lit(True))
    n = reduce(lambda w, i: w.when(F.col(value) <= F.col("edges")[i], i + 1), range(1, q - 1), F.when(F.col(value) <= F.col("edges")[0], 1)).otherwise(q)
    return d.withColumn("bin", n).drop("edges")


def ranked(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``out``: the row's place from 0 in a total order, without gathering all rows in one task: rows are sorted by
    range partitions, counted, and numbered within their partition from the count of those before."""
    names = [f"__o{i}" for i in range(len(order))]
    d = df.withColumns(dict(zip(names, order)))
    s = d.repartitionByRange(*names).sortWithinPartitions(*names).withColumn("__p", F.spark_partition_id())
    s = s.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy(*names)) - 1)
    from fluelake.runtime import cut

    s = cut(s)  # partition numbers must not change between the count and the numbering
    sizes = s.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))  # one row a partition
    return s.join(F.broadcast(before), "__p").withColumn(out, F.col("__r") + F.col("__b")).drop("__p", "__r", "__b", *names)


def positional_bins(df: DataFrame, order: list[Column], q: int) -> DataFrame:
    """``bin`` 1 to q of the ordered rows, cut before places floor(k * n / q)."""
    d = ranked(df, order, "__place")
    n = d.agg(F.count("*").alias("__total"))
    past = [F.when(F.col("__place") >= F.floor(F.lit(k) * F.col("__total") / q), 1).otherwise(0) for k in range(1, q)]
    return d.join(F.broadcast(n), F.lit(True)).withColumn("bin", reduce(lambda a, b: a + b, past) + 1).drop("__place", "__total")


def hash_order(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key)))


def quotas(counts: DataFrame, n: int) -> DataFrame:
    """``quota`` of each stratum: its rounded share of n, at least one."""
    total = counts.agg(F.sum("n").alias("t"))
    return counts.join(F.broadcast(total), F.lit(True)).withColumn("quota", F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("n") / F.col("t") + 0.5))).drop("t", "n")


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: str) -> DataFrame:
    """About n rows, each stratum's quota of least hashes; only the quota's rows of a stratum are ever ranked together:
    a first cut by hash range keeps a hot stratum from one task's sort."""
    q = quotas(df.groupBy(stratum).agg(F.count("*").alias("n")), n)
    d = df.withColumn("__h", hash_order(key, seed)).join(F.broadcast(q), stratum)
    near = Window.partitionBy(stratum, F.substring("__h", 1, 1)).orderBy("__h", key)
    d = d.withColumn("__k", F.row_number().over(near)).where(F.col("__k") <= F.col("quota"))
    d = d.withColumn("__k", F.row_number().over(Window.partitionBy(stratum).orderBy("__h", key))).where(F.col("__k") <= F.col("quota"))
    return d.drop("__h", "__k", "quota")


def simple(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """The n rows of least hash."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def repaired(quota: dict[str, int], counts: dict[str, int], n: int) -> dict[str, int]:
    """Quotas (a small table, one entry a stratum) brought to the sum n: the greatest quota gives, the most numerous
    stratum takes, ties in order; none under one or over its stratum."""
    q = dict(quota)
    while sum(q.values()) > n and max(q.values()) > 1:
        q[min((k for k in q if q[k] > 1), key=lambda k: (-q[k], k))] -= 1
    while sum(q.values()) < min(n, sum(counts.values())):
        q[min((k for k in q if q[k] < counts[k]), key=lambda k: (-counts[k], k))] += 1
    return q
