"""Descriptive statistics as plans of plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_with_other(df: DataFrame, label: str, count: str, n: int, other: str) -> DataFrame:
    """The n greatest counts by label, ties in order, and the sum of the rest under one label. One row per label comes in."""
    d = df.withColumn("__r", F.row_number().over(Window.orderBy(F.desc(count), label)))
    return d.groupBy(F.when(F.col("__r") <= n, F.col(label)).otherwise(F.lit(other)).alias(label)).agg(F.sum(count).alias(count))


def box_stats(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """Exact interpolated quantiles of the n groups with the most rows, positive values only."""
    d = df.where((F.col(value) > 0) & F.col(group).isNotNull())
    top = d.groupBy(group).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), group).limit(n)
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.025, 0.25, 0.5, 0.75, 0.975)]))
    g = d.join(F.broadcast(top.select(group)), group, "left_semi").groupBy(group).agg(F.count("*").alias("rows"), q.alias("q"))
    return g.select(group, "rows", *[F.col("q")[i].alias(c) for i, c in enumerate(("low", "q1", "middle", "q3", "high"))])


def median_of_counts(df: DataFrame, value: str, count: str) -> DataFrame:
    """``df`` (one row per value) with the running count and the flag of the value at which half is reached."""
    w = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumns({"running": F.sum(count).over(w), "__all": F.sum(count).over(Window.partitionBy(F.lit(1)))})
    reached = F.col("running") * 2 >= F.col("__all")
    before = (F.col("running") - F.col(count)) * 2 < F.col("__all")
    return d.withColumn("is_median", reached & before).drop("__all")


def coverage(df: DataFrame, group: str, matched: str) -> DataFrame:
    """(group, total, matched, coverage): null is a group."""
    return df.groupBy(group).agg(F.count("*").alias("total"), F.sum(F.col(matched).cast("bigint")).alias("matched")).withColumn("coverage", F.round(F.col("matched") / F.col("total"), 3))


def tier(share: Column, high: float = 0.7, low: float = 0.3) -> Column:
    return F.when(share >= high, "well-covered").when(share >= low, "partial").when(share.isNotNull(), "sparse").otherwise("")


def average_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank from 1, ties sharing their mean rank; via counts per distinct value, which alone are sorted together."""
    n = df.groupBy(value).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = n.select(F.col(value).alias("__v"), (before + (F.col("__n") + 1) / 2).alias(out))
    return df.join(r, df[value] == F.col("__v")).drop("__v")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, rho) over the rows that have both values."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    d = average_ranks(average_ranks(d, x, "__rx"), y, "__ry")
    return d.agg(F.count("*").alias("n"), F.corr("__rx", "__ry").alias("rho"))


def weighted_mean(df: DataFrame, value: str, weight: str) -> Column:
    return F.sum(F.col(value) * F.col(weight)) / F.sum(weight)


def crosstab(df: DataFrame, row: str, column: str, n: int) -> DataFrame:
    """(row, column, count, percent of the row) of the n commonest of either, 0 where they never meet."""
    top = lambda c: df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), c).limit(n).select(c)
    a, b = top(row), top(column)
    grid = a.join(F.broadcast(b), F.lit(True))  # n by n cells
    seen = df.join(F.broadcast(a), row, "left_semi").join(F.broadcast(b), column, "left_semi").groupBy(row, column).agg(F.count("*").alias("count"))
    d = grid.join(seen, [row, column], "left").na.fill(0, ["count"])
    total = F.sum("count").over(Window.partitionBy(row))
    return d.withColumn("percent", F.round(F.when(total > 0, 100 * F.col("count") / total).otherwise(0.0), 4))


def describe(df: DataFrame, value: str) -> DataFrame:
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.1, 0.5, 0.9)]))
    d = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("spread"), F.min(value).alias("least"), F.max(value).alias("most"), q.alias("q"))
    return d.select("n", F.round("mean", 4).alias("mean"), F.round("spread", 4).alias("spread"), "least", "most", *[F.col("q")[i].alias(c) for i, c in enumerate(("p10", "median", "p90"))])
