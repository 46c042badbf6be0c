"""Approximate joins and geometric predicates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def indel_ratio(a: str, b: str) -> float:
    """100 times the share of characters in the longest common subsequence of two strings."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """The greatest ratio among the shared words and the shared words with either side's rest, each sorted."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (" ".join(filter(None, [both, " ".join(sorted(s))])) for s in (x - y, y - x))
    if both and (one == both or two == both):
        return 100.0
    return max(indel_ratio(both, one), indel_ratio(both, two), indel_ratio(one, two)) if both else indel_ratio(one, two)


def blocked_fuzzy(left: DataFrame, right: DataFrame, block: str, name: str, threshold: float = 93.0, shortest: int = 6) -> DataFrame:
    """(block, name, matched, score, type): each distinct left name matched to at most one right name of its block:
    the equal one, else the one of the best token-set ratio from ``threshold`` on, of equals the first.

    Candidates share their rarest word, or one of the rarest three-letter runs that a pair within the threshold must
    share; no block is compared all against all. Blank names match nothing; null blocks are no block."""
    a = left.select(F.col(block).alias("block"), F.col(name).alias("name")).where("name <> '' and block is not null").distinct()
    b = right.select(F.col(block).alias("block"), F.col(name).alias("other")).where("other <> '' and block is not null").distinct()
    exact = a.join(b.select("block", F.col("other").alias("name")), ["block", "name"], "left_semi").select("block", "name", F.col("name").alias("matched"), F.lit(100.0).alias("score"), F.lit("exact").alias("type"))
    rest = a.join(b.select("block", F.col("other").alias("name")), ["block", "name"], "left_anti").where(F.length("name") >= shortest)

    def keys(d: DataFrame, c: str) -> DataFrame:
        words = F.transform(F.array_distinct(F.split(c, " ")), lambda w: F.concat(F.lit("w "), w))
        flat = F.concat(F.lit(" "), F.col(c), F.lit(" "))
        grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(flat) - 2), lambda i: F.concat(F.lit("g "), F.substring(flat, i, F.lit(3)))))
        return d.select("block", c, F.explode(F.concat(words, grams)).alias("key"))

    ka, kb = keys(rest, "name"), keys(b, "other")
    rarity = ka.select("block", "key").unionByName(kb.select("block", "key")).groupBy("block", "key").agg(F.count("*").alias("f"))

    def rare(k: DataFrame, c: str) -> DataFrame:
        """Of each name the rarest word, and as many of the rarest runs as the allowed edits can spoil, plus one."""
        g = k.join(rarity, ["block", "key"]).groupBy("block", c).agg(F.array_sort(F.collect_list(F.struct("f", "key"))).alias("all"))
        words = F.slice(F.filter("all", lambda x: x["key"].startswith("w ")), 1, 1)
        n = (F.floor(F.length(c) * 2 * (100 - threshold) / 100 + 1) * 3 + 1).cast("int")
        grams = F.slice(F.filter("all", lambda x: x["key"].startswith("g ")), F.lit(1), n)
        return g.select("block", c, F.explode(F.concat(words, grams)).alias("x")).select("block", c, F.col("x.key").alias("key"))

    # the rare keys of either side against all of the other's: a word set inside another is found from its own side
    pairs = rare(ka, "name").join(kb, ["block", "key"]).select("block", "name", "other").unionByName(ka.join(rare(kb, "other"), ["block", "key"]).select("block", "name", "other")).distinct()

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([token_set_ratio(i, j) for i, j in zip(x, y)], dtype=float)

    good = pairs.withColumn("score", score("name", "other")).where(F.col("score") >= threshold)
    best = good.groupBy("block", "name").agg(F.min(F.struct((-F.col("score")).alias("s"), "other")).alias("b"))
    fuzzy = best.select("block", "name", F.col("b.other").alias("matched"), (-F.col("b.s")).alias("score"), F.lit("fuzzy").alias("type"))
    return exact.unionByName(fuzzy)


def inside_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Whether a point lies in a polygon, by crossings of a ray to the right; the bounding box comes first, so that
    it reaches the scan as a filter."""
    box = x.between(min(c[0] for c in corners), max(c[0] for c in corners)) & y.between(min(c[1] for c in corners), max(c[1] for c in corners))
    crossings = []
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        if y1 != y2:
            crossings.append(F.when(((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < (y - y1) * ((x2 - x1) / (y2 - y1)) + x1), 1).otherwise(0))
    return box & (reduce(lambda a, b: a + b, crossings) % 2 == 1)
