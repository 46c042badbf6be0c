"""Consensus of annotators' labels by minimax conditional entropy.

Annotator j answers k on an item whose true label is c with probability proportional to
exp(sigma[j, field] * (k == c) + tau[item, c, k]): annotators tilt towards the truth by their reliability, items tilt
towards the answers they invite. The regularised dual is climbed by coordinates, tau within each item, sigma over all
items, alternating with the label posteriors. sigma of a field is drawn to the annotator's mean over fields, tau to
zero. An item's answers are what annotators gave, and one more that stands for any answer nobody gave.

Rounds are one pass each over the item table, which is written once to the shared folder; what leaves a task is three
sums per annotator and field. The ascent ends when no sigma moves by TOLERANCE any more; from round SETTLE on steps
shrink with the round, so that it ends on any data. The last move of each sigma is reported beside it.

Defined results. Blank and filler answers and null items, fields or annotators are no votes; an item without votes
gives no row. Of several sheets of an annotator for an item the one recorded last counts, of equally late ones the
highest id. A single vote is its item's consensus. Ties go to the alphabetically first label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluelake.functions.blank import is_blank
from fluelake.runtime import cut, squashed

TOLERANCE, SETTLE, TAU_STEPS = 0.02, 20, 3
#: Strength of the pulls on sigma (to the annotator's mean, and of that to START) and on tau.
PULL_SIGMA, PULL_TAU, START = 4.0, 6.0, 1.5
#: Annotator-field pairs whose sigma is sent to every worker; with more of them it is joined to the votes instead.
MOST_PAIRS = 200_000


def normalised(answer: Column) -> Column:
    """Lower case, trimmed, single spaces; dates as yyyy-MM-dd; null for a blank or filler answer."""
    t = squashed(answer)
    formats = ["MM/dd/yyyy", "M/d/yyyy", "yyyy/MM/dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMM yyyy"]
    shapes = [r"^\d\d/\d\d/\d{4}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{4}/\d\d/\d\d$", r"^[a-z]{4,} \d{1,2}, \d{4}$", r"^[a-z]{3} \d{1,2}, \d{4}$", r"^\d{1,2} [a-z]{3} \d{4}$"]
    cased = F.initcap(t)
    dates = [F.when(t.rlike(s), F.try_to_date(cased, f)) for s, f in zip(shapes, formats)]
    date = F.when(t.rlike(r"\d{4}"), F.date_format(F.coalesce(*dates), "yyyy-MM-dd"))  # every form has a year
    return F.when(~is_blank(answer), F.coalesce(date, t))


def votes(sheets: DataFrame, item="filename", annotator="reviewer", when="recorded_at", order="record_id", answers="field_summary") -> DataFrame:
    """(item, annotator, field, label) of the last sheet of each annotator for each item."""
    d = sheets.where(F.col(item).isNotNull() & F.col(annotator).isNotNull())
    last = F.struct(F.col(when).isNotNull().alias("known"), F.col(when).alias("at"), F.col(order).alias("id"))
    values = F.transform_values(answers, lambda k, v: v["chosen_value"])
    one = d.groupBy(F.col(item).alias("item"), F.col(annotator).alias("annotator")).agg(F.max_by(values, last).alias("values"))
    v = one.select("item", "annotator", F.explode("values").alias("field", "answer"))
    return v.select("item", "annotator", "field", normalised(F.col("answer")).alias("label")).where("label is not null")


def _tables(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Items of equally many votes and answers together: answer index and presence, per item and vote."""
    for (v, k), part in pdf.groupby([pdf["x"].map(len), pdf["labels"].map(len)], sort=False):
        step = max(1, 4_000_000 // (int(v) * int(k + 1) ** 2))
        for a in range(0, len(part), step):
            p = part.iloc[a : a + step]
            yield p, np.stack([np.asarray(x) for x in p["x"]]), int(k)


def _solve(x: np.ndarray, k: int, sigma: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (item, c) and the chance (item, vote, c) that a vote is right where c is true.

    x: answer indices (item, vote); sigma: of the vote's annotator, same shape."""
    n, v = x.shape
    hit = x[:, :, None] == np.arange(k)[None, None, :]  # vote gives answer
    count = hit.sum(axis=1).astype(float)
    q = count / count.sum(axis=1, keepdims=True)
    tau = np.zeros((n, k, k + 1))
    own = np.arange(k)
    for s in range(steps + 1):
        e = np.exp(tau)  # item, c, answer
        diagonal = e[:, own, own]
        rest = e.sum(axis=2) - diagonal
        right = np.exp(sigma)[:, :, None] * diagonal[:, None, :]
        total = right + rest[:, None, :]  # item, vote, c
        p_right = right / total
        given = np.take_along_axis(tau.transpose(0, 2, 1), np.broadcast_to(x[:, :, None], (n, v, k)), axis=1)  # tau[c, x]
        log_q = (given + sigma[:, :, None] * hit - np.log(total)).sum(axis=1)
        q = np.exp(log_q - log_q.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        if s == steps:
            break
        share = (1 / total).sum(axis=1)[:, :, None] * e  # expected counts of the answers, for the wrong ones
        share[:, own, own] = p_right.sum(axis=1)
        seen = np.concatenate([np.broadcast_to(count[:, None, :], (n, k, k)), np.zeros((n, k, 1))], axis=2)
        gradient = q[:, :, None] * (seen - share) - PULL_TAU * tau
        curve = q[:, :, None] * share * (1 - share / v) + PULL_TAU
        tau = np.clip(tau + gradient / curve, -4, 4)
    return q, p_right


def _items(v: DataFrame) -> DataFrame:
    """(item, field, labels sorted, x, annotators): one row an item; a row holds one vote of each of its annotators."""
    g = v.groupBy("item", "field").agg(F.collect_list(F.struct("annotator", "label")).alias("votes"))
    g = g.withColumn("votes", F.sort_array("votes")).withColumn("labels", F.array_sort(F.array_distinct("votes.label")))
    x = F.transform("votes", lambda z: F.array_position(F.col("labels"), z["label"]).cast("int") - 1)
    return g.select("item", "field", "labels", x.alias("x"), F.col("votes.annotator").alias("annotators"))


def _look_up(items: DataFrame, sigma: DataFrame, most: int):
    """The items with their votes' sigma, and how a worker reads it: a sent table if it is small, else a join."""
    rows = sigma.limit(most + 1).collect()
    if len(rows) <= most:
        sent = items.sparkSession.sparkContext.broadcast({(r.annotator, r.field): r.sigma for r in rows})

        def read(p: pd.DataFrame) -> np.ndarray:
            who, names, what, fields = _codes(p)
            table = np.array([[sent.value.get((a, f), START) for f in fields] for a in names])
            return table[who, what]

        return items, read
    one = items.select("item", "field", F.posexplode("annotators").alias("pos", "annotator")).join(sigma, ["annotator", "field"], "left")
    one = one.groupBy("item", "field").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("sigma", F.lit(START)).alias("s")))).alias("s"))
    return items.join(one.select("item", "field", F.col("s.s").alias("sigma")), ["item", "field"]), lambda p: np.stack([np.asarray(s) for s in p["sigma"]])


def _codes(p: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (item, vote) of the votes' annotators and their names, and the same of the fields."""
    who, names = pd.factorize(np.concatenate(p["annotators"].to_list()))
    what, fields = pd.factorize(p["field"].to_numpy(object))
    who = who.reshape(len(p), -1)
    return who, names, np.broadcast_to(what[:, None], who.shape), fields


def fitted(items: DataFrame, tolerance: float = TOLERANCE, most: int = MOST_PAIRS) -> DataFrame:
    """(annotator, field, votes, sigma, change, reliability): tilts after the ascent, the last move of each, and the
    expected share of right answers."""
    pairs = cut(items.select("field", F.explode("annotators").alias("annotator")).groupBy("annotator", "field").agg(F.count("*").alias("votes")))
    sigma = pairs.withColumns({"sigma": F.lit(START), "change": F.lit(0.0), "reliability": F.lit(0.0)})
    done = 0
    while True:
        table, read = _look_up(items, sigma.select("annotator", "field", "sigma"), most)
        steps = 0 if done == 0 else TAU_STEPS

        def sums(batches: Iterator[pd.DataFrame], read=read, steps=steps) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for p, x, k in _tables(pdf):
                    q, right = _solve(x, k, read(p), steps)
                    mine = np.take_along_axis(q, x, axis=1)
                    expected = (q[:, None, :] * right).sum(axis=2)
                    spread = (q[:, None, :] * right * (1 - right)).sum(axis=2)
                    who, names, what, fields = _codes(p)
                    pair = (who * len(fields) + what).ravel()
                    n = len(names) * len(fields)
                    there = np.flatnonzero(np.bincount(pair, minlength=n))
                    added = {c: np.bincount(pair, z.ravel(), n)[there] for c, z in (("mine", mine), ("expected", expected), ("spread", spread))}
                    yield pd.DataFrame({"annotator": names[there // len(fields)], "field": fields[there % len(fields)], **added})

        part = table.mapInPandas(sums, "annotator string, field string, mine double, expected double, spread double")
        total = part.groupBy("annotator", "field").agg(F.sum("mine").alias("mine"), F.sum("expected").alias("expected"), F.sum("spread").alias("spread"))
        mean = sigma.groupBy("annotator").agg(((F.sum("sigma") + START) / (F.count("*") + 1)).alias("mean"))
        step = (F.col("mine") - F.col("expected") - PULL_SIGMA * (F.col("sigma") - F.col("mean"))) / (F.col("spread") + PULL_SIGMA)
        step = F.greatest(F.lit(-1.5), F.least(F.lit(1.5), step)) * min(1.0, SETTLE / (done + 1))
        new = F.greatest(F.lit(-3.0), F.least(F.lit(8.0), F.col("sigma") + step))
        d = sigma.select("annotator", "field", "votes", "sigma").join(total, ["annotator", "field"]).join(mean, "annotator")
        sigma = cut(d.select("annotator", "field", "votes", new.alias("sigma"), F.abs(new - F.col("sigma")).alias("change"), (F.col("mine") / F.col("votes")).alias("reliability")))
        done += 1
        moved = sigma.agg(F.max("change")).first()[0]
        if moved is None or (done > 1 and moved < tolerance):
            return sigma


def consensus(items: DataFrame, sigma: DataFrame, most: int = MOST_PAIRS) -> DataFrame:
    """(item, field, label, posterior, votes, agreement): the label of highest posterior; agreement is the share of
    pairs of annotators who gave the same answer, apart from any model (null for a single vote)."""
    table, read = _look_up(items, sigma.select("annotator", "field", "sigma"), most)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, x, k in _tables(pdf):
                q, _ = _solve(x, k, read(p), TAU_STEPS)
                q = np.round(q, 9)
                best = q.argmax(axis=1)
                n = x.shape[1]
                count = (x[:, :, None] == np.arange(k)).sum(axis=1)
                same = (count * (count - 1)).sum(axis=1) / (n * (n - 1)) if n > 1 else np.full(len(x), np.nan)
                yield pd.DataFrame({"item": p["item"].to_numpy(object), "field": p["field"].to_numpy(object), "label": [names[b] for names, b in zip(p["labels"], best)], "posterior": q[np.arange(len(x)), best], "votes": n, "agreement": same})

    d = table.mapInPandas(answer, "item string, field string, label string, posterior double, votes int, agreement double")
    return d.withColumn("agreement", F.nanvl("agreement", F.lit(None).cast("double")))


def run(sheets: DataFrame, tolerance: float = TOLERANCE, **columns) -> tuple[DataFrame, DataFrame]:
    """(consensus per item and field, annotators with sigma and reliability)."""
    items = cut(_items(votes(sheets, **columns)))
    sigma = fitted(items, tolerance)
    return consensus(items, sigma), sigma


def field_agreement(found: DataFrame) -> DataFrame:
    """(field, items, observed, unanimous): the mean agreement of items with two or more votes."""
    d = found.where("votes > 1")
    return d.groupBy("field").agg(F.count("*").alias("items"), F.avg("agreement").alias("observed"), F.avg(F.when(F.col("agreement") == 1, 1.0).otherwise(0.0)).alias("unanimous"))
