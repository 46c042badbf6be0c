"""Sources mixed to target shares of the tokens.

Token weights of the cells (source, language, topic) are raked by iterative proportional fitting to the source targets
and to the language and topic shares of the pool, no weight above the source's allowed repeats. Documents are then drawn
by the calibrated weights: a document of weight 2.3 occurs twice, and a third time with probability 0.3. The draw is
systematic over size, so that a source's tokens come out near their expectation, and depends on id and seed only.

The mix is as large as it can be with every present source at its target; shares of listed sources without tokens go to
the others in proportion.

Defined results. Documents of unlisted or null sources, and null and empty texts, are not in the mix. Null languages and
topics are a value of their own. A target of zero or null, or repeats under one, keep a source out. Repeated documents
are documents of their own. Without any usable source the mix is empty and every share 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluelake.llm.tokens import TOKENIZERS, VOCABULARY, token_count
from fluelake.runtime import cut

ROUNDS, SEED = 100, 17
#: Raking ends when no weight moves by this.
SETTLED = 1e-6
#: Documents of one source and size are drawn in parts of about so many, and in no fewer parts than SALTS.
PART, SALTS = 1_000_000, 64
#: Cells and targets raked in one array; with more of them the same steps run as grouped sums over the cluster.
MOST_CELLS = 200_000


def sized(documents: DataFrame, targets: DataFrame, id_col="doc_id", text="text", source="source", lang="lang", topic="section", folder=TOKENIZERS, vocabulary=VOCABULARY) -> DataFrame:
    """(id, source, lang, topic, tokens, bin): the documents of listed sources with any token."""
    listed = targets.where("target_share > 0 and max_repeats >= 1").select(F.col("source").alias("listed")).distinct()
    d = documents.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(topic).alias("topic"), F.col(text).alias("text"))
    d = d.where("text is not null and text <> ''").join(listed, F.col("source") == F.col("listed"), "left_semi")
    d = d.withColumn("tokens", token_count(documents, F.col("text"), folder, vocabulary)).drop("text").where("tokens > 0")
    return d.withColumn("bin", F.floor(F.log2("tokens") * 4).cast("int"))


def raked(tokens: np.ndarray, dims: list[np.ndarray], margins: list[np.ndarray], cap: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of cells: the first dimension's margins hold exactly where the caps let them, the others as nearly as
    fitting in turn brings them."""
    w = np.ones(len(tokens))
    for _ in range(rounds):
        old = w.copy()
        for d, m in [*zip(dims[1:], margins[1:]), (dims[0], margins[0])]:
            have = np.bincount(d, w * tokens, len(m))
            w = np.minimum(w * np.divide(m, have, out=np.zeros_like(m), where=have > 0)[d], cap)
        if np.abs(w - old).max() < SETTLED:
            break
    for _ in range(len(tokens)):  # what a cap cut off goes to the source's other cells
        have = np.bincount(dims[0], w * tokens, len(margins[0]))
        free = w < cap * (1 - 1e-12)
        room = np.bincount(dims[0], np.where(free, w * tokens, 0), len(margins[0]))
        lack = np.where(room > 0, margins[0] - have, 0)
        if (lack <= 1e-9 * margins[0]).all():
            break
        grow = 1 + np.divide(lack, room, out=np.zeros_like(lack), where=room > 0)
        w = np.where(free, np.minimum(w * np.maximum(grow, 0)[dims[0]], cap), w)
    return w


def _summed(cells: DataFrame, key: str, **sums) -> DataFrame:
    """``cells`` with sums over the cells of equal ``key`` beside them; a null is a value."""
    total = cells.groupBy(F.col(key).alias("__k")).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    return cells.join(total, F.col(key).eqNullSafe(F.col("__k"))).drop("__k")


def raked_frame(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``raked`` as grouped sums: ``cells`` (source, lang, topic, tokens, aim_source, aim_lang, aim_topic, cap) with
    ``weight``. A round is one pass per margin, written to the shared folder."""
    w, t = F.col("weight"), F.col("tokens")
    d = cells.withColumn("weight", F.lit(1.0))
    for _ in range(rounds):
        d = d.withColumn("old", w)
        for key in ("lang", "topic", "source"):
            d = _summed(d, key, have=w * t).withColumn("weight", F.least(w * F.when(F.col("have") > 0, F.col(f"aim_{key}") / F.col("have")).otherwise(0.0), F.col("cap"))).drop("have")
        d = cut(d)
        moved = d.agg(F.max(F.abs(w - F.col("old")))).first()[0]
        d = d.drop("old")
        if moved is None or moved < SETTLED:
            break
    while True:  # what a cap cut off goes to the source's other cells; each pass brings a source to its aim or a cell to its cap
        free = w < F.col("cap") * (1 - 1e-12)
        s = _summed(d, "source", have=w * t, room=F.when(free, w * t).otherwise(0.0))
        lack = F.when(F.col("room") > 0, F.col("aim_source") - F.col("have")).otherwise(0.0)
        s = cut(s.withColumn("lack", lack))
        if s.where(F.col("lack") > 1e-9 * F.col("aim_source")).isEmpty():
            return d
        grow = F.greatest(F.lit(0.0), 1 + F.when(F.col("room") > 0, F.col("lack") / F.col("room")).otherwise(0.0))
        d = s.withColumn("weight", F.when(free, F.least(w * grow, F.col("cap"))).otherwise(w)).drop("have", "room", "lack")


def weights(d: DataFrame, targets: DataFrame, most: int = MOST_CELLS, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, bool]:
    """(source, lang, topic, weight) of each cell; (source, target_share, max_repeats, tokens_available) of each
    target; and whether the cells are few."""
    goals = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    cells = cut(d.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")))
    there = cells.groupBy("source").agg(F.sum("tokens").alias("tokens_available"))
    report = goals.join(there, "source", "left").na.fill(0, ["tokens_available"])
    # the targets of sources that are there sum to one; the mix is as large as the scarcest source lets it be
    used = report.where("tokens_available > 0").select("source", F.col("target_share").alias("share"), F.col("max_repeats").cast("double").alias("cap"), "tokens_available")
    whole = used.agg(F.sum("share").alias("shares"), F.min(F.col("cap") * F.col("tokens_available") / F.col("share")).alias("least"), F.sum("tokens_available").alias("pool"))  # one row
    aims = used.join(F.broadcast(whole), F.lit(True)).select("source", "cap", (F.col("least") * F.col("share")).alias("aim_source"), (F.col("least") * F.col("shares") / F.col("pool")).alias("part"))
    c = cells.join(aims, "source")
    for key in ("lang", "topic"):  # the shares of the pool
        c = _summed(c, key, **{f"aim_{key}": F.col("tokens") * F.col("part")})
    c = cut(c.drop("part").withColumn("tokens", F.col("tokens").cast("double")))
    few = c.limit(most + 1).count() <= most
    if not few:
        return raked_frame(c, rounds).select("source", "lang", "topic", "weight"), report, few
    rows = sorted(c.collect(), key=lambda r: (r.source, r.lang or "", r.topic or "", r.lang is None, r.topic is None))
    dims, margins = [], []
    for key in ("source", "lang", "topic"):
        names = {v: i for i, v in enumerate(dict.fromkeys(r[key] for r in rows))}
        dims.append(np.array([names[r[key]] for r in rows], dtype=int))
        margins.append(np.array(list({r[key]: r[f"aim_{key}"] for r in rows}.values())))
    w = raked(np.array([r.tokens for r in rows]), dims, margins, np.array([r.cap for r in rows]), rounds) if rows else []
    out = d.sparkSession.createDataFrame([(r.source, r.lang, r.topic, float(x)) for r, x in zip(rows, w)], "source string, lang string, topic string, weight double")
    return out, report, few


def mix(documents: DataFrame, targets: DataFrame, seed: int = SEED, most_cells: int = MOST_CELLS, **columns) -> tuple[DataFrame, DataFrame]:
    """(id, source, tokens, repeats) of the documents in the mix, and the report of the shares, one row per target:
    (source, target_share, actual_share, max_repeats, documents, tokens, tokens_available)."""
    d = cut(sized(documents, targets, **columns))
    cells, report, few = weights(d, targets, most_cells)
    c = F.broadcast(cells) if few else cells
    j = d.alias("d").join(c.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & F.col("d.lang").eqNullSafe(F.col("c.lang")) & F.col("d.topic").eqNullSafe(F.col("c.topic")))
    j = j.select("d.*", "c.weight").withColumn("rest", F.col("weight") - F.floor("weight"))
    order = F.xxhash64(F.lit(seed), "id")
    salts = max(SALTS, -(-d.count() // PART))
    j = j.withColumns({"order": order, "salt": F.pmod(order, F.lit(salts))})
    # systematic draw: running sums inside (source, size, salt), shifted by the sums before, so that no task holds a source
    part = ["source", "bin", "salt"]
    sums = j.groupBy(*part).agg(F.sum("rest").alias("part"))
    shift = sums.withColumn("shift", F.sum("part").over(Window.partitionBy("source").orderBy("bin", "salt").rowsBetween(Window.unboundedPreceding, -1))).select(*part, "shift")
    run = F.sum("rest").over(Window.partitionBy(*part).orderBy("order", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = j.withColumn("run", run).join(shift, part).withColumn("to", F.col("run") + F.coalesce("shift", F.lit(0.0)) + 0.5)
    repeats = (F.floor("weight") + F.floor(F.round("to", 6)) - F.floor(F.round(F.col("to") - F.col("rest"), 6))).cast("int")
    chosen = cut(j.select("id", "source", "tokens", repeats.alias("repeats")).where("repeats > 0"))
    got = chosen.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    r = report.join(got, "source", "left").na.fill(0, ["documents", "tokens"])
    total = got.agg(F.sum("tokens").alias("all"))  # one row
    share = F.when(F.col("all") > 0, F.col("tokens") / F.col("all")).otherwise(0.0)
    r = r.join(F.broadcast(total), F.lit(True)).withColumn("actual_share", share)
    return chosen, r.select("source", "target_share", "actual_share", "max_repeats", "documents", "tokens", "tokens_available")
