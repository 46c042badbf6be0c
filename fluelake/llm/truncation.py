"""Texts cut off by field limits or broken transfers.

A cut value is a strict prefix of longer ones. Two self-joins by prefix find them, over all documents:

* Texts of texts. Every distinct text is hashed at fixed lengths; a text meets those that share its beginning up to the
  last fixed length before its end, and only these are hashed at its very length. The text is cut if, without a mark of
  omission, it breaks off inside a word or sentence of the longer one.
* Segments of segments. Lines and sentences are counted once and sorted; running sums give, for the last segment of each
  text, how many segments are equal and how many begin so and go on. It is cut where most go on (``continued``).

Most cut texts have no longer copy, and some end in a segment that no other begins with. For these, counts decide: how
often the last words end a segment at all, or whether the last word is a fragment of more frequent words (``goes_on``).
Where far more texts end at a length, in characters or bytes, than at the lengths around it (a field limit), the last
words must be sure to end a segment. A whole sentence at a limit is no cut.

Defined results. Null, empty and blank texts are not cut. A text with a final mark of omission or a broken character is
cut, whatever space follows. A complete copy to which something was added stays complete: it breaks off at the end of a
line or sentence. Repeated texts are judged alike, each gives its row. Null sources are a group of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluelake.runtime import cut, stored

MARKS = ["…", "...", "[...]", "[…]", "[truncated]", "[cut]", "\ufffd"]
MARK = r"(?:\s*(?:…|\.\.\.|\[(?:\.\.\.|…|truncated|cut)\]|\ufffd+))+\s*$"
SPACES = " \t\n\r\f\u000b\u00a0\u2007\u202f\u3000"
#: Rows sent to every worker; more of them are joined by shuffle.
MOST_SENT = 200_000
#: Sorts after every text that begins alike.
LAST = "\U0010ffff"
ENDING = r"[.!?:;)\]\"'”’»_]$"
#: A length is a limit when at least SPIKE times as many distinct texts have it as the WINDOW lengths on each side on average.
SPIKE, WINDOW, LEAST = 6.0, 12, 5
#: Share of line ends among the occurrences of a text's last words below which they are taken to go on.
GOES_ON = 0.5
#: The same share for a text that has a limit's length.
SURE = 0.8
#: A word that only ends segments is a fragment if longer words that begin like it are so many times as frequent.
FRAGMENT = 10


def _replaced(text: Column, old: str, new: str) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(new)), old, text)


def _marked(text: Column) -> Column:
    """Whether a text, trimmed at the end, ends in a mark of omission."""
    return reduce(lambda a, b: a | b, [F.endswith(text, F.lit(m)) for m in MARKS])


def _plain(text: Column, marked: Column) -> Column:
    """The text without a final mark, runs of spaces as one, line ends as one newline."""
    t = F.when(marked, F.regexp_replace(text, MARK, "")).otherwise(text)
    t = _replaced(_replaced(t, "\u00a0\u2007\u202f\u3000\t\f\u000b", " "), "\r", "\n")
    t = F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, "  ++", " ")).otherwise(t)
    t = F.replace(t, F.lit(" \n"), F.lit("\n"))
    return F.btrim(F.regexp_replace(t, "\n[ \n]++", "\n"), F.lit(" \n"))


def _sent(df: DataFrame, most: int) -> DataFrame:
    """``df``, marked for broadcast if it has no more than ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def fixed_lengths(longest: int) -> list[int]:
    """1 to 8, and from there lengths that grow by a third to a half."""
    out = list(range(1, 9))
    while out[-1] < longest:
        out.append(out[-2] * 2 if len(out) > 9 else out[-1] * 3 // 2)
    return out


def _longer(texts: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """(h, after) of each distinct text that is a strict prefix of others: what follows it in the first of them."""
    d = texts.withColumn("n", F.length("plain"))
    longest = d.agg(F.max("n")).first()[0] or 0
    at = F.array(*[F.lit(g) for g in fixed_lengths(longest)])
    key = lambda g: F.xxhash64(F.substring("plain", F.lit(1), g), g)
    own = F.array_max(F.filter(at, lambda g: g <= F.col("n")))
    # the lengths at which texts end between one fixed length and the next, by their beginning up to the first
    ends = cut(d.select(key(own).alias("key"), "n").groupBy("key").agg(F.collect_set("n").alias("ends"), F.min("n").alias("least")))
    met = d.select("h", "n", F.explode(F.transform(F.filter(at, lambda g: g <= F.col("n")), key)).alias("key")).join(_sent(ends, most), "key").where("least < n")
    met = met.select("h", F.explode(F.filter("ends", lambda e: e < F.col("n"))).alias("e")).groupBy("h").agg(F.collect_set("e").alias("ends"))
    # only texts that begin like a shorter one are hashed at its length
    need = _sent(cut(met), most)
    there = texts.join(need, "h").select("plain", F.explode("ends").alias("e"))
    begun = there.select(F.unhex(F.sha2(F.substring("plain", F.lit(1), F.col("e")), 256)).alias("h"), F.substring("plain", F.col("e") + 1, F.lit(8)).alias("after"))
    return begun.groupBy("h").agg(F.min("after").alias("after")).join(texts.select("h"), "h", "left_semi")


def _limits(texts: DataFrame) -> DataFrame:
    """(unit, length): the lengths, in characters or bytes, at which texts pile up."""
    both = F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))
    counted = texts.select(F.explode(both).alias("x")).groupBy("x.unit", "x.length").agg(F.count("*").alias("n"))
    near = counted.select("unit", F.explode(F.sequence(F.col("length") - WINDOW, F.col("length") + WINDOW)).alias("length"), F.col("length").alias("from"), "n").where("length <> from")
    around = near.groupBy("unit", "length").agg(F.expr("percentile(n, 0.5)").alias("typical"), F.sum("n").alias("total"))
    d = counted.join(around, ["unit", "length"], "left")
    usual = F.least(F.coalesce(F.col("total"), F.lit(0)) / (2 * WINDOW), F.coalesce(F.col("typical"), F.lit(0.0)))
    return d.where((F.col("n") >= LEAST) & (F.col("n") >= SPIKE * F.greatest(usual, F.lit(0.25)))).select("unit", "length")


def _segments(text: Column) -> Column:
    """Lines and sentences of a plain text, in lower case, digits alike."""
    return F.split(_replaced(F.lower(text), "123456789", "0"), r"\n|(?<=[.!?]) ")


def _begin(w: Column) -> Column:
    """How a segment begins: a bullet, or its first two words."""
    return F.when(F.get(w, F.lit(0)).rlike(r"^[^\p{L}\p{N}§$(\"']+$"), "•").otherwise(F.concat_ws(" ", F.slice(w, 1, 2)))


def _prefixes(segments: DataFrame, last: DataFrame) -> DataFrame:
    """(segment, equal, begun) of each distinct segment of ``last``: how many of the counted segments are equal to it,
    and how many begin with it."""
    s = F.col("segment")
    ask = [F.struct(F.lit("from").alias("ask"), s.alias("k"), F.lit(0).alias("place")), F.struct(F.lit("equal").alias("ask"), s.alias("k"), F.lit(2).alias("place")), F.struct(F.lit("begun").alias("ask"), F.concat(s, F.lit(LAST)).alias("k"), F.lit(0).alias("place"))]
    asked = last.select("segment").distinct().select("segment", F.explode(F.array(*ask)).alias("x")).select("segment", "x.*")
    f = _sums(segments.select(s.alias("k"), "c"), asked)
    at = {x: F.max(F.when(F.col("ask") == x, F.col("c"))) for x in ("from", "equal", "begun")}
    return f.groupBy("segment").agg((at["equal"] - at["from"]).alias("equal"), (at["begun"] - at["from"]).alias("begun"))


def _sums(counted: DataFrame, asked: DataFrame) -> DataFrame:
    """(segment, ask, c): the sum of c of all counted (k, c) before each place asked for (segment, ask, k, place); a
    counted k has place 1. All are sorted together, and running sums are taken."""
    nothing = F.lit(None).cast("string")
    both = counted.select("k", F.lit(1).alias("place"), nothing.alias("segment"), nothing.alias("ask"), "c")
    both = both.unionByName(asked.select("k", "place", "segment", "ask", F.lit(0).cast("long").alias("c")))
    ordered = both.repartitionByRange("k", "place").sortWithinPartitions("k", "place").select(F.spark_partition_id().alias("pid"), "segment", "ask", "c")

    names = ["pid", "segment", "ask", "c"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pid = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            pids, segment, ask, c = batch.columns
            run = total + np.cumsum(c.to_numpy(zero_copy_only=False))
            total, pid, kept = int(run[-1]), pids[0].as_py(), ask.is_valid()
            yield pa.RecordBatch.from_arrays([x.filter(kept) for x in (pids, segment, ask, pa.array(run, pa.int64()))], names=names)
        if pid is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([None], pa.string()), pa.array(["all"], pa.string()), pa.array([total], pa.int64())], names=names)

    found = cut(ordered.mapInArrow(sums, "pid int, segment string, ask string, c long"))
    before = found.where("ask = 'all'").select("pid", (F.sum("c").over(Window.orderBy("pid")) - F.col("c")).alias("before"))  # one number a partition
    return found.where("ask <> 'all'").join(F.broadcast(before), "pid").select("segment", "ask", (F.col("c") + F.col("before")).alias("c"))


def _line_ends(segments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How often words end a segment (``ends``) among all their places (``n``): by beginning and two words, by two
    words, and by the word, there with the places of longer words that begin like it (``longer``)."""
    w = segments.select(F.split("segment", " ").alias("w"), "c").withColumn("begin", _begin(F.col("w")))
    p = w.select("begin", "c", "w", F.posexplode("w").alias("pos", "b"))
    p = p.select("begin", F.coalesce(F.get("w", F.col("pos") - 1), F.lit("")).alias("a"), "b", "c", (F.col("pos") == F.size("w") - 1).alias("end"))
    full = cut(p.groupBy("begin", "a", "b").agg(F.sum(F.when(F.col("end"), F.col("c")).otherwise(0)).alias("ends"), F.sum("c").alias("n")))
    pairs = full.groupBy("a", "b").agg(F.sum("ends").alias("pair_ends"), F.sum("n").alias("pair_n"))
    words = cut(full.groupBy("b").agg(F.sum("ends").alias("word_ends"), F.sum("n").alias("word_n")).withColumn("ends_all", F.col("word_ends") == F.col("word_n")))
    # how many places words have that begin like one and go on with a letter or digit ("season." is no longer word than
    # "season"); what is neither sorts before both
    k = F.regexp_replace("b", r"[^\p{L}\p{N}]", " ")
    ask = [F.struct(F.lit(x).alias("ask"), F.concat(k, F.lit(c)).alias("k"), F.lit(0).alias("place")) for x, c in (("from", "0"), ("to", LAST))]
    asked = words.where("ends_all").select(F.col("b").alias("segment"), F.explode(F.array(*ask)).alias("x")).select("segment", "x.*")
    f = _sums(words.select(k.alias("k"), F.col("word_n").alias("c")), asked)
    longer = f.groupBy(F.col("segment").alias("b")).agg(F.sum(F.when(F.col("ask") == "to", F.col("c")).otherwise(-F.col("c"))).alias("longer"))
    return full, pairs, words.drop("ends_all").join(longer, "b", "left")


def judged(df: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """(id, source, marked, prefix, inside, continued, at_limit, goes_on, after, last, cut): every document with its
    signs and the verdict."""
    d = df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.rtrim(F.col(text), F.lit(SPACES)).alias("text"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes"))
    d = d.withColumn("marked", _marked(F.col("text")))
    d = d.select("id", "source", "chars", "bytes", "marked", _plain(F.col("text"), F.col("marked")).alias("plain"))
    # read and cleaned once; what follows reads the columns it needs
    d = stored(d.withColumn("h", F.unhex(F.sha2(F.col("plain"), 256))), "documents")
    texts = stored(d.where("plain <> ''").groupBy("h").agg(F.first("plain").alias("plain")), "texts")
    trimmed = F.btrim("s")
    counted = texts.select(F.explode(_segments(F.col("plain"))).alias("s")).select(trimmed.alias("segment")).where("segment <> ''")
    segments = cut(counted.groupBy("segment").agg(F.count("*").alias("c")))
    last = cut(texts.select("h", F.btrim(F.try_element_at(_segments(F.substring_index("plain", "\n", -1)), F.lit(-1))).alias("segment"), F.right("plain", F.lit(1)).alias("last")))
    small = d.select("id", "source", "h", "chars", "bytes", "marked")
    lengths = small.join(last.select("h"), "h", "left_semi").groupBy("h").agg(F.min("chars").alias("chars"), F.min("bytes").alias("bytes"))
    limits = F.broadcast(cut(_limits(lengths)))  # lengths at which many texts pile up
    full, pairs, single = _line_ends(segments)
    # each distinct last segment is judged once, then each distinct text, then each document
    w = last.select("segment").distinct().withColumn("w", F.split("segment", " "))
    w = w.select("segment", _begin(F.col("w")).alias("begin"), F.coalesce(F.get("w", F.size("w") - 2), F.lit("")).alias("a"), F.get("w", F.size("w") - 1).alias("b"))
    w = w.join(_prefixes(segments, last), "segment", "left").join(full, ["begin", "a", "b"], "left").join(pairs, ["a", "b"], "left").join(single, "b", "left")
    # known: seen going on, or ending segments of other texts too
    known = (F.col("n") > 2) | (F.col("ends") < F.col("n"))
    pair_known = (F.col("pair_n") > 2) | (F.col("pair_ends") < F.col("pair_n"))
    stops = F.when(known, F.col("ends") / F.col("n")).when(pair_known, F.col("pair_ends") / F.col("pair_n")).when(F.col("word_n") > 2, F.col("word_ends") / F.col("word_n")).otherwise(0.0)
    fragment = (F.col("word_ends") == F.col("word_n")) & (F.coalesce("longer", F.lit(0)) >= FRAGMENT * F.col("word_n"))
    # of the other segments that begin so, the share that end here
    share = F.when(F.col("begun") > F.col("equal"), (F.col("equal") - 1) / (F.col("begun") - 1))
    w = w.select("segment", "b", stops.alias("stops"), F.coalesce(fragment, F.lit(False)).alias("fragment"), share.alias("share"))
    t = last.join(w, "segment", "left").join(_longer(texts), "h", "left").drop("segment")
    j = small.join(t, "h", "left")
    j = j.join(limits.where("unit = 'chars'").select(F.col("length").alias("chars"), F.lit(True).alias("c_limit")), "chars", "left")
    j = j.join(limits.where("unit = 'bytes'").select(F.col("length").cast("int").alias("bytes"), F.lit(True).alias("b_limit")), "bytes", "left")
    ended = F.col("last").rlike(ENDING)
    word, follows = r"[\p{L}\p{N}]", F.left("after", F.lit(1))
    inside = follows.rlike(word) & F.col("last").rlike(r"[\p{L}\p{N}.,-]") | (follows == " ") & ~ended
    limit = F.coalesce("c_limit", "b_limit", F.lit(False))
    least = F.when(limit, SURE).otherwise(GOES_ON)
    continued = ~ended & (F.col("share") < least) & (F.col("fragment") | (F.col("stops") < SURE))
    goes_on = F.when(ended, F.col("fragment") & F.col("b").rlike(r"[a-z]0+\.$")).otherwise(F.col("fragment") | (F.col("stops") < least))
    there = F.coalesce(F.col("last") != "", F.lit(False))
    signs = {
        "marked": F.coalesce("marked", F.lit(False)) & there, "prefix": F.col("after").isNotNull(), "inside": F.coalesce(inside, F.lit(False)),
        "continued": F.coalesce(continued, F.lit(False)), "at_limit": limit & there, "goes_on": F.coalesce(goes_on, F.lit(False)) & there,
    }
    j = j.withColumns(signs)
    return j.select("id", "source", *signs, "after", "last", (F.col("marked") | F.col("inside") | F.col("continued") | F.col("goes_on")).alias("cut"))


def shares(found: DataFrame) -> DataFrame:
    """(source, documents, cut, share): how often each source cuts its texts."""
    return found.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("cut").cast("long")).alias("cut")).withColumn("share", F.col("cut") / F.col("documents"))
