"""Token ids of whole texts by a byte-level BPE given as a rank file.

A text is split by the vocabulary's pattern. A short word is merged on a contiguous array of part boundaries with the
rank of each adjacent pair beside them: scan for the smallest rank, delete that boundary, refresh the two ranks next
to it. A long word keeps the same pairs in a heap over linked parts, so that one giant word costs n log n.

Defined results. The ids of an empty text and of a null text are the empty list. Special tokens are never made; their
strings are ordinary text. Repeated texts give repeated ids, an empty table an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT_WORD = 200
NONE = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word by repeated scans of its rank array."""
    if word in ranks:
        return [ranks[word]]
    at = list(range(len(word) + 1))
    rank = [ranks.get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while rank:
        low = min(rank)
        if low == NONE:
            break
        i = rank.index(low)
        del at[i + 1], rank[i]
        if i < len(rank):
            rank[i] = ranks.get(word[at[i] : at[i + 2]], NONE)
        if i:
            rank[i - 1] = ranks.get(word[at[i - 1] : at[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(at, at[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids with the pairs in a heap; ties go to the leftmost, as in the scan."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        if end[i] < 0 or end[i] >= n or end[end[i]] != e:
            continue
        dead = end[i]
        end[i], end[dead] = e, -1
        if e < n:
            before[e] = i
            if (r := ranks.get(word[i : end[e]])) is not None:
                heapq.heappush(heap, (r, i, end[e]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:e])) is not None:
            heapq.heappush(heap, (r, p, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes texts, remembering the words it met last."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, remembered: int = 1 << 16):
        self.split = regex.compile(pattern).findall

        @lru_cache(remembered)
        def word_ids(word: str) -> tuple[int, ...]:
            b = word.encode("utf-8", "surrogatepass")
            return tuple(merge_short(b, ranks) if len(b) <= SHORT_WORD else merge_long(b, ranks))

        self.word_ids = word_ids

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for word in self.split(text or ""):
            ids.extend(self.word_ids(word) if len(word) <= SHORT_WORD else self.word_ids.__wrapped__(word))
        return ids


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker and vocabulary."""
    key = hash(shared.value)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(read_ranks(shared.value))
    return _ENCODERS[key]


def _shared(df: DataFrame, folder: str, vocabulary: str):
    """The rank file, under 1 MB whatever the data, sent once to every executor."""
    with open(f"{folder}/{vocabulary}", "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(df: DataFrame, text: str = "text", out: str = "ids", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with the column ``out``, the ids of ``text``; no shuffle, each worker reads the ranks once."""
    shared = _shared(df, folder, vocabulary)

    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(shared)
        for t in texts:
            yield pd.Series([np.array(encoder.encode(x), dtype=np.int32) for x in t], dtype=object)

    return df.withColumn(out, ids(F.col(text)))


def token_count(df: DataFrame, text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text; 0 for null."""
    shared = _shared(df, folder, vocabulary)

    @F.pandas_udf("bigint")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(shared)
        for t in texts:
            yield pd.Series([len(encoder.encode(x)) for x in t], dtype="int64")

    return count(text)
