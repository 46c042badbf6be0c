"""Oversized texts cut at natural boundaries by pointer doubling.

A text offers page, paragraph, line and word boundaries. It is cut at the coarsest kind whose blocks, with those of
the coarser kinds, all fit. Every block start is joined to its farthest legal successor: the last block that still
fits into a piece begun there, overlap included. Squaring the successor table doubles its reach, so the cuts of the
greedy chain from the start are marked in log2(pieces) rounds instead of one after the other. A text is one cell, so
its table stays in one row and no shuffle happens.

Defined results. Texts within the limit, null texts give no rows; a blank text over the limit
gives one row, of piece_no 0 with an empty piece. Blocks are measured and pieces given
without spaces, tabs and newlines at their ends; what is lost between pieces is such space and the boundary itself.
Where even words are longer (kind "none") a word is cut at the limit. Repeated texts give repeated pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LIMIT, OVERLAP = 8000, 400
TEXTS_AT_ONCE = 32
KINDS = ["page", "paragraph", "line", "word"]
# Separators of each kind; each includes the coarser ones.
PAGE = r"(?:(?<=\n)|\A)[ \t]*--- Page Break ---[ \t]*(?=\n|\Z)|\f"
PARAGRAPH = r"(?:\n|\A)[ \t]*(?=\n)"
SEPARATORS = [re.compile(p) for p in (PAGE, f"{PAGE}|{PARAGRAPH}", f"{PAGE}|\n", f"{PAGE}|[ \t\n]")]
SPACE = " \t\n"
_NOT_SPACE = re.compile(r"[^ \t\n]")


def blocks(text: str, kind: int) -> np.ndarray:
    """Start and end of the blocks between the separators of a kind, trimmed, the empty ones left out."""
    out, at = [], 0
    for m in [*SEPARATORS[kind].finditer(text), None]:
        a, b = at, m.start() if m else len(text)
        first = _NOT_SPACE.search(text, a, b)
        if first:
            a = first.start()
            b = a + len(text[a:b].rstrip(SPACE))
            out.append((a, b))
        if m:
            at = m.end()
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def coarsest(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[str, np.ndarray]:
    """The coarsest kind whose blocks all fit, and the blocks; "none" with the words, long ones cut at the limit."""
    for k, name in enumerate(KINDS):
        b = blocks(text, k)
        if len(b) == 0 or (b[:, 1] - b[:, 0]).max() <= limit:
            return name, b
    step = max(1, limit - overlap)  # so that a piece cut inside a word can repeat the end of the one before
    cut = [(s, min(s + step, e) if e - a > limit else e) for a, e in b for s in (range(a, e, step) if e - a > limit else (a,))]
    return "none", np.array(cut, dtype=np.int64)


def chain(successor: np.ndarray) -> np.ndarray:
    """The starts on the way from the first one to the end (their number), by squaring the table of successors."""
    n = len(successor)
    jump = np.concatenate([successor, [n]])
    marked = np.zeros(n + 1, dtype=bool)
    marked[0] = True
    while jump[0] != n:  # marked: the starts within 2^k steps; jump: the start 2^k steps on
        marked[jump[marked]] = True
        jump = jump[jump]
    return np.flatnonzero(marked[:n])


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[str, list[tuple[int, int, int]]]:
    """The kind, and (start, fresh start, end) of each piece: from ``start`` to ``fresh start`` it repeats the end of
    the one before, at most ``overlap`` characters and less where the next block would not fit otherwise."""
    kind, b = coarsest(text, limit, overlap)
    n = len(b)
    if n == 0:
        return kind, []
    start, end = b[:, 0], b[:, 1]
    previous = np.concatenate([start[:1], end[:-1]])  # where the piece before ends, if this block begins a piece
    words = blocks(text, 3)[:, 0]
    at = np.minimum(np.searchsorted(words, previous - overlap), len(words) - 1)
    begin = np.where((words[at] < previous) & (words[at] >= previous - overlap), words[at], previous - overlap)
    begin = np.maximum(begin, end - limit)  # the block itself must fit
    begin = np.minimum(begin, start)
    begin = np.where(begin >= previous, start, begin)  # nothing but space would be repeated
    begin[0] = start[0]
    # a start pushed into a word moves on to the next one, if that is still before the block
    at = np.minimum(np.searchsorted(words, begin), len(words) - 1)
    begin = np.where((words[at] < start) & (words[at] >= begin), words[at], begin)
    successor = np.minimum(np.searchsorted(end, begin + limit, side="right"), n)
    cuts = chain(successor)
    last = successor[cuts] - 1
    return kind, [(int(begin[c]) if i else int(start[c]), int(start[c]), int(end[e])) for i, (c, e) in enumerate(zip(cuts, last))]


def _each(df: DataFrame, id_col: str, text: str, limit: int, columns: str, rows) -> DataFrame:
    """``rows(id, text)`` of every text over the limit, a few texts at a time."""
    d = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.length("text") > limit)
    out = f"id {df.schema[id_col].dataType.simpleString()}, {columns}"
    form = to_arrow_schema(T._parse_datatype_string(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                i, t = (c.to_pylist() for c in batch.slice(a, TEXTS_AT_ONCE).columns)
                made = [r for x, y in zip(i, t) for r in rows(x, y)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*made), form)] if made else [pa.array([], f.type) for f in form], names=form.names)

    return d.mapInArrow(run, out)


def split(df: DataFrame, id_col: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id, boundary, piece_no from 1, start, fresh, end, piece): the pieces, in reading order, of every text of more
    than ``limit`` characters; positions count characters from 0."""

    def rows(i, t: str) -> list[tuple]:
        kind, cut = pieces(t, limit, overlap)
        return [(i, kind, k, s, f, e, t[s:e]) for k, (s, f, e) in enumerate(cut, 1)] or [(i, kind, 0, 0, 0, 0, "")]

    return _each(df, id_col, text, limit, "boundary string, piece_no int, start int, fresh int, end int, piece string", rows)


def boundaries(df: DataFrame, id_col: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id, boundary, pieces): the kind of boundary each text over the limit is cut at, and into how many pieces."""

    def rows(i, t: str) -> list[tuple]:
        kind, cut = pieces(t, limit, overlap)
        return [(i, kind, len(cut))]

    return _each(df, id_col, text, limit, "boundary string, pieces int", rows)
