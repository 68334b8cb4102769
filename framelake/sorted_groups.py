"""Streams of sorted rows, cut at their groups: for folds that carry a state from row to row, in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def begins(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where groups of a sorted batch begin, for all its rows; nulls are a key."""
    changed = np.zeros(batch.num_rows, bool)
    changed[:1] = True
    for k in keys:
        c = batch.column(k)
        a, b = c.slice(1), c.slice(0, max(0, len(c) - 1))
        same = pc.or_kleene(pc.equal(a, b), pc.and_(pc.is_null(a), pc.is_null(b)))
        changed[1:] |= ~pc.fill_null(pc.and_(same, pc.equal(pc.is_null(a), pc.is_null(b))), False).to_numpy(zero_copy_only=False)
    return changed


def pieces(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """(key, whether a new group begins, rows) of a stream sorted by keys: rows of one group each, as they come; nulls are a key."""
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(begins(batch, keys))
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
            rows = batch.slice(s, e - s)
            key = tuple(rows.column(k)[0].as_py() for k in keys)
            yield key, key != now, rows
            now = key


def folded(rows: DataFrame, by: list[str], order: list[str], fold: Callable[[], Callable[[tuple, bool, pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """rows through a fold: fold() makes a function of a group's key, whether it begins, and its next rows in order, that
    returns rows for them and keeps what it needs in between. A group is one task's work, and only a batch of it is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fold()
        for key, new, piece in pieces(batches, by):
            yield step(key, new, piece)

    return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)
