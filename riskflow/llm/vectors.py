"""Sums of numpy vectors over partitions, without passing them through one task or the driver."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: columns of a table of partial sums: which piece of the vector, which first-level group, the values
PARTIAL = "piece int, part int, vector binary"
PARTIAL_ARROW = pa.schema([("piece", pa.int32()), ("part", pa.int32()), ("vector", pa.binary())])


def pieces(vector: np.ndarray, part: int, kind: type = np.float64, length: int = 1 << 15) -> pa.RecordBatch:
    """A vector as rows of a table of partial sums, in values of ``kind``."""
    flat = np.ascontiguousarray(vector, kind).ravel()
    cuts = range(0, len(flat), length)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(cuts)), pa.int32()),
            pa.array([part] * len(cuts), pa.int32()),
            pa.array([flat[c : c + length].tobytes() for c in cuts], pa.binary()),
        ],
        schema=PARTIAL_ARROW,
    )


def _add(batches: Iterable[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
    total, piece, part = None, None, None
    for batch in batches:
        for k, p, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            values = np.frombuffer(raw, kind)
            total = values.copy() if total is None else total + values
            piece, part = k, p
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            schema=PARTIAL_ARROW,
        )


def summed(partial: DataFrame, length: int, kind: type = np.float64) -> np.ndarray:
    """The sum of all partial vectors, of ``length`` values in all.

    Two levels of grouped sums: each first-level group holds one piece of about a square root of all partitions'
    vectors, so no task receives them all. The driver gets one vector, whose length is fixed by parameters.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add(batches, kind)

    first = partial.groupBy("piece", "part").applyInArrow(add, PARTIAL)
    last = first.groupBy("piece").applyInArrow(add, PARTIAL)
    found = sorted((r.piece, bytes(r.vector)) for r in last.collect())
    if not found:
        return np.zeros(length)
    return np.concatenate([np.frombuffer(raw, kind) for _, raw in found]).astype(np.float64)


def parts(df: DataFrame) -> int:
    """About the square root of the number of partitions."""
    return max(1, int(np.sqrt(df.rdd.getNumPartitions())))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those whose hashed key is lowest; the same on every run.

    Rows whose hash is too high for it, given the number of all rows, are left out before the sort, so that its last
    task does not get ``rows`` rows of every partition.
    """
    place = F.xxhash64(F.col(key))
    known = df.count()
    if known > 4 * rows:
        low = df.where(place < -(1 << 63) + int(2 * rows / known * 2**64))
        df = low if low.count() >= rows else df
    return df.orderBy(place, F.col(key)).limit(rows)
