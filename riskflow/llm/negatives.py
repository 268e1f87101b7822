"""Hard negatives for embeddings, by filtering with segment summaries.

A vector is cut into segments, and each segment's mean and deviation are stored. Over a segment of l components the
inner product of x and y lies within l (mean x mean y -+ deviation x deviation y), so summaries bound a score without
the vectors. Bounds over a quarter of the segments (each joined from four neighbours) are tried first, those over all
segments only for pairs that are left, and the exact integer product only for what these leave.

Rows are dealt into blocks and the anchors too, and each pair of blocks is one task, so an anchor meets every row and
no task holds more than two blocks. A block of a label that many rows share is cut like any other.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors are compared with
those of equal length only. A component x becomes floor(256 x); scores are exact while they fit a 64-bit integer. Rows
of the anchor's own id are neither positives nor negatives of it; other equal rows stand for themselves, and equal
anchors are answered once. No row, or no other label, gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import materialize

#: segments of a vector (fewer for shorter ones), and how many of them the first bounds join
SEGMENTS, JOINED = 16, 4
#: pairs whose bounds stand in memory at a time
PAIRS = 1 << 20

ROW = "vec_id long, label long, v array<long>, means array<double>, devs array<double>"
ROW_ARROW = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int64())), ("means", pa.list_(pa.float64())), ("devs", pa.list_(pa.float64()))]
)


def _cuts(length: int) -> np.ndarray:
    return np.linspace(0, length, min(SEGMENTS, length) + 1).astype(np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(rows, -1)


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of the rows of ``v``."""
    cuts = _cuts(v.shape[1])
    sizes = np.diff(cuts)
    if not len(sizes):
        return np.zeros((len(v), 0)), np.zeros((len(v), 0))
    x = v.astype(np.float64)
    means = np.add.reduceat(x, cuts[:-1], axis=1) / sizes
    apart = x - np.repeat(means, sizes, axis=1)
    return means, np.sqrt(np.add.reduceat(apart * apart, cuts[:-1], axis=1) / sizes)


def usable(embeddings: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """Rows that take part, as integers with their summaries."""
    v = F.col(f"`{vector}`")
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    kept = embeddings.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.when(v.isNotNull() & ~broken, F.transform(v, lambda x: F.floor(x.cast("double") * 256))).alias("v"),
    ).where("vec_id is not null and label is not null and v is not null")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(2).value_lengths())
            for d in np.unique(lengths).tolist():
                own = batch if (lengths == d).all() else batch.filter(pa.array(lengths == d))
                means, devs = summaries(_matrix(own.column(2), own.num_rows) if d else np.zeros((own.num_rows, 0)))
                offsets = pa.array(np.arange(own.num_rows + 1, dtype=np.int32) * means.shape[1])
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (means, devs)]
                yield pa.RecordBatch.from_arrays([*own.columns, *lists], schema=ROW_ARROW)

    return kept.mapInArrow(run, ROW)


class Side:
    """Vectors of a block with their summaries."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.ids, self.labels = np.asarray(table.column("vec_id")), np.asarray(table.column("label"))
        d = len(table.column("v")[0]) if n else 0
        self.v = _matrix(table.column("v"), n) if d else np.zeros((n, d), np.int64)
        sizes = np.diff(_cuts(d)).astype(np.float64)
        self.levels = []
        means, devs = (_matrix(table.column(c), n) if d else np.zeros((n, 0)) for c in ("means", "devs"))
        if len(sizes):
            at = np.arange(0, len(sizes), JOINED)
            joined = np.add.reduceat(sizes, at)
            mean = np.add.reduceat(means * sizes, at, axis=1) / joined
            square = np.add.reduceat((devs * devs + means * means) * sizes, at, axis=1) / joined
            self.levels.append((joined, mean, np.sqrt(np.maximum(square - mean * mean, 0))))
        self.levels.append((sizes, means, devs))


def _widened(middle: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds, wider by more than the sums can be rounded."""
    slack = reach + 1e-9 * (np.abs(middle) + reach) + 1e-3
    return middle - slack, middle + slack


def _first_bounds(anchors: Side, rows: Side, part: slice) -> tuple[np.ndarray, np.ndarray]:
    sizes, mean, dev = anchors.levels[0]
    _, other_mean, other_dev = rows.levels[0]
    return _widened((mean[part] * sizes) @ other_mean.T, (dev[part] * sizes) @ other_dev.T)


def _last_bounds(anchors: Side, rows: Side, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes, mean, dev = anchors.levels[-1]
    _, other_mean, other_dev = rows.levels[-1]
    parts = [
        _widened(np.einsum("ij,ij->i", mean[a] * sizes, other_mean[b]), np.einsum("ij,ij->i", dev[a] * sizes, other_dev[b]))
        for a, b in ((i[p : p + PAIRS // 16], j[p : p + PAIRS // 16]) for p in range(0, max(1, len(i)), PAIRS // 16))
    ]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _products(anchors: Side, rows: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    step = PAIRS // 16
    parts = [np.einsum("ij,ij->i", anchors.v[i[p : p + step]], rows.v[j[p : p + step]]) for p in range(0, max(1, len(i)), step)]
    return np.concatenate(parts)


def _kth_largest(values: np.ndarray, groups: np.ndarray, n_groups: int, k: int) -> np.ndarray:
    """The k-th largest value of each group; minus infinity for groups of fewer."""
    least = np.full(n_groups, -np.inf)
    order = np.lexsort((-values, groups))
    sorted_groups = groups[order]
    starts = np.searchsorted(sorted_groups, np.arange(n_groups))
    ends = np.searchsorted(sorted_groups, np.arange(n_groups), "right")
    full = ends - starts >= k
    least[full] = values[order][starts[full] + k - 1]
    return least


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group by falling score and rising id."""
    order = np.lexsort((ids, -score, group))
    starts = np.searchsorted(group[order], group[order])
    return order[np.arange(len(order)) - starts < k]


def _anchor_steps(anchors: Side, rows: Side) -> Iterator[slice]:
    step = max(1, PAIRS // max(1, len(rows.ids)))
    for a in range(0, len(anchors.ids), step):
        yield slice(a, min(len(anchors.ids), a + step))


def nearest(anchors: Side, rows: Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's place, row's place, score) of the ``k`` rows of highest score for each anchor, others' ids only."""
    out = []
    for part in _anchor_steps(anchors, rows):
        low, high = _first_bounds(anchors, rows, part)
        own = anchors.ids[part, None] == rows.ids[None, :]
        low[own], high[own] = -np.inf, -np.inf
        at_least = np.full(len(low), -np.inf)
        if low.shape[1] >= k:
            at_least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        i, j = np.nonzero((high >= at_least[:, None]) & ~own)
        low, high = _last_bounds(anchors, rows, i + part.start, j)
        left = high >= _kth_largest(low, i, part.stop - part.start, k)[i]
        i, j = i[left] + part.start, j[left]
        score = _products(anchors, rows, i, j)
        best = _best(i, score, rows.ids[j], k)
        out.append((i[best], j[best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def within(anchors: Side, rows: Side, limits: np.ndarray, share: int, k: int) -> tuple[np.ndarray, ...]:
    """(anchor's place, limit's place, row's place, score) of the first ``k`` rows of other labels for each limit.

    ``limits`` has a row per anchor, NaN where there is no further limit. Rows count whose score is at most the limit
    and at least ``share`` hundredths of it.
    """
    out = []
    for part in _anchor_steps(anchors, rows):
        low, high = _first_bounds(anchors, rows, part)
        apart = (anchors.labels[part, None] != rows.labels[None, :]) & (anchors.ids[part, None] != rows.ids[None, :])
        near = np.zeros(low.shape, bool)
        for s in range(limits.shape[1]):
            near |= (100 * high >= share * limits[part, s, None]) & (low <= limits[part, s, None])
        i, j = np.nonzero(near & apart)
        low, high = _last_bounds(anchors, rows, i + part.start, j)
        need = np.zeros(len(i), bool)
        for s in range(limits.shape[1]):
            limit = limits[part, s][i]
            inside = (100 * high >= share * limit) & (low <= limit)
            # with k rows sure to count, rows that must be below the k-th of them cannot be among the first
            sure = inside & (100 * low >= share * limit) & (high <= limit)
            need |= inside & (high >= _kth_largest(low[sure], i[sure], part.stop - part.start, k)[i])
        i, j = i[need], j[need]
        score = _products(anchors, rows, i + part.start, j)
        for s in range(limits.shape[1]):
            limit = limits[part, s][i]
            hit = np.flatnonzero((100 * score >= share * limit) & (score <= limit))
            best = hit[_best(i[hit], score[hit], rows.ids[j[hit]], k)]
            out.append((i[best] + part.start, np.full(len(best), s), j[best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _blocked(df: DataFrame, group: Sequence[str], size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` dealt into blocks of about ``size`` rows within each group, and the number of blocks per group.

    The task that read a row has a part in its place, so equal rows do not fill one block.
    """
    counts = materialize(df.groupBy(*group).agg(F.ceil(F.count("*") / size).cast("long").alias(f"{name}s")), f"{name}s")
    place = F.pmod(F.xxhash64("vec_id", "v", F.spark_partition_id()), F.col(f"{name}s"))
    return df.join(counts, list(group)).withColumn(name, place).drop(f"{name}s"), counts


def _copies(df: DataFrame, counts: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """``df`` once for each block of the other side in its group."""
    many = df.join(counts, list(group))
    return many.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{name}s") - 1))).drop(f"{name}s")


def mine(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    is_anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    row_block: int = 4096,
    anchor_block: int = 1024,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its first other rows of the same label, by falling score and rising id. For each of them
    the negatives are the first rows of other labels whose score is at most the positive's and at least ``share``
    hundredths of it. ``is_anchor`` is a condition on vec_id; by default ids divisible by 100. The block sizes bound
    what a task holds and steer only the placement of rows.
    """
    chosen = F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor
    rows = usable(embeddings, vec_id, vector, F.col(f"`{label}`") if isinstance(label, str) else label)
    rows = materialize(rows.withColumn("d", F.size("v")), "vectors")
    columns = [c.split()[0] for c in ROW.split(", ")]
    anchors = rows.where(chosen).dropDuplicates(["vec_id", "label", "v"]).withColumn("anchor", F.xxhash64("vec_id", "label", "v"))
    anchors = materialize(anchors, "anchors")

    group, cell = ["d", "label"], ["d", "label", "block", "a_block"]
    dealt, blocks = _blocked(rows, group, row_block, "block")
    asked, a_blocks = _blocked(anchors, group, anchor_block, "a_block")

    def find(own: pa.Table, other: pa.Table) -> pa.Table:
        kind = pa.schema([("anchor", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
        if not own.num_rows or not other.num_rows:
            return kind.empty_table()
        a, b = Side(own), Side(other)
        i, j, score = nearest(a, b, positives)
        names = np.asarray(own.column("anchor"))
        return pa.Table.from_arrays([pa.array(names[i]), pa.array(b.ids[j]), pa.array(score)], schema=kind)

    left = _copies(asked, blocks, group, "block").select(*cell, "vec_id", "v", "means", "devs", "anchor")
    right = _copies(dealt, a_blocks, group, "a_block").select(*cell, "vec_id", "v", "means", "devs")
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(find, "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    near = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    near = materialize(near, "positives")

    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("limits"))
    limits = F.transform("limits", lambda x: x["positive_score"])
    sought = anchors.join(lists.withColumn("limits", limits), "anchor").select(*columns, "d", "anchor", "limits")
    group, cell = ["d"], ["d", "block", "a_block"]
    dealt, blocks = _blocked(rows, group, row_block, "block")
    asked, a_blocks = _blocked(materialize(sought, "sought"), group, anchor_block, "a_block")

    def sift(own: pa.Table, other: pa.Table) -> pa.Table:
        kind = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])
        if not own.num_rows or not other.num_rows:
            return kind.empty_table()
        a, b = Side(own), Side(other)
        known = own.column("limits").to_pylist()
        most = np.full((len(known), max(map(len, known))), np.nan)
        for at, values in enumerate(known):
            most[at, : len(values)] = values
        i, s, j, score = within(a, b, most, share, negatives)
        names = np.asarray(own.column("anchor"))
        return pa.Table.from_arrays([pa.array(names[i]), pa.array((s + 1).astype(np.int32)), pa.array(b.ids[j]), pa.array(score)], schema=kind)

    left = _copies(asked, blocks, group, "block").select(*cell, "vec_id", "label", "v", "means", "devs", "anchor", "limits")
    right = _copies(dealt, a_blocks, group, "a_block").select(*cell, "vec_id", "label", "v", "means", "devs")
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(sift, "anchor long, place int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = near.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return ranked.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
