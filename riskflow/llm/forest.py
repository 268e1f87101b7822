"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap.

Each tree splits the space again and again by the median of a random projection; vectors near a split go to both sides.
All vectors of a leaf are compared with each other. A pair counts only in the first leaf, over all trees, that holds
both, so links are counted without listing pairs: a leaf returns, for each vector, its number of new links and one edge
to the root of its group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.components import components
from riskflow.llm.vectors import bounded_sample
from riskflow.llm.words import carried
from riskflow.session import materialize


class Node(NamedTuple):
    direction: np.ndarray | None
    middle: float
    left: int
    right: int
    leaf: int


def grow(sample: np.ndarray, depth: int, margin: float, least: int, rng: np.random.Generator, first_leaf: int) -> tuple[list[Node], int]:
    """One tree fitted to unit vectors; leaves are numbered from ``first_leaf``. Returns the nodes and the next number.

    A node is a leaf at the full depth, with fewer than ``least`` sample vectors, or if the overlap takes most of
    both sides, so that a further split would only copy a dense group.
    """
    nodes: list[Node | None] = [None]
    todo = [(0, np.arange(len(sample)), 0)]
    while todo:
        at, rows, level = todo.pop()
        if level < depth and len(rows) >= least:
            direction = rng.normal(size=sample.shape[1])
            direction /= np.linalg.norm(direction)
            p = sample[rows] @ direction
            middle = float(np.median(p))
            left, right = rows[p <= middle + margin], rows[p >= middle - margin]
            if max(len(left), len(right)) <= 0.85 * len(rows):
                nodes[at] = Node(direction, middle, len(nodes), len(nodes) + 1, -1)
                nodes += [None, None]
                todo += [(len(nodes) - 2, left, level + 1), (len(nodes) - 1, right, level + 1)]
                continue
        nodes[at] = Node(None, 0.0, -1, -1, first_leaf)
        first_leaf += 1
    return nodes, first_leaf


def leaves_of(tree: list[Node], unit: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that each unit vector falls into."""
    rows, found = [], []
    todo = [(0, np.arange(len(unit)))]
    while todo:
        at, own = todo.pop()
        node = tree[at]
        if not len(own):
            continue
        if node.direction is None:
            rows.append(own)
            found.append(np.full(len(own), node.leaf))
            continue
        p = unit[own] @ node.direction
        todo += [(node.left, own[p <= node.middle + margin]), (node.right, own[p >= node.middle - margin])]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(found)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def without_earlier(x: np.ndarray, y: np.ndarray, rows: np.ndarray, leaves: np.ndarray, starts: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (x, y) of vectors that share no leaf before ``leaf``.

    ``rows`` and ``leaves`` list the leaves of each vector in ascending order, ``starts`` the first leaf of each tree.
    Trees are gone through one by one: close vectors mostly share a leaf in one of the first, which ends their case.
    """
    before = leaves < leaf
    rows, leaves = rows[before], leaves[before]
    trees = np.searchsorted(starts, leaves, "right")
    for tree in range(1, len(starts) + 1):
        if not len(x) or starts[tree - 1] >= leaf:
            break
        on = trees == tree
        own, held = rows[on], leaves[on]
        if not len(own):
            continue
        counts = np.bincount(own, minlength=int(max(x.max(), y.max())) + 1)
        place = np.arange(len(own)) - (np.cumsum(counts) - counts)[own]
        padded = np.full((int(counts.max()), len(counts)), -1)
        padded[place, own] = held
        new = np.ones(len(x), bool)
        for one in padded:
            left = one[x]
            for two in padded:
                new &= (left != two[y]) | (left < 0)
        x, y = x[new], y[new]
    return x, y


def compare(
    ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, rows: np.ndarray, leaves: np.ndarray, starts: np.ndarray, side: np.ndarray, leaf: int, least: float
):
    """(id, root, new links) of the vectors of a cell that have links which no earlier leaf holds.

    ``side`` is 0 or 1: with both present only pairs across are compared. ``rows``, ``leaves`` and ``starts`` are as in
    ``without_earlier``.
    """
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    across = len(b) > 0
    b = b if across else a
    norms = np.linalg.norm(vectors, axis=1)
    cosine = (vectors[a] @ vectors[b].T) / (norms[a][:, None] * norms[b][None, :])
    x, y = np.nonzero(cosine >= least)
    if not across:
        x, y = x[x < y], y[x < y]
    x, y = without_earlier(a[x], b[y], rows, leaves, starts, leaf)
    if not len(x):
        return None
    links = np.bincount(x, copies[y], len(ids)) + np.bincount(y, copies[x], len(ids))
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        if (root == before).all():
            break
    on = np.flatnonzero(links)
    return ids[on], root[on], links[on].astype(np.int64)


def near_duplicates(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.9,
    trees: int = 10,
    leaf_rows: int = 400,
    margin: float = 0.028,
    sample: int = 16_384,
    block: int = 1024,
    seed: int = 2,
) -> DataFrame:
    """``embeddings`` with ``n_links`` (other vectors of cosine ``least`` or more), ``component_id`` and ``kept``.

    Equal vectors are compared once and counted as often as they occur. The trees are fitted to at most ``sample``
    vectors (those of lowest hashed id) on the driver; all vectors are then placed and compared in Spark. A leaf of
    more than ``block`` vectors is cut into blocks by a hash of the id, and each pair of blocks is a cell of its own,
    so no task holds more than two blocks and none is left out. ``margin`` is the half width of the overlap, in the
    length of a projection of a unit vector.

    Vectors of each length have a forest of their own, since only vectors of equal length have a cosine. Vectors that
    are null, zero, or hold null or non-finite values, and rows with a null id link with nothing; they are their own
    component and kept. Rows that share an id are one node. An empty table gives no rows. Columns named like the new ones are replaced.
    """
    spark = embeddings.sparkSession
    v = F.col(f"`{vector}`").cast("array<double>")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = embeddings.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.when(sound, v).alias("v"))
    usable = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    classes = materialize(usable.groupBy("v").agg(F.min("id").alias("cls"), F.count("*").alias("copies")), "classes")
    lengths = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()
    forests, next_leaf, first = {}, 0, []
    for d, n in lengths:
        depth = max(0, int(np.ceil(np.log2(n / leaf_rows))))
        unit = np.zeros((0, d))  # a tree of one leaf needs no sample
        if depth:
            drawn = matrix(bounded_sample(classes.where(F.size("v") == d).select("cls", "v"), "cls", sample).select("v").toArrow().column("v"))
            unit = drawn / np.linalg.norm(drawn, axis=1, keepdims=True)
        rng, forests[d] = np.random.default_rng(seed), []
        for _ in range(trees if depth else 1):
            first.append((d, next_leaf))
            tree, next_leaf = grow(unit, depth, margin, 32, rng, next_leaf)
            forests[d].append(tree)
    shared = spark.sparkContext.broadcast(forests)
    starts = {d: np.array([leaf for own, leaf in first if own == d]) for d, _ in lengths}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 4096):
                piece = big.slice(at, 4096)
                size = np.asarray(piece.column(2).value_lengths())
                for d in np.unique(size).tolist():
                    batch = piece if (size == d).all() else piece.filter(pa.array(size == d))
                    x = matrix(batch.column(2))
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    pairs = [leaves_of(tree, x, margin) for tree in shared.value[d]]
                    row, leaf = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
                    order = np.lexsort((leaf, row))
                    row, leaf = row[order], leaf[order]
                    cuts = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(leaf.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["cls", "copies", "v", "leaves"])

    placed = classes.select("cls", "copies", "v").mapInArrow(place, "cls long, copies long, v array<double>, leaves array<int>")
    placed = materialize(placed, "placed")
    spread = placed.withColumn("leaf", F.explode("leaves"))
    sizes = spread.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = spread.join(sizes, "leaf").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    cells = cells.select("leaf", low.alias("i"), high.alias("j"), (F.col("own") != low).cast("int").alias("side"), "cls", "copies", "v", "leaves")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        ids, copies = np.asarray(table.column("cls")), np.asarray(table.column("copies"))
        order = np.argsort(ids)
        side, leaf = np.asarray(table.column("side")), table.column("leaf")[0].as_py()
        across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        if across and not (side == 1).any():
            return
        leaves = table.column("leaves").combine_chunks().take(pa.array(order))
        rows = np.repeat(np.arange(len(ids)), np.asarray(leaves.value_lengths()))
        vectors = matrix(table.column("v"))[order]
        found = compare(ids[order], copies[order], vectors, rows, np.asarray(leaves.flatten()), starts[vectors.shape[1]], side[order], leaf, least)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["id", "root", "links"])

    found = materialize(cells.groupBy("leaf", "i", "j").applyInArrow(link, "id long, root long, links long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    members = materialize(usable.join(classes, "v").select("id", "cls", "copies"), "members")
    edges = found.select("id", F.col("root").alias("id2")).where("id <> id2")
    edges = edges.unionByName(members.where("id <> cls").select("id", F.col("cls").alias("id2")))
    groups = components(edges, "id", "id2")
    counted = members.join(links.withColumnRenamed("id", "cls"), "cls", "left")
    counted = counted.groupBy("id").agg((F.sum(F.coalesce("links", F.lit(0)) + F.col("copies")) - 1).alias("n_links"))
    counted = counted.join(groups, "id", "left").withColumnsRenamed({"id": "id__", "component_id": "group__", "n_links": "links__"})
    there, back = carried(embeddings, ("n_links", "component_id", "kept"))
    out = embeddings.select(*there, F.col(f"`{vec_id}`").cast("long").alias("own__")).join(counted, F.col("own__") == F.col("id__"), "left")
    component = F.coalesce("group__", "own__")
    return out.select(
        *back,
        F.coalesce("links__", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("own__"), F.lit(True)).alias("kept"),
    )
