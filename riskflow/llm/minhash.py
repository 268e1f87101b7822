"""Near-duplicate documents by MinHash with tensored banding; every link is confirmed on the full shingle sets.

Two small collections hold ``bands`` hashes each, every one of ``rows`` minimum hashes. A table key is a pair of one hash
of each collection, so bands x bands tables of 2 x rows minimum hashes come from 2 x bands x rows minimum hashes. Two
sets of similarity s share a key with probability (1 - (1 - s ** rows) ** bands) ** 2; with 10 bands of 3 that is 0.998
at 0.8, 0.9998 at 0.85 and below 0.01 at 0.2.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.components import components
from riskflow.llm.words import Words, carried, hash_words, in_chunks, mix, seeds, texts_as_bytes, with_columns
from riskflow.session import materialize

BITS = 1024  # of the bitmap that bounds an intersection from above
_STEP = np.uint64(0x9E3779B97F4A7C15)
PAIRS = pa.schema([("id", pa.int64()), ("id2", pa.int64())])


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text; fewer words than ``size`` are one shingle, none are none."""
    h = words.hashes
    with np.errstate(over="ignore"):
        grams = h.copy()
        for k in range(1, size):
            grams[: len(h) - k] = mix(grams[: len(h) - k] * _STEP + h[k:]) if len(h) > k else grams[:0]
    sets = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        n = b - a
        if n >= size:
            sets.append(np.unique(grams[a : b - size + 1]))
        elif n:
            with np.errstate(over="ignore"):
                whole = h[a : a + 1]
                for x in h[a + 1 : b]:
                    whole = mix(whole * _STEP + x)
                sets.append(mix(whole + np.uint64(n)))
        else:
            sets.append(h[:0])
    return sets


SIGNATURE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_shingles", "print1", "print2")]
    + [T.StructField(n, T.ArrayType(T.LongType(), False)) for n in ("a", "b", "bits")]
)


def signatures(docs: DataFrame, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """``docs`` with the size and prints of each set, both hash collections, and the bitmap; ``text`` is dropped."""

    def start():
        first, second = seeds(2 * bands * rows, 1), seeds(2 * bands * rows, 2)
        weights = np.tile(seeds(rows, 3), 2 * bands).reshape(2 * bands, rows)

        def make(texts: list[bytes]) -> list[pa.Array]:
            sets = shingle_sets(hash_words(texts), size)
            lengths = np.array([len(s) for s in sets])
            full = np.flatnonzero(lengths)
            hashes = np.zeros((len(sets), 2 * bands), np.uint64)
            prints = np.zeros((2, len(sets)), np.uint64)
            bits = np.zeros((len(sets), BITS), bool)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                cuts = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
                with np.errstate(over="ignore"):
                    least = np.empty((len(full), len(first)), np.uint64)
                    for k in range(len(first)):
                        x = (flat ^ first[k]) * second[k]
                        x ^= x >> np.uint64(32)
                        least[:, k] = np.minimum.reduceat(x, cuts)
                    mixed = mix(least.reshape(len(full), 2 * bands, rows)) * weights
                    hashes[full] = mix(mixed.sum(2, dtype=np.uint64))
                    prints[0, full] = np.add.reduceat(mix(flat), cuts)
                    prints[1, full] = np.add.reduceat(mix(flat ^ _STEP), cuts)
                bits[np.repeat(full, lengths[full]), (flat >> np.uint64(54)).astype(int)] = True
            packed = np.packbits(bits, axis=1).view(np.int64)
            longs = hashes.view(np.int64)
            kind = pa.list_(pa.int64())
            return [
                pa.array(lengths, pa.int64()), *(pa.array(p.view(np.int64)) for p in prints),
                pa.array(list(longs[:, :bands]), kind), pa.array(list(longs[:, bands:]), kind), pa.array(list(packed), kind),
            ]

        return make

    return with_columns(docs, text, SIGNATURE, start, keep_text=False)


def may_link(percent: int) -> Column:
    """Whether sets (n, bits) and (n2, bits2) can reach the similarity: a bit that only one has is an element that
    the other lacks, which bounds the intersection from above. Never false for a pair that does reach it."""
    longs = range(BITS // 64)
    lacks = sum((F.bit_count(F.col("bits")[i].bitwiseAND(F.bitwise_not(F.col("bits2")[i]))) for i in longs), F.lit(0))
    lacks2 = sum((F.bit_count(F.col("bits2")[i].bitwiseAND(F.bitwise_not(F.col("bits")[i]))) for i in longs), F.lit(0))
    most = F.least(F.col("n") - lacks, F.col("n2") - lacks2)
    return (100 + percent) * most >= percent * (F.col("n") + F.col("n2"))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The (id, id2) pairs whose full shingle sets are similar enough; ``texts`` is (id, t binary)."""
    one = texts.select("id", "t")
    two = texts.select(F.col("id").alias("id2"), F.col("t").alias("t2"))
    joined = pairs.select("id", "id2").join(one, "id").join(two, "id2").select("id", "id2", "t", "t2")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, others, ts, ts2 = (batch.column(i).to_pylist() for i in range(4))
            for a, b in in_chunks([len(x) + len(y) for x, y in zip(ts, ts2, strict=True)]):
                distinct = list({*ts[a:b], *ts2[a:b]})
                sets = dict(zip(distinct, shingle_sets(hash_words(distinct), size), strict=True))
                keep = []
                for i in range(a, b):
                    x, y = sets[ts[i]], sets[ts2[i]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in keep], pa.int64()), pa.array([others[i] for i in keep], pa.int64())], names=["id", "id2"]
                )

    return joined.mapInArrow(run, "id long, id2 long")


def table_keys(reps: DataFrame, bands: int) -> DataFrame:
    """(key, i, j, id, n_in): the table keys that at least two sets have.

    A key can be shared only if both its hashes are, so hashes that one set alone has are left out before pairs are
    formed: 2 x bands rows per set are counted, not bands x bands.
    """
    halves = reps.select("id", F.lit("a").alias("side"), F.posexplode("a").alias("i", "h")).unionByName(
        reps.select("id", F.lit("b").alias("side"), F.posexplode("b").alias("i", "h"))
    )
    halves = halves.withColumn("half", F.xxhash64("side", "i", "h"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    halves = materialize(halves.join(shared, "half", "left_semi"), "halves")
    left = halves.where("side = 'a'").select("id", "i", F.col("half").alias("h1"))
    right = halves.where("side = 'b'").select("id", F.col("i").alias("j"), F.col("half").alias("h2"))
    keys = left.join(right, "id").select("id", "i", "j", F.xxhash64("h1", "h2").alias("key"))
    keys = materialize(keys, "keys")
    busy = keys.groupBy("key").agg(F.count("*").alias("n_in")).where("n_in > 1")
    return materialize(keys.join(busy, "key"), "busy")


def first_equal(x: str, y: str, bands: int) -> Column:
    """The first place at which two hash collections agree."""
    found = F.lit(bands)
    for k in reversed(range(bands)):
        found = F.when(F.col(x)[k] == F.col(y)[k], F.lit(k)).otherwise(found)
    return found


def rivals(busy: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``busy`` under keys that still hold several components of ``found``, with ``comp``; and those outside the
    key's largest component."""
    labelled = busy.join(found, "id", "left").withColumn("comp", F.coalesce("component_id", "id")).drop("component_id")
    labelled = materialize(labelled, "labelled")
    sizes = labelled.groupBy("key", "comp").agg(F.count("*").alias("c"))
    main = sizes.groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("comps"))
    main = main.where("comps > 1").select("key", "main")
    split = materialize(labelled.join(main, "key"), "split")
    return split, split.where("comp <> main")


def remaining_pairs(split: DataFrame, outside: DataFrame, small: DataFrame, percent: int, bands: int, cell: int) -> DataFrame:
    """The (id, id2) of different components under one key, ``id`` of ``outside``, that the bitmaps do not rule out.

    A pair is given under the first key that both have. Under a key of few pairs they are joined; a key of more is cut
    into cells, its rows of ``outside`` and all its rows each in pieces of about ``cell``, and each cell is one product
    of bit matrices.
    """
    rare, often = crowded(split, outside, cell)
    wide = small.select("id", "n", "bits", "a", "b")
    ours = split.select("key", "id", "comp").join(wide, "id")
    own = outside.select("key", "i", "j", "id", "comp").join(wide, "id")

    names = {c: f"{c}2" for c in ("id", "comp", "n", "bits", "a", "b")}
    once = (first_equal("a", "a2", bands) == F.col("i")) & (first_equal("b", "b2", bands) == F.col("j"))
    few = own.join(rare, "key", "left_semi").withColumnRenamed("key", "k")
    met = ours.withColumnsRenamed(names)
    few = few.join(met, (F.col("k") == F.col("key")) & (F.col("comp") != F.col("comp2")) & once & may_link(percent))

    mine, all_rows = F.pmod(F.xxhash64("id"), F.col("own_pieces")), F.pmod(F.xxhash64("id"), F.col("pieces"))
    left = own.join(often, "key").withColumn("x", mine).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    right = ours.join(often, "key").withColumn("y", all_rows).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own_pieces") - 1)))
    left = left.select("key", "x", "y", "i", "j", "id", "comp", "n", "bits", "a", "b")
    right = right.select(*(F.col(c).alias(f"{c}2") for c in ("key", "x", "y", "id", "comp", "n", "bits", "a", "b")))

    def values(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).to_numpy()

    def lists(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

    def bitmaps(table: pa.Table) -> np.ndarray:
        return np.unpackbits(np.ascontiguousarray(lists(table, "bits")).view(np.uint8), axis=1).astype(np.float32)

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        if not one.num_rows or not two.num_rows:
            return PAIRS.empty_table()
        two = two.rename_columns([name.removesuffix("2") for name in two.column_names])
        bits, bits2 = bitmaps(one), bitmaps(two)
        n, n2 = values(one, "n")[:, None], values(two, "n")[None, :]
        common = bits @ bits2.T
        most = np.minimum(n - bits.sum(1)[:, None] + common, n2 - bits2.sum(1)[None, :] + common)
        x, y = np.nonzero(((100 + percent) * most >= percent * (n + n2)) & (values(one, "comp")[:, None] != values(two, "comp")[None, :]))
        for name, place in (("a", "i"), ("b", "j")):
            equal = lists(one, name)[x] == lists(two, name)[y]
            first = equal.any(1) & (equal.argmax(1) == values(one, place)[x])
            x, y = x[first], y[first]
        return pa.Table.from_arrays([pa.array(values(one, "id")[x]), pa.array(values(two, "id")[y])], schema=PAIRS)

    many = left.groupBy("key", "x", "y").cogroup(right.groupBy("key2", "x2", "y2")).applyInArrow(compare, "id long, id2 long")
    return few.select("id", "id2").unionByName(many)


def crowded(split: DataFrame, outside: DataFrame, cell: int) -> tuple[DataFrame, DataFrame]:
    """The keys of few pairs, and those of more with their numbers of pieces."""
    sizes = split.groupBy("key").agg(F.count("*").alias("all"))
    sizes = materialize(sizes.join(outside.groupBy("key").agg(F.count("*").alias("own")), "key"), "sizes")
    few = F.col("all") * F.col("own") <= cell * 16
    pieces = [F.ceil(F.col(c) / cell).cast("long").alias(name) for c, name in (("own", "own_pieces"), ("all", "pieces"))]
    return sizes.where(few).select("key"), sizes.where(~few).select("key", *pieces)


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = 4,
    percent: int = 80,
    bands: int = 10,
    rows: int = 3,
    cell: int = 1024,
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept`` (it is its own).

    Two documents are linked if 100 x common shingles >= ``percent`` x all their shingles. Documents of equal sets are
    one node. Candidates that share a table key are not paired with each other but in turn with few others: first
    with the key's most connected member, then, if not yet in the component of most of the key, with a random member
    of it, and last with every member of another component whose bitmap does not rule the link out. So pairs within
    a component are never listed, links between components are all tried, and a group of near copies costs work in
    proportion to its size. Texts that share a key but no link (pages of one template) are compared in cells of at most
    about ``cell`` x ``cell``; of their pairs only those leave a cell that the bitmaps do not rule out.

    Null ids stay outside: no component, kept. Null, empty and blank texts have no shingles and are linked with
    nothing. Rows of one id are one node; each text of it can link. Columns named like the new ones are replaced.
    """
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), texts_as_bytes(F.col(f"`{text}`")).alias("t"), F.xxhash64(F.col(f"`{text}`")).alias("row"))
    signed = materialize(signatures(plain, "t", size, bands, rows), "signatures")
    known = signed.where("id is not null and n_shingles > 0")
    same = ["print1", "print2", "n_shingles"]
    groups = materialize(known.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("n_rows")), "groups")
    copies = known.select("id", *same).join(groups.where("n_rows > 1"), same).where("id <> rep").select("id", F.col("rep").alias("id2"))
    reps = known.join(groups.select(*same, F.col("rep").alias("id")), [*same, "id"], "left_semi").dropDuplicates(["id", *same])
    reps = materialize(reps.select("id", F.col("n_shingles").alias("n"), "a", "b", "bits"), "reps")
    busy = table_keys(reps, bands)
    wanted = busy.select("id").distinct()
    texts = materialize(plain.select("id", "t").join(wanted, "id", "left_semi").dropDuplicates(["id", "t"]), "texts")
    small = materialize(reps.join(wanted, "id", "left_semi"), "small")
    bitmap = small.select("id", "n", "bits")
    bitmap2 = small.select(F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))

    def links(pairs: DataFrame, name: str) -> DataFrame:
        listed = pairs.where("id <> id2").select("id", "id2").distinct()
        possible = listed.join(bitmap, "id").join(bitmap2, "id2").where(may_link(percent)).select("id", "id2")
        return materialize(confirmed(materialize(possible, "possible"), texts, size, percent), name)

    def joined_by(found: DataFrame, more: DataFrame) -> DataFrame:
        """The components when further links are known: those before count as links to their smallest id."""
        stars = found.select("id", F.col("component_id").alias("id2"))
        return components(stars.unionByName(more), "id", "id2")

    known_by = busy.groupBy("id").agg(F.sum("n_in").alias("met"))
    pivots = busy.join(known_by, "id").groupBy("key").agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("id2"))
    found = components(links(busy.join(pivots, "key"), "links1"), "id", "id2")

    split, outside = rivals(busy, found)
    pivots = split.where("comp = main").groupBy("key").agg(F.min_by("id", F.xxhash64("key", "id")).alias("id2"))
    found = joined_by(found, links(outside.join(pivots, "key"), "links2"))

    split, outside = rivals(busy, found)
    pairs = remaining_pairs(split, outside, small, percent, bands, cell)
    pairs = pairs.select(F.least("id", "id2").alias("id"), F.greatest("id", "id2").alias("id2")).distinct()
    last = materialize(confirmed(materialize(pairs, "possible"), texts, size, percent), "links3")
    found = joined_by(found, last.unionByName(copies))

    there, back = carried(docs, ("n_shingles", "component_id", "kept"))
    sizes = signed.select("id", "row", "n_shingles").distinct()
    out = docs.select(*there, F.col(f"`{doc_id}`").cast("long").alias("id__"), F.xxhash64(F.col(f"`{text}`")).alias("row__"))
    sizes = sizes.join(found, "id", "left").select(
        F.col("id").alias("id2__"), F.col("row").alias("row2__"), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )
    out = out.join(sizes, F.col("id__").eqNullSafe(F.col("id2__")) & (F.col("row__") == F.col("row2__")), "left")
    same_id = F.coalesce(F.col("id__") == F.col("component_id"), F.lit(True))
    return out.select(*back, "n_shingles", "component_id", same_id.alias("kept"))
