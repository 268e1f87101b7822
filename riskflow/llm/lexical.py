"""Ranked lexical search over an index that is stratified by document length.

Documents of an equal length normaliser m form a stratum. A stratum is indexed in pieces of bounded size; a piece holds
the ids of its documents and, for each term, its postings ordered by term frequency. Within a piece the impact of a
posting depends on its frequency alone, so impacts are computed once per frequency. The largest frequency of each term
bounds what a piece can give to a query: pieces are visited in waves from the highest bound down, and a piece whose
bound is below the score of the k-th best document found so far is never opened.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased, and compared by
64-bit hashes. With N documents that hold a term, L terms in all, n terms in a document, tf of one of them and df
documents that hold it:

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))       m = 75 + (25 n N) div L
    score = sum over the query's terms, repeats included, of w ((10^9 tf) div (1000 tf + 12 m))

A null or empty text holds no term: such a document is never found, such a query finds nothing. Rows of one doc_id are
documents of their own, and equal rows are found as often as they stand; a document without an id is found without
one, after all others of its score. Equal queries are answered once, different texts of one item_id each for itself.
Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.words import chunks_of, hash_words, in_chunks, texts_as_bytes, with_columns
from riskflow.session import materialize

# Fixed value: the bytes that separate terms. Outside ASCII every character belongs to a term.
_APART = np.ones(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _APART[_first : _last + 1] = False

#: a row with a null term holds the ids of the piece's documents, all others the postings of a term: for each of its
#: frequencies ascending the number of documents, and their places in the piece; largest and ``docs`` are counts
POSTING = "m long, piece long, term long, docs long, largest long, ids array<long>, tfs binary, counts binary, places binary"
POSTING_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("m", "piece", "term", "docs", "largest")]
    + [("ids", pa.list_(pa.int64()))]
    + [(n, pa.binary()) for n in ("tfs", "counts", "places")]
)


@dataclass(frozen=True)
class Index:
    """Stored postings, and the corpus totals that scores need: documents with a term, and their terms."""

    postings: DataFrame
    documents: int
    terms: int


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash of the term) of all terms, in text order."""
    parts, numbers = [], []
    for a, b in in_chunks([len(t) for t in texts]):
        words = hash_words(texts[a:b], True, _APART)
        parts.append(words.hashes.view(np.int64))
        numbers.append(a + np.repeat(np.arange(b - a), np.diff(words.bounds)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(parts)


def _counts(texts: list[bytes]) -> list[pa.Array]:
    """The number of terms of each text."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    apart = _APART[joined]
    ends = np.flatnonzero(apart[1:] & ~apart[:-1])
    bounds = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts]) - 1)
    return [pa.array(np.diff(bounds, prepend=0))]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys, and the end."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(new), len(keys[0]))


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Slices of a numpy array as binary values."""
    flat = np.ascontiguousarray(values)
    offsets = (cuts * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _index_piece(m: int, piece: int, ids: list[int | None], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
    ids, texts = [ids[i] for i in order], [texts[i] for i in order]
    doc, term = _terms(texts)
    order = np.argsort(term, kind="stable")  # documents stay in order within a term
    doc, term = doc[order], term[order]
    at = _runs(term, doc)
    doc, term, tf = doc[at[:-1]], term[at[:-1]], np.diff(at)
    order = np.lexsort((doc, tf, term))
    doc, term, tf = doc[order], term[order], tf[order]
    by_term = _runs(term)
    by_tf = _runs(term, tf)
    tf_cuts = np.searchsorted(by_tf, by_term)
    n = len(by_term) - 1
    none = pa.nulls(1, pa.binary())
    yield pa.RecordBatch.from_arrays(
        [*(pa.array([v], pa.int64()) for v in (m, piece, None, len(ids), None)), pa.array([ids], pa.list_(pa.int64())), none, none, none],
        schema=POSTING_ARROW,
    )
    columns = [
        pa.array(np.full(n, m)),
        pa.array(np.full(n, piece)),
        pa.array(term[by_term[:-1]]),
        pa.array(np.diff(by_term)),
        pa.array(tf[by_term[1:] - 1]),
        pa.nulls(n, pa.list_(pa.int64())),
        _blobs(tf[by_tf[:-1]].astype("<u4"), tf_cuts),
        _blobs(np.diff(by_tf).astype("<u4"), tf_cuts),
        _blobs(doc.astype("<u4"), by_term),
    ]
    whole = pa.RecordBatch.from_arrays(columns, schema=POSTING_ARROW)
    for a in range(0, n, 1 << 16):
        yield whole.slice(a, 1 << 16)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", piece_bytes: int = 1 << 24, piece_docs: int = 1 << 14) -> Index:
    """Index all ``docs``; a stratum is cut into pieces of about ``piece_bytes`` of text and ``piece_docs`` documents.

    The number of terms of each document is counted first, combined per number before the shuffle; the texts are then
    shuffled once, to their pieces. A piece is chosen by a hash of the row and of the task that read it, so neither a
    common length nor a group of copies fills one task.
    """
    whole = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), texts_as_bytes(F.col(f"`{text}`")).alias("t"))
    counted = with_columns(whole, "t", T.StructType([T.StructField("n", T.LongType())]), lambda: _counts).where("n > 0")
    lengths = materialize(counted.groupBy("n").agg(F.count("*").alias("docs"), F.sum(F.length("t")).alias("bytes")), "lengths")
    totals = lengths.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("documents"), F.coalesce(F.sum(F.col("n") * F.col("docs")), F.lit(1)).alias("terms")).first()
    normaliser = F.expr(f"75L + (25L * n * {totals.documents}L) div {totals.terms}L")
    pieces = F.ceil(F.greatest(F.col("bytes") / piece_bytes, F.col("docs") / piece_docs)).cast("long")
    strata = lengths.groupBy(normaliser.alias("of_m")).agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes")).select("of_m", pieces.alias("pieces"))
    spread = counted.withColumn("m", normaliser).join(strata, F.col("m") == F.col("of_m"))
    place = F.pmod(F.xxhash64("d", "t", F.spark_partition_id()), F.col("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        m, piece = table.column("m")[0].as_py(), table.column("piece")[0].as_py()
        yield from _index_piece(m, piece, table.column("d").to_pylist(), table.column("t").to_pylist())

    placed = spread.select("m", place.alias("piece"), "d", "t")
    postings = materialize(placed.groupBy("m", "piece").applyInArrow(run, POSTING), "postings")
    return Index(postings, totals.documents, totals.terms)


def query_terms(items: DataFrame, q: str, text: str) -> DataFrame:
    """(q, term, qtf) of the terms of each query."""
    out = pa.schema([("q", pa.int64()), ("term", pa.int64()), ("qtf", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks_of(batches, "t"):
            own, term = _terms(texts)
            order = np.lexsort((term, own))
            own, term = own[order], term[order]
            at = _runs(own, term)
            ids = np.asarray(rows.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(ids[own[at[:-1]]]), pa.array(term[at[:-1]]), pa.array(np.diff(at))], schema=out)

    return items.select(q, texts_as_bytes(F.col(text)).alias("t")).mapInArrow(run, "q long, term long, qtf long")


def _impact(tf: Column | np.ndarray, m: Column | int) -> Column | np.ndarray:
    if isinstance(tf, Column):
        return F.call_function("div", F.lit(1_000_000_000) * tf, F.lit(1000) * tf + F.lit(12) * m)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _score_piece(postings: pa.Table, wanted: pa.Table, k: int) -> pa.RecordBatch | None:
    """The best ``k`` documents of a piece for each query that visits it."""
    terms, places = postings.column("term").to_pylist(), postings.column("places")
    if not terms or not wanted.num_rows:
        return None
    head = terms.index(None)
    ids = postings.column("ids")[head].values
    m = postings.column("m")[head].as_py()
    tfs, counts = postings.column("tfs"), postings.column("counts")
    row_of = {t: i for i, t in enumerate(terms) if t is not None}
    impact_of: dict[int, int] = {}
    opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def open_term(term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in opened:
            i = row_of[term]
            own = np.frombuffer(tfs[i].as_py(), "<u4").tolist()
            for tf in own:
                if tf not in impact_of:
                    impact_of[tf] = _impact(tf, m)
            each = np.array([impact_of[tf] for tf in own], np.int64)
            opened[term] = np.frombuffer(places[i].as_py(), "<u4"), np.repeat(each, np.frombuffer(counts[i].as_py(), "<u4"))
        return opened[term]

    order = np.argsort(np.asarray(wanted.column("q")), kind="stable")
    q = np.asarray(wanted.column("q"))[order]
    term = np.asarray(wanted.column("term"))[order].tolist()
    weight = np.asarray(wanted.column("weight"))[order].tolist()
    cuts = _runs(q).tolist()
    found_q, found_doc, found_score = [], [], []
    for a, b in zip(cuts, cuts[1:]):
        total = np.zeros(len(ids), np.int64)
        for t, w in zip(term[a:b], weight[a:b], strict=True):
            if t in row_of:
                docs, impacts = open_term(t)
                total[docs] += w * impacts
        hits = np.flatnonzero(total)
        if len(hits) > k:
            least = np.partition(total[hits], len(hits) - k)[len(hits) - k]
            hits = hits[total[hits] >= least]
        best = hits[np.argsort(-total[hits], kind="stable")[:k]]  # documents are in order of their ids
        found_q.append(np.full(len(best), q[a]))
        found_doc.append(best)
        found_score.append(total[best])
    docs = np.concatenate(found_doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(found_q)), ids.take(pa.array(docs)), pa.array(np.concatenate(found_score))], names=["q", "doc_id", "score"]
    )


def search(
    index: Index,
    items: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    k: int = 20,
    first_wave: int = 16,
    item_block: int = 512,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each query; ties by doc_id.

    Queries meet the pieces in blocks of about ``item_block``, so no task holds all queries. ``first_wave`` pieces of
    each query are opened first, then sixteen times as many of those that can still hold a result, and so on. Both
    numbers steer only the order of work, never the result.
    """
    spark = items.sparkSession
    queries = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    queries = materialize(queries.distinct().withColumn("q", F.xxhash64("item_id", "text")), "queries")
    wanted = materialize(query_terms(queries, "q", "text"), "wanted")
    blocks = max(1, -(-queries.count() // item_block))

    named = index.postings.join(wanted.select("term").distinct(), "term", "left_semi").select(*index.postings.columns)
    hits = materialize(named.unionByName(index.postings.where("term is null")), "hits")
    df = hits.where("term is not null").groupBy("term").agg(F.sum("docs").alias("df"))
    inverse = F.lit(2.0 * index.documents + 2.0) / (2.0 * F.col("df") + 1.0)
    weighted = wanted.join(df, "term").select("q", "term", (F.col("qtf") * F.floor(1000.0 * F.log(inverse))).alias("weight"))
    weighted = materialize(weighted.where("weight > 0"), "weighted")

    ceilings = hits.where("term is not null").select("m", "piece", "term", _impact(F.col("largest"), F.col("m")).alias("ceiling"))
    bounds = weighted.join(ceilings, "term").groupBy("q", "m", "piece").agg(F.sum(F.col("weight") * F.col("ceiling")).alias("bound"))
    place = Window.partitionBy("q").orderBy(F.desc("bound"), "m", "piece")
    left = materialize(bounds.where("bound > 0"), "bounds")

    by_score = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = spark.createDataFrame([], "q long, doc_id long, score long")
    wave = first_wave
    while not left.isEmpty():
        opened = materialize(left.withColumn("place", F.row_number().over(place)).where(F.col("place") <= wave).drop("place"), "wave")
        visits = opened.select("q", "m", "piece", F.pmod("q", F.lit(blocks)).alias("block"))
        wants = visits.join(weighted, "q").select("m", "piece", "block", "q", "term", "weight")
        sides = hits.join(visits.select("m", "piece", "block").distinct(), ["m", "piece"])

        def run(postings: pa.Table, wanted: pa.Table) -> pa.Table:
            found = _score_piece(postings, wanted, k)
            empty = pa.schema([("q", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
            return pa.Table.from_batches([found] if found else [], empty)

        # a name of its own, since both sides come from the visits
        sides = sides.select("m", "piece", F.col("block").alias("block"), "term", "ids", "tfs", "counts", "places")
        keys = ["m", "piece", "block"]
        scored = sides.groupBy(*keys).cogroup(wants.groupBy(*keys)).applyInArrow(run, "q long, doc_id long, score long")
        ranked = scored.unionByName(best).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        best = materialize(ranked.drop("rank"), "best")
        # a piece that could only tie may still hold a smaller id
        floor = best.groupBy("q").agg(F.count("*").alias("found"), F.min("score").alias("least")).where(F.col("found") == k)
        rest = left.join(opened.select("q", "m", "piece"), ["q", "m", "piece"], "left_anti")
        rest = rest.join(floor.select("q", "least"), "q", "left").where("least is null or bound >= least")
        left = materialize(rest.drop("least"), "bounds")
        wave *= 16
    ranked = best.withColumn("rank", F.row_number().over(by_score))
    return ranked.join(queries.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
