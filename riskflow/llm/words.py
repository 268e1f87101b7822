"""Words of many texts at once, in numpy.

A word is a longest run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; in UTF-8 that is the same as a run of such
characters. Texts are handled in chunks of a quarter megabyte, so memory does not grow with a batch, and one very long
text is a chunk by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def texts_as_bytes(text: Column) -> Column:
    """A text column as UTF-8; null becomes empty."""
    return F.coalesce(text.cast("binary"), F.lit(bytearray()))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole value; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(salt)) | np.uint64(1)


class Words(NamedTuple):
    hashes: np.ndarray  # uint64 of each word, in text order
    bounds: np.ndarray  # words of text t are hashes[bounds[t]:bounds[t + 1]]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = next((known for known in _powers if known >= n), 1 << max(18, int(n - 1).bit_length()))
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE)]), dtype=np.uint64)
            down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE_INVERSE)]), dtype=np.uint64)
        _powers[size] = up, down
    return _powers[size]


class _Spans:
    """Where the words of joined texts are, and hashes of any part of them."""

    def __init__(self, texts: Sequence[bytes], lower: bool, apart: np.ndarray):
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends_of_text = np.cumsum([len(t) + 1 for t in texts])
        space = apart[joined]
        inside = ~space
        self.starts = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
        self.ends = np.flatnonzero(space & np.concatenate([[False], inside[:-1]]))
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], ends_of_text]))
        up, self.down = _power(len(joined))
        data = (_LOWER[joined] if lower else joined).astype(np.uint64)
        with np.errstate(over="ignore"):
            self.total = np.zeros(len(joined) + 1, np.uint64)
            np.cumsum((data + np.uint64(1)) * up[: len(joined)], out=self.total[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            part = (self.total[ends] - self.total[starts]) * self.down[starts]
            return mix(part + (ends - starts).astype(np.uint64))


def hash_words(texts: Sequence[bytes], lower: bool = True, apart: np.ndarray = _SPACE, first: int = 0) -> Words:
    """64-bit hashes of all words: a polynomial of their bytes, mixed; the same in every process.

    ``apart`` flags the bytes that separate words (line feed must be one). With ``first``, only so many bytes at the
    start of each word are hashed, and shorter words count as empty.
    """
    spans = _Spans(texts, lower, apart)
    ends = spans.ends
    if first:
        ends = np.where(ends - spans.starts > first, spans.starts + first, spans.starts)
    return Words(spans.hashes(spans.starts, ends), spans.bounds)


def hash_words_and_ends(texts: Sequence[bytes], last: int) -> tuple[Words, np.ndarray]:
    """Hashes of all words in lower case, and of the last bytes of each, ``last`` at most."""
    spans = _Spans(texts, True, _SPACE)
    words = Words(spans.hashes(spans.starts, spans.ends), spans.bounds)
    return words, spans.hashes(np.maximum(spans.starts, spans.ends - last), spans.ends)


def positions_of(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted vocabulary; its length for all others."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at, len(vocabulary))


def in_chunks(sizes: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to about ``limit``."""
    start, held, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size + 1
    if i >= start:
        yield start, i + 1


def chunks_of(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of record batches with the texts, as UTF-8, of a binary or string column; null is empty."""
    for batch in batches:
        kind = pa.large_binary() if pa.types.is_large_string(batch.column(column).type) else pa.binary()
        for a, b in in_chunks(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist(), limit):
            piece = batch.slice(a, b - a)
            texts = piece.column(column)
            texts = texts.cast(kind) if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else texts
            yield piece, [t or b"" for t in texts.to_pylist()]
        del batch
        pa.default_memory_pool().release_unused()  # an idle worker holds on to no batch


def top_counts(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows of (key, n) with the largest n, ties by key; keys are 64-bit hashes.

    A histogram of n (16 bins for each doubling, so at most 1024 rows) tells first which rows can be among them, so no
    task gets ``size`` rows of every partition. Bins up to 71 hold a single n; there the keys are bounded too.
    """
    bar = F.floor(16 * F.log2("n")).cast("int")
    bars = sorted(counts.groupBy(bar.alias("bar")).agg(F.count("*").alias("rows")).collect(), reverse=True)
    held = 0
    for r in bars:
        if held + r.rows < size:
            held += r.rows
            continue
        near = counts.where(bar >= r.bar)
        share = (2 * (size - held) + 1000) / r.rows
        if r.bar <= 71 and share < 1:
            low = F.col("key") < -(1 << 63) + int(share * 2**64)
            if counts.where((bar == r.bar) & low).count() >= size - held:
                near = near.where((bar > r.bar) | low)
        counts = near
        break
    return counts.orderBy(F.desc("n"), "key").limit(size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(df: DataFrame, replaced: Iterable[str] = ()) -> tuple[list[Column], list[Column]]:
    """The columns of ``df`` under numbered names, which clash with none, and back; ``replaced`` ones are left out."""
    names = set(replaced)
    kept = [c for c in df.columns if c.lower() not in names]
    return [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], [F.col(f"c{i}").alias(c) for i, c in enumerate(kept)]


_held: dict[Hashable, object] = {}


def held[T](key: Hashable, make: Callable[[], T]) -> T:
    """What a worker process has made under a key, kept for its next tasks until ``let_go``."""
    if key not in _held:
        _held[key] = make()
    return _held[key]


def let_go(but: Hashable = None) -> None:
    """Drop what tasks of other operators left in this worker process: Spark gives its workers to any task."""
    others = [key for key in _held if key != but]
    for key in others:
        del _held[key]
    if others:
        pa.system_memory_pool().release_unused()


def with_columns(
    df: DataFrame,
    text: str,
    new: T.StructType,
    start: Callable[[], Callable[..., list[pa.Array]]],
    beside: str | None = None,
    keep_text: bool = True,
    holds: Hashable = None,
) -> DataFrame:
    """``df`` with columns computed from the texts of column ``text`` in Arrow batches of about a quarter megabyte.

    ``start`` is called once per task and gives a function from texts (null as empty) to one array per new column.
    With ``beside`` that function gets the values of this column as a second argument. Without ``keep_text`` that column
    is left out, so texts do not come back from the workers. ``holds`` is the key of what ``start`` keeps by ``held``.
    Old columns of the same names are replaced. Columns travel under numbered names, so names that differ only by
    case or hold dots do no harm. A string column that is kept travels once, as text and as old column.
    """
    names = {n.lower() for n in new.names} | (set() if keep_text else {text.lower()})
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)] + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(new.fields)])
    olds = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)]
    width, at = len(kept), None if beside is None else [f.name for f in kept].index(beside)
    own = next((f"c{i}" for i, f in enumerate(kept) if f.name == text and isinstance(f.dataType, T.StringType)), None)
    plain = df.select(*olds) if own else df.select(*olds, texts_as_bytes(F.col(f"`{text}`")).alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(holds)
        make = start()
        for rows, texts in chunks_of(batches, own or "t"):
            more = [] if at is None else [rows.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns[:width], *make(texts, *more)], names=inner.names)

    made = plain.mapInArrow(run, inner)
    back = [F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept)]
    return made.select(*back, *[F.col(f"n{i}").alias(f.name) for i, f in enumerate(new.fields)])


def crc_of(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus
