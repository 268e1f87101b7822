"""Token ids of a corpus as binary files: encoded by a tokenizer, packed block by block, and read back.

The ids of all documents stand one after the other in ascending order of doc_id, an end id behind each document. The
files are written by Spark, so they go to any store that it reaches and a lost task leaves nothing behind; a row of a
file is a segment of whole documents:

    part long       number of the file in document order
    segment long    number of the segment in its file
    first long      ids of the file before this segment
    n_ids long      ids of this segment
    doc_ids array   its documents, in order
    lengths array   ids of each, with the end id
    body binary     the ids as patched frame-of-reference blocks (``packed.py``)

Texts are sorted into ranges before they are encoded, so no task holds more than one range, and the ids that stand
before a file come from one sum per file. ``read_span`` uses the block index: it decodes only the blocks it needs.

A null text counts as empty: its document holds the end id alone. Rows of one doc_id are kept, ordered by a hash of
their texts; rows without a doc_id stand first. An empty table gives no segment. Extra columns are left out.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.llm.packed import pack, unpack
from riskflow.llm.words import chunks_of, texts_as_bytes

SEGMENT = "part long, segment long, first long, n_ids long, doc_ids array<long>, lengths array<long>, body binary"
SEGMENT_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("part", "segment", "first", "n_ids")]
    + [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("body", pa.binary())]
)
#: pieces whose ids a worker keeps, the longest kept, and ids kept; when full, pieces not met again are forgotten
KEPT_PIECES = 1_000_000
KEPT_BYTES = 40
KEPT_IDS = 8_000_000
#: bytes of texts whose pieces are looked up together, and pieces that the library encodes at once
TOGETHER = 1 << 22
AT_ONCE = 1 << 13

# What a byte is to the tokenizer of byte-level BPE. Of other than ASCII characters, only those are told whose first byte
# is that of no white space, and letters of two bytes (U+0100 to U+023F; those of U+00C0 to U+00FF but two).
_BYTES = np.arange(256)
_VISIBLE, _LETTER, _MARK, _SPACE, _FEED, _LEADS_2, _LEADS_3, _LATIN = (np.uint8(1 << k) for k in range(8))
_CLASS = np.zeros(256, np.uint8)
for _kind, _those in (
    (_VISIBLE, (_BYTES > 0x20) & (_BYTES < 0x7F)),
    (_LETTER, np.isin(_BYTES, list(string.ascii_letters.encode()))),
    (_MARK, np.isin(_BYTES, list(string.punctuation.encode()))),
    (_SPACE, _BYTES == 0x20),
    (_FEED, _BYTES == 0x0A),
    (_LEADS_2, (_BYTES > 0xC2) & (_BYTES < 0xE0)),
    (_LEADS_3, (_BYTES > 0xE3) & (_BYTES < 0xF0)),
    (_LATIN, (_BYTES > 0xC3) & (_BYTES < 0xC9)),
):
    _CLASS[_those] |= _kind
_STARTS = _VISIBLE | _LEADS_2 | _LEADS_3


def cuts(data: np.ndarray) -> np.ndarray:
    """Flags the bytes of UTF-8 that no token of byte-level BPE joins to the one before, wherever that is easily told.

    These are a space before a visible character, a mark behind a letter, a line feed behind a visible character, and a
    visible character behind such a line feed alone.
    """
    kind = _CLASS[data]
    starts, feed = kind & _STARTS != 0, kind & _FEED != 0
    ends = kind & _VISIBLE != 0
    ends[1:] |= kind[:-1] & _LEADS_2 != 0
    ends[2:] |= kind[:-2] & _LEADS_3 != 0
    letter = kind & _LETTER != 0
    letter[1:] |= (kind[:-1] & _LATIN != 0) | ((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    cut = np.zeros(len(data), bool)
    cut[:-1] = (kind[:-1] & _SPACE != 0) & starts[1:]
    cut[1:] |= (feed[1:] & ends[:-1]) | ((kind[1:] & _MARK != 0) & letter[:-1])
    cut[2:] |= starts[2:] & feed[1:-1] & ends[:-2]
    return cut


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library, without special tokens.

    For byte-level BPE, texts are cut where no token can reach across, each different piece is encoded once by the
    library, and its ids are kept under a number; all other tokenizers get whole texts. Strings of special tokens are
    ordinary text.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(vocabulary)
        self.own.encode_special_tokens = True
        entries = self.own.get_vocab(with_added_tokens=True)
        self.kind = np.uint16 if max(entries.values(), default=0) < 1 << 16 else np.uint32
        described = json.loads(vocabulary)
        steps, model = described.get("pre_tokenizer") or {}, described["model"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.cuts = described.get("normalizer") is None and model["type"] == "BPE" and not model.get("dropout") and plain.items() <= steps.items()
        self.size = np.zeros(max(entries.values(), default=0) + 1, np.int64)
        for entry, i in entries.items():
            self.size[i] = len(entry)  # a character of an entry stands for a byte
        self.pieces: dict[bytes, int] = {}  # their numbers
        # number i has ids[ends[i] : ends[i + 1]], and number 0 has none
        self.ids, self.ends, self.met = np.zeros(0, self.kind), np.zeros(2, np.int64), np.zeros(1, bool)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``numbers``, and how many stand up to the end of each."""
        starts = self.ends[numbers]
        sizes = self.ends[numbers + 1] - starts
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(starts - ends + sizes, sizes) + np.arange(sizes.sum())], ends

    def _learn(self, pieces: pa.LargeBinaryArray) -> np.ndarray:
        """Numbers of new pieces. Those of a space and a visible character stand in one text, the others by themselves."""
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        kind, sizes = _CLASS[np.frombuffer(pieces.buffers()[2], np.uint8)], np.diff(bounds)
        follow = (sizes > 1) & (kind[bounds[:-1]] == _SPACE)
        follow[follow] = kind[bounds[:-1][follow] + 1] & _STARTS != 0
        numbers, first = np.empty(len(pieces), np.int64), len(self.ends) - 1
        ids, ends = [self.ids], [self.ends]
        for together in (True, False):
            own = np.flatnonzero(follow == together)
            numbers[own] = np.arange(first, first + len(own))
            first += len(own)
            for a in range(0, len(own), AT_ONCE):
                some = pieces.take(pa.array(own[a : a + AT_ONCE])).to_pylist()
                if together:
                    found = self._whole([b"".join(some).decode()])
                    upto = np.searchsorted(np.cumsum(self.size[found[0]]), np.cumsum(sizes[own[a : a + AT_ONCE]])) + 1
                else:
                    found = self._whole([p.decode() for p in some])
                    upto = np.cumsum([len(x) for x in found])
                ends.append(upto + ends[-1][-1])
                ids += found
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)
        self.met = np.concatenate([self.met, np.zeros(len(pieces), bool)])
        kept = np.flatnonzero(sizes <= KEPT_BYTES)
        self.pieces.update(zip(pieces.take(pa.array(kept)).to_pylist(), numbers[kept].tolist(), strict=True))
        return numbers

    def _forget(self) -> None:
        """Keep only pieces that were met again since the last time, and none if these are too many."""
        kept = [p for p, i in self.pieces.items() if self.met[i]]
        ids, ends = self._of(np.array([0, *(self.pieces[p] for p in kept)], np.int64))
        if 2 * len(kept) > KEPT_PIECES or 2 * len(ids) > KEPT_IDS:
            kept, ids, ends = [], ids[:0], ends[:1]
        self.pieces = {p: i for i, p in enumerate(kept, 1)}
        self.ids, self.ends, self.met = ids, np.concatenate([[0], ends]), np.zeros(len(ends), bool)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.cuts or not texts:
            return self._whole(texts)
        raw = [text.encode() for text in texts]
        joined = b"\n".join(raw) + b"\n"
        last = np.cumsum([len(r) + 1 for r in raw]) - 1  # the line feed behind each text
        cut = cuts(np.frombuffer(joined, np.uint8))
        cut[last] = cut[0] = True
        cut[last[:-1] + 1] = True
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(joined)).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(joined)]).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.pieces.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(numbers < 0)
        self.met[numbers[numbers >= 0]] = True
        if len(new):
            numbers[new] = self._learn(coded.dictionary.take(pa.array(new)))
        numbers = numbers[coded.indices.to_numpy()]
        behind = np.searchsorted(starts, last)
        numbers[behind] = 0
        ids, ends = self._of(numbers)
        if len(self.pieces) > KEPT_PIECES or len(self.ids) > KEPT_IDS:
            self._forget()
        return np.split(ids, ends[behind[:-1]])


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """One encoder per worker, so that its pieces serve all tasks."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end: int,
    doc_id: str = "doc_id",
    text: str = "text",
    segment_ids: int = 1 << 20,
    percentile: float = 90.0,
) -> None:
    """Write the ids of all ``docs`` to ``path``, which must be reachable by every executor.

    ``vocabulary`` is the tokenizer's file, read by the driver and broadcast (its size does not depend on the data).
    A segment is closed at the first document that reaches ``segment_ids``.
    """
    with open(vocabulary, encoding="utf-8") as lines:
        shared = docs.sparkSession.sparkContext.broadcast(lines.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(shared.value), TaskContext.get().partitionId()
        closing, segment, first = np.array([end], np.uint32), 0, 0
        ids, docs_of, lengths, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            row = [part, segment, first, held, docs_of, lengths, pack(np.concatenate(ids), percentile)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, SEGMENT_ARROW, strict=True)], schema=SEGMENT_ARROW)

        for rows, texts in chunks_of(batches, "t", TOGETHER):
            for own, found in zip(rows.column(0).to_pylist(), encoder.encode([t.decode() for t in texts]), strict=True):
                ids += [found.astype(np.uint32), closing]
                docs_of.append(own)
                lengths.append(len(found) + 1)
                held += len(found) + 1
                if held >= segment_ids:
                    yield closed()
                    segment, first = segment + 1, first + held
                    ids, docs_of, lengths, held = [], [], [], 0
        if docs_of:
            yield closed()

    # equal rows of a hot id are told apart by the task that read them, so they do not fill one range
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), texts_as_bytes(F.col(f"`{text}`")).alias("t"))
    order = [F.col("d"), F.xxhash64("t"), F.xxhash64(F.spark_partition_id())]
    rows = rows.select("d", "t", order[1].alias("h"), order[2].alias("p"))
    ranges = rows.repartitionByRange("d", "h", "p").sortWithinPartitions("d", "h", "p")
    ranges.select("d", "t").mapInArrow(run, SEGMENT).write.option("compression", "zstd").parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the ids of the whole corpus before each."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    sizes = segments.groupBy(F.col("part").alias("of_part")).agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("of_part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    # one row per file, and there are no more files than shuffle partitions
    joined = segments.join(F.broadcast(starts), F.col("part") == F.col("of_part"))
    return joined.withColumn("start", F.col("before") + F.col("first")).drop("before", "of_part")


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of the files.

    ``start`` counts the ids before the document, ``ids`` are little-endian unsigned 32-bit integers with the end id,
    and ``ids_crc32`` is their unsigned checksum, taken from the decoded ids. Without ``with_ids`` the last column is
    left out, and the decoded ids stay in the task.
    """
    out = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")] + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, docs, lengths = (batch.column(c)[row].as_py() for c in range(3))
                ids = unpack(batch.column(3)[row].as_py()).astype("<u4")
                ends = np.cumsum(lengths)
                cuts = list(zip((ends - lengths).tolist(), ends.tolist(), strict=True))
                for at in range(0, len(cuts), 256):
                    raw = [ids[a:b].tobytes() for a, b in cuts[at : at + 256]]
                    columns = [
                        docs[at : at + 256],
                        [start + a for a, _ in cuts[at : at + 256]],
                        lengths[at : at + 256],
                        [zlib.crc32(r) for r in raw],
                        *([raw] * with_ids),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    found = _segments(spark, path).select("start", "doc_ids", "lengths", "body")
    return found.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def read_span(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, ids) of the parts of segments that hold the ids ``first`` to ``last`` (exclusive) of the corpus.

    Segments outside the span are left out by their counts, and of the others only the blocks inside are decoded.
    """
    out = pa.schema([("start", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, body in zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True):
                a = max(0, first - start)
                ids = unpack(body, a, last - start)
                yield pa.RecordBatch.from_arrays([pa.array([start + a], pa.int64()), pa.array([ids.astype(np.int64)], out[1].type)], schema=out)

    inside = (F.col("start") < last) & (F.col("start") + F.col("n_ids") > first)
    return _segments(spark, path).where(inside).select("start", "body").mapInArrow(run, "start long, ids array<long>")
