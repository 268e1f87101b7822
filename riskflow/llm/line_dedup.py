"""Line deduplication: hashes of all runs of enough words, and winnowed fingerprints of shorter ones, extended both ways.

A document is the sequence of its lines that have a word; two lines are equal if their words are, letter case aside.
A window is the shortest run of lines with at least ``guarantee`` words from some line on, or up to some line. All
windows are compared: one that stands earlier too is deleted. The windows of a run of ``guarantee`` words cover each of
its lines, so such a run is never missed, whichever earlier document holds it.
A gram is the shortest run of lines from some line on with at least ``noise`` words. Each window selects its gram of
smallest hash as a fingerprint; the grams find shorter runs, which are deleted as far as a link reaches them, not
always. No run of fewer than ``noise`` words is ever deleted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.words import hash_words, mix, with_columns
from riskflow.session import materialize


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, words, number) of each line that has a word; ``number`` counts all lines."""
    lines = text.split(b"\n")
    words = hash_words(lines)
    counts = np.diff(words.bounds)
    place = np.arange(len(words.hashes)) - np.repeat(words.bounds[:-1], counts)
    with np.errstate(over="ignore"):
        parts = mix(words.hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
        hashes = mix(total[words.bounds[1:]] - total[words.bounds[:-1]] + counts.astype(np.uint64))
    used = np.flatnonzero(counts)
    return hashes[used], counts[used], used


def run_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each run of lines from ``start`` to the line before ``end``."""
    found = hashes[start]
    with np.errstate(over="ignore"):
        for k in range(1, int((end - start).max(initial=0))):
            on = np.flatnonzero(start + k < end)
            found[on] = mix(found[on] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[start[on] + k])
    return found


def windows(hashes: np.ndarray, counts: np.ndarray, guarantee: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first line, number of lines, hash) of the shortest runs of ``guarantee`` words, from each line on and up to each."""
    n = len(hashes)
    total = np.concatenate([[0], np.cumsum(counts)])
    line = np.arange(n)
    end = np.searchsorted(total, total[:-1] + guarantee)
    start = np.searchsorted(total, total[1:] - guarantee, "right") - 1
    on, upto = end <= n, start >= 0
    code = np.unique(np.concatenate([line[on] * (n + 1) + end[on], start[upto] * (n + 1) + line[upto] + 1]))
    at, after = code // (n + 1), code % (n + 1)
    with np.errstate(over="ignore"):
        # another constant, so that no gram has the hash of a window
        found = mix(run_hashes(hashes, at, after) + np.uint64(0xA0761D6478BD642F))
    return at, after - at, found


def fingerprints(hashes: np.ndarray, counts: np.ndarray, noise: int, guarantee: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first line, number of lines, hash) of the grams that the windows select."""
    n = len(hashes)
    none = np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(counts)])
    gram_end = np.searchsorted(total, total[:-1] + noise)  # line after the gram that starts at each line
    window_end = np.searchsorted(total, total[:-1] + guarantee)
    starts = int((gram_end <= n).sum())
    if not starts:
        return none, none, none.astype(np.uint64)
    gram_end, window_end = gram_end[:starts], np.minimum(window_end[:starts], n + 1)
    grams = run_hashes(hashes, np.arange(starts), gram_end)
    chosen, best = set(), -1
    for i in range(starts):
        if window_end[i] > n:
            break
        # grams that start at i or later and end within the window
        last = int(np.searchsorted(gram_end, window_end[i], "right"))
        if best < i:
            best = i + int(np.argmin(grams[i:last]))
            seen = last
        else:
            if last > seen:
                j = seen + int(np.argmin(grams[seen:last]))
                if grams[j] < grams[best]:
                    best = j
            seen = max(seen, last)
        chosen.add(best)
    at = np.array(sorted(chosen), np.int64)
    return at, gram_end[at] - at, grams[at]


def extended(own: np.ndarray, other: np.ndarray, start: int, there: int, length: int) -> tuple[int, int]:
    """The matched run around own[start] = other[there], grown both ways: first line, line after the last."""
    a, b = start, start + length
    reach = min(a, there)
    if reach:
        same = own[a - reach : a][::-1] == other[there - reach : there][::-1]
        a -= reach if same.all() else int(np.argmin(same))
    after = there + length
    reach = min(len(own) - b, len(other) - after)
    if reach > 0:
        same = own[b : b + reach] == other[after : after + reach]
        b += reach if same.all() else int(np.argmin(same))
    return a, b


def linked_runs(own: np.ndarray, other: np.ndarray, found: list[dict]) -> list[tuple[int, int]]:
    """The matched runs around all links of two documents, whatever their order.

    A link is left out only if it adds no line: where a run of its own alignment holds it, or where another run holds
    all that its alignment could reach.
    """
    runs: set[tuple[int, int]] = set()
    done: dict[int, int] = {}  # by alignment, the end of its last run
    widest = (0, 0)
    for at, at2, n in sorted((x["at"], x["at2"], x["n"]) for x in found):
        shift = at - at2
        if at < done.get(shift, 0) or (widest[0] <= max(0, shift) and min(len(own), len(other) + shift) <= widest[1]):
            continue
        run = extended(own, other, at, at2, n)
        done[shift] = run[1]
        runs.add(run)
        widest = max(widest, run, key=lambda r: r[1] - r[0])
    return sorted(runs)


MARK = T.StructType([T.StructField(n, T.LongType()) for n in ("at", "n", "gram", "left", "right")])
WINDOW = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("key", T.LongType())])
RANGE = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
_MARKS = pa.list_(pa.struct([(f.name, pa.int64()) for f in MARK]))
_WINDOWS = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("key", pa.int64())]))
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def document_key(doc_id: str, text: str) -> list[Column]:
    """Columns (id, row) by which a document is known; rows of equal id and text are one document."""
    lowest = F.lit(-(2**63)).cast("long")
    return [
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), lowest).alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("row"),
    ]


def sequences(docs: DataFrame, text: str, doc_id: str, noise: int, guarantee: int) -> DataFrame:
    """(id, row, hashes, marks, windows): the line hashes of each document, as bytes, its fingerprints and its windows."""
    new = T.StructType(
        [T.StructField("hashes", T.BinaryType()), T.StructField("marks", T.ArrayType(MARK)), T.StructField("windows", T.ArrayType(WINDOW))]
    )

    def start():
        def make(texts: list[bytes]) -> list[pa.Array]:
            found, marks, wholes = [], [], []
            for t in texts:
                hashes, counts, _ = line_hashes(t)
                at, n, grams = fingerprints(hashes, counts, noise, guarantee)
                around = np.concatenate([np.zeros(1, np.uint64), hashes, np.zeros(1, np.uint64)])
                with np.errstate(over="ignore"):
                    # the gram with the line before it, and with the line after it
                    left = mix(grams * np.uint64(0x9E3779B97F4A7C15) + around[at])
                    right = mix(grams * np.uint64(0xD1342543DE82EF95) + around[at + n + 1])
                found.append(hashes.tobytes())
                rows = zip(at.tolist(), n.tolist(), *(x.view(np.int64).tolist() for x in (grams, left, right)), strict=True)
                marks.append([dict(zip(MARK.names, row, strict=True)) for row in rows])
                wholes.append(windows(hashes, counts, guarantee))
            cuts = pa.array(np.cumsum([0, *(len(w[0]) for w in wholes)]).astype(np.int32))
            at, n, key = (np.concatenate([w[k] for w in wholes]) for k in range(3))
            rows = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key.view(np.int64))], fields=list(_WINDOWS.value_type))
            return [pa.array(found, pa.binary()), pa.array(marks, _MARKS), pa.ListArray.from_arrays(cuts, rows, type=_WINDOWS)]

        return make

    keyed = docs.select(*document_key(doc_id, text), F.col(f"`{text}`").alias("t"))
    return with_columns(keyed, "t", new, start, keep_text=False)


def repeated_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", noise: int = 25, guarantee: int = 50) -> DataFrame:
    """(id, row, runs): runs of word-bearing lines that stand earlier too, as ranges that may overlap.

    Earlier means in a document of smaller id (null ids first, then by a hash of the text), or further up in the same
    one. A window is a run if its first occurrence is earlier. A fingerprint is compared with the first occurrence of
    its gram, of its gram with the line before, and of its gram with the line after: three links at most, however many
    documents share it. Firsts are aggregated before the shuffle.
    """
    lines = materialize(sequences(docs, text, doc_id, noise, guarantee).dropDuplicates(["id", "row"]), "lines")
    marks = lines.select("id", "row", F.explode("marks").alias("m"))
    keys = F.explode(F.array("m.gram", "m.left", "m.right")).alias("key")
    marks = marks.select("id", "row", F.col("m.at").cast("int").alias("at"), F.col("m.n").cast("int").alias("n"), keys, F.lit(False).alias("whole"))
    wholes = lines.select("id", "row", F.explode("windows").alias("w")).select("id", "row", "w.at", "w.n", "w.key", F.lit(True).alias("whole"))
    marks = marks.unionByName(wholes)
    place = F.struct("id", "row", "at")
    firsts = marks.groupBy("key").agg(F.min(place).alias("there"), F.count("*").alias("seen"))
    links = marks.join(firsts.where("seen > 1").drop("seen"), "key").where(F.col("there") < place)
    # windows need no other document: those of one document are a group without id2 and row2
    id2, row2, at2 = (F.when(~F.col("whole"), F.col(f"there.{c}")).alias(f"{c}2") for c in ("id", "row", "at"))
    links = links.groupBy("id", "row", id2, row2).agg(F.collect_set(F.struct("at", at2, "n")).alias("found"))
    links = materialize(links, "links")
    covered = F.transform("found", lambda x: F.struct(x["at"].alias("a"), (x["at"] + x["n"]).alias("b")))
    wholly = links.where("row2 IS NULL").select("id", "row", covered.alias("runs"))
    own = lines.select("id", "row", F.col("hashes").alias("own"))
    other = lines.select(F.col("id").alias("id2"), F.col("row").alias("row2"), F.col("hashes").alias("other"))
    joined = links.join(own, ["id", "row"]).join(other, ["id2", "row2"]).select("id", "row", "found", "own", "other")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for found, a, b in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                mine, theirs = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                runs.append([{"a": p, "b": q} for p, q in linked_runs(mine, theirs, found)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, _RANGES)], names=["id", "row", "runs"])

    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("runs", RANGE)])
    each = joined.mapInArrow(run, kind).unionByName(wholly)
    return each.groupBy("id", "row").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def without(text: bytes, runs: list[dict]) -> tuple[bytes, int, int]:
    """The text without the lines of the runs; the lines with a word, and how many of them were deleted."""
    lines = text.split(b"\n")
    used = [i for i, line in enumerate(lines) if line and not line.isspace()]
    gone = {used[i] for run in runs for i in range(run["a"], run["b"])}
    kept = text if not gone else b"\n".join(line for i, line in enumerate(lines) if i not in gone)
    return kept, len(used), len(gone)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", noise: int = 25, guarantee: int = 50) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from ``text``, and ``n_lines`` and ``n_deleted`` (lines).

    The first occurrence of a run stays, also within a document; blank lines stay. Every document is returned, a copy
    of an earlier one with an empty text. Null texts come back as empty. Rows of equal id and text are treated as one
    document, so neither is deleted because of the other. Long texts are handled whole. Columns named like the new
    ones are replaced.
    """
    runs = repeated_runs(docs, text, doc_id, noise, guarantee)
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_deleted")]
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(kept)], *document_key(doc_id, text))
    joined = keyed.join(runs, ["id", "row"], "left").drop("id", "row")
    new = T.StructType([T.StructField("new_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())])

    def start():
        def make(texts: list[bytes], found: list[list[dict] | None]) -> list[pa.Array]:
            made = [without(t, r or []) for t, r in zip(texts, found, strict=True)]
            return [pa.array([m[0].decode("utf-8", "replace") for m in made], pa.string()), *(pa.array([m[k] for m in made], pa.int64()) for k in (1, 2))]

        return make

    at = kept.index(text)
    cut = with_columns(joined, f"o{at}", new, start, beside="runs")
    back = [F.col("new_text" if i == at else f"o{i}").alias(c) for i, c in enumerate(kept)]
    return cut.select(*back, "n_lines", "n_deleted")
