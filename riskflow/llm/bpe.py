"""Byte-level BPE: exact encoding in linear time by backtracking over longest matches, and decoding.

Bytes are mapped to Latin-1 characters, so one Aho-Corasick automaton finds all vocabulary entries in a piece of text.
Encoding takes the longest entry at each position and steps back to a shorter one where two neighbours could not
stand side by side after the merges. Whether they can is computed once per pair and memoised; a position from which no
encoding goes on is never tried again, so a piece takes linear time.

The vocabulary is a parameter: a file of base64 entries and ranks, read by the driver and broadcast (its size does not
depend on the data).
"""

from __future__ import annotations

import base64
import uuid
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.words import held, let_go, with_columns
from riskflow.session import bound_batches

#: texts' pieces whose ids a task keeps; when full they are forgotten and gathered anew
KEPT_PIECES = 300_000
#: pairs of entries whose compatibility a task keeps, likewise
KEPT_PAIRS = 500_000

_NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """Entries and ranks of a vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(entry): int(rank) for entry, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Encodes one piece of text at a time by ranks; the text is cut into pieces by ``pattern``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.entry = {rank: entry for entry, rank in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no entry for {len(missing)} of the 256 bytes")
        self.size = [len(self.entry.get(rank, b"")) for rank in range(max(self.entry) + 1)]
        self.finder = ahocorasick.Automaton()
        self.single = [ranks[bytes([b])] for b in range(256)]
        for entry, rank in ranks.items():
            if len(entry) > 1:
                self.finder.add_word(entry.decode("latin-1"), rank)
        self.finder.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.last_merge: dict[int, tuple[int, int]] = {}
        self.kept: dict[str, bytes] = {}

    def halves(self, token: int) -> tuple[int, int]:
        """The two entries whose merge, the last one, makes an entry of several bytes."""
        found = self.last_merge.get(token)
        if found is None:
            entry = self.entry[token]
            parts = [entry[i : i + 1] for i in range(len(entry))]
            while len(parts) > 2:
                best, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if best == _NEVER:
                    raise ValueError(f"merges never make the entry of rank {token}")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.last_merge[token] = self.ranks[parts[0]], self.ranks[parts[1]]
        return found

    def neighbours(self, pair: tuple[int, int]) -> bool:
        """Whether the merges leave the two entries side by side.

        Goes back in time from the finished entries: the one made last is undone, so that its inner half meets the
        other. The two fail if what meets there would merge before the merge just undone; of equal merges the one
        further left comes first.
        """
        if len(self.fits) >= KEPT_PAIRS:
            self.fits.clear()
        entry, size, merge = self.entry, self.size, self.ranks.get
        left, right = pair
        until, fits = _NEVER, True
        while True:
            if merge(entry[left] + entry[right], _NEVER) < until:
                fits = False
                break
            undo_left = size[left] > 1 and (size[right] == 1 or left > right)
            if undo_left:
                until, left = left, self.halves(left)[1]
            elif size[right] > 1:
                until, right = right + 1, self.halves(right)[0]
            else:
                break
        self.fits[pair] = fits
        return fits

    def prefix(self, token: int) -> int:
        """The longest entry that is a proper prefix, or -1."""
        found = self.shorter.get(token)
        if found is None:
            entry = self.entry[token]
            found = next((self.ranks[entry[:n]] for n in range(len(entry) - 1, 0, -1) if entry[:n] in self.ranks), -1)
            self.shorter[token] = found
        return found

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, size, known = len(data), self.size, self.fits.get
        longest = list(map(self.single.__getitem__, data))
        for end, token in self.finder.iter(data.decode("latin-1")):
            longest[end + 1 - size[token]] = token  # ends grow, so the longest is set last
        stuck: set[int] = set()
        taken: list[int] = []
        last, at, token = -1, 0, longest[0]
        while at < n:
            end = at + size[token]
            if end not in stuck:
                fits = last < 0 or known(pair := (last, token))
                if fits is None:
                    fits = self.neighbours(pair)
                if fits:
                    taken.append(token)
                    last, at = token, end
                    if at < n:
                        token = longest[at]
                    continue
            token = self.prefix(token)
            while token < 0:  # no entry that starts here goes on: take back the one before
                stuck.add(at)
                back = taken.pop()
                last = taken[-1] if taken else -1
                at -= size[back]
                token = self.prefix(back)
        return taken

    def encode(self, text: str) -> bytes:
        """The ids of a text, as int32."""
        found = self.split(text)
        ids = list(map(self.kept.get, found))
        if None in ids:
            for i, known in enumerate(ids):
                if known is None:
                    ids[i] = self.kept.get(found[i]) or self.add(found[i])
        return b"".join(ids)

    def add(self, p: str) -> bytes:
        ids = array("i", self.piece(p.encode("utf-8"))).tobytes()
        if len(p) <= 64:
            if len(self.kept) >= KEPT_PIECES:
                self.kept.clear()
            self.kept[p] = ids
        return ids


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column of token ids (array of int); special tokens are ordinary text.

    Ids equal those of carrying out the merges one by one, piece by piece. Null and empty texts have no ids; a
    piece of any length is encoded whole; repeated rows are encoded each. A column already named ``ids`` is replaced;
    all others are kept as they are.
    """
    bound_batches(df.sparkSession)  # ids and texts go through two workers of each task
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    key = (path, pattern, uuid.uuid4().hex)
    new = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def start():
        one = held(key, lambda: Encoder(shared.value, pattern)).encode  # one for all tasks of a worker process

        def make(texts: list[bytes]) -> list[pa.Array]:
            found = [one(t.decode("utf-8", "replace")) for t in texts]
            cuts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(found), np.int32)))]

        return make

    return with_columns(df, text, new, start, holds=key)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes (binary) that the ids stand for. Null ids give empty bytes, an unknown id fails."""
    shared = df.sparkSession.sparkContext.broadcast({rank: entry for entry, rank in read_ranks(path).items()})
    kept = [f for f in df.schema.fields if f.name.lower() != decoded.lower()]
    plain = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)], F.col(ids).alias("t"))
    out = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)] + [T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        entry = shared.value.__getitem__
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256)
                lists = rows.column("t")
                flat = np.asarray(lists.flatten()).tolist()
                ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0))).tolist()
                texts = pa.array([b"".join(map(entry, flat[x:y])) for x, y in zip([0, *ends], ends)], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], texts], names=out.names)

    coded = plain.mapInArrow(run, out)
    return coded.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept)], F.col("bytes").alias(decoded))
