"""Quality rules: repetition and length, and bands of perplexity under a modified Kneser-Ney bigram model.

Two perplexities are judged. One is of the order of entries alone: it tells shuffled words, and texts that are mostly
words of the entry for all others. The other also spells these words, each of them being equally likely in that entry,
so it tells texts of broken words.

Spark counts the words and the neighbouring pairs of all texts. The model is over the ``vocabulary`` most frequent
words, one entry for all other words, and text borders; so it has at most (vocabulary + 3)^2 pairs whatever the size of
the corpus, and is broadcast as sorted arrays of keys with their log probabilities. A pair is looked up by binary
search, for all texts of a chunk at once. Words are compared by 64-bit hashes.

A third perplexity has no vocabulary: every word and every pair of neighbours counts by itself, as often as it stands in
all other texts. Blocks of texts send their distinct words and pairs to the partitions of their hashes, which add them
up and send the sums back, so nothing is broadcast and no count is left out. The hashes go in ``SLICES`` ranges one after
the other, as differences of sorted values by byte planes, and the files of a range go before the next: so the disk
holds a part of all keys at a time. The broadcast model, a file of each executor, goes before them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.words import Words, carried, chunks_of, hash_words, mix, positions_of, texts_as_bytes, top_counts
from riskflow.session import discard, materialize, shuffles_released

#: keys that a task gathers before it counts them and hands the counts on
HELD = 1 << 22
# The symbols counted, the least words, and the largest share of repeated words in a hundred.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50

# Fixed value: how many tokens the share of a pair is mixed with its right word's, as a count of tokens.
PRIOR = 100.0
#: tokens of a block of texts, and about as many keys of a partition of counts
BLOCK = 1 << 21
#: ranges of hashes that are counted, and parts of the blocks that are scored, one after the other
SLICES = 4
#: stands for the border of a text among the hashes of words
BORDER = np.uint64(0x5851F42D4C957F2D)

COUNTS = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def pressed(values: np.ndarray) -> bytes:
    """Integers by byte planes, so that the bytes most of them lack cost little."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unpressed(raw: bytes, kind: type) -> np.ndarray:
    """The integers of ``pressed``, which were of ``kind``."""
    size, width = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw[8:], size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def apart(hashes: np.ndarray) -> np.ndarray:
    """Differences of neighbours, the first from 0 and all modulo 2**64; a cumulative sum undoes it."""
    with np.errstate(over="ignore"):
        return np.diff(hashes, prepend=np.uint64(0))


def counted(df: DataFrame, text: str, keys_of) -> DataFrame:
    """(key, n): how often each 64-bit key of ``keys_of(texts)`` occurs, counted in tasks before the shuffle."""

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], schema=COUNTS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, texts in chunks_of(batches, "t"):
            held.append(keys_of(texts))
            size += len(held[-1])
            if size >= HELD:
                yield counts(held)
                held, size = [], 0
        if size:
            yield counts(held)

    found = df.select(texts_as_bytes(F.col(f"`{text}`")).alias("t")).mapInArrow(run, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def pair_keys(vocabulary: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the neighbours of all texts, borders included, and where each text's keys start."""
    size = len(vocabulary) + 2  # words, all others, border
    n = len(words.bounds) - 1
    lengths = np.diff(words.bounds)
    starts = words.bounds[:-1] + np.arange(n)
    left = np.full(len(words.hashes) + n, size - 1, np.int64)
    right = left.copy()
    ids = positions_of(vocabulary, words.hashes)
    place = np.arange(len(ids)) + np.repeat(np.arange(n), lengths)
    right[place] = ids
    left[place + 1] = ids
    left[starts] = size - 1  # a text's first word has the border before it
    return left * size + right, np.append(starts, len(left))


def discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, 2 and 3 or more, each within 0 and its count; 0.5, 1, 1.5 where too few are known."""
    n = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(float)
    if (n == 0).any():
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    return np.clip([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]], 0.05, [0.95, 1.95, 2.95])


class Model(NamedTuple):
    vocabulary: np.ndarray
    keys: np.ndarray  # sorted pairs
    pair: np.ndarray  # log10 probability of each pair
    backoff: np.ndarray  # log10 weight of the lower order, by left entry
    single: np.ndarray  # log10 probability at the lower order, by right entry
    spelled: float = 0.0  # log10 of the number of words outside the vocabulary

    def score(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each text's entries, its end included, and of its words."""
        keys, starts = pair_keys(self.vocabulary, words)
        size = len(self.vocabulary) + 2
        value = self.backoff[keys // size] + self.single[keys % size]
        if len(self.keys):
            at = np.searchsorted(self.keys, keys)
            at[at == len(self.keys)] = 0
            value = np.where(self.keys[at] == keys, self.pair[at], value)
        others = keys % size == len(self.vocabulary)
        order, n = (np.diff(np.concatenate([[0.0], np.cumsum(x, dtype=float)])[starts]) for x in (value, others))
        return order, order - self.spelled * n


def estimate(vocabulary: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated modified Kneser-Ney from the counts of all pairs (sorted by key)."""
    size = len(vocabulary) + 2
    left, right = keys // size, keys % size
    d = np.concatenate([[0.0], discounts(counts)])
    total = np.bincount(left, counts, size)
    taken = np.bincount(left, d[np.minimum(counts, 3)], size)
    before = np.bincount(right, minlength=size)  # how many different words stand before each
    e = np.concatenate([[0.0], discounts(before[before > 0])])
    lost = e[np.minimum(before, 3)]
    everything = max(1, before.sum())
    single = np.maximum(before - lost, 0) / everything + lost.sum() / everything / size
    if not len(keys):
        single = np.full(size, 1 / size)
    with np.errstate(divide="ignore", invalid="ignore"):
        back = np.where(total > 0, taken / np.maximum(total, 1), 1.0)
        pair = (counts - d[np.minimum(counts, 3)]) / np.maximum(total, 1)[left] + back[left] * single[right]
        return Model(vocabulary, keys, np.log10(pair).astype(np.float32), np.log10(back).astype(np.float32), np.log10(single).astype(np.float32))


def fit(docs: DataFrame, text: str = "text", vocabulary: int = 4096) -> Model:
    """The model of all texts. The driver holds the vocabulary and at most (vocabulary + 2)^2 pairs."""
    words = materialize(counted(docs, text, lambda texts: hash_words(texts, lower=False).hashes), "words")
    frequent = np.sort(np.asarray(top_counts(words, vocabulary).select("key").toArrow().column("key")).view(np.uint64))
    others = max(1, words.count() - len(frequent))
    discard(words)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [pa.array([np.asarray(b.column(i)).astype(t).tobytes()]) for i, t in ((0, np.int64), (1, np.int64))]
            yield pa.RecordBatch.from_arrays(raw, names=["keys", "counts"])

    with shuffles_released(docs.sparkSession):
        pairs = counted(docs, text, lambda texts: pair_keys(shared.value, hash_words(texts, lower=False))[0])
        found = pairs.mapInArrow(packed, "keys binary, counts binary").collect()
    shared.destroy()
    keys, counts = (np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r[i], np.int64) for r in found)]) for i in (0, 1))
    order = np.argsort(keys)
    return estimate(frequent, keys[order], counts[order])._replace(spelled=float(np.log10(others)))


FEATURES = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [T.StructField(n, T.DoubleType()) for n in ("log_order", "log_perplexity")])
OWN = {"base_failed", "kept", "log_words", *FEATURES.names}
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_CHARS = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a window of three words found at least twice."""
    if len(hashes) < 4:
        return 0
    with np.errstate(over="ignore"):
        window = (hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[2:]
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    again = np.isin(window, twice)
    inside = np.zeros(len(hashes), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def features(texts: list[bytes], words: Words, model: Model) -> list[pa.Array]:
    lengths = np.diff(words.bounds)
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    per_text = [np.diff(np.concatenate([[0], np.cumsum(mask[joined])])[ends]) for mask in (_CHARS & ~_SPACE, _SYMBOL)]
    dup, repeat = [], []
    for i, text in enumerate(texts):
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        dup.append(len(lines) - len(set(lines)))
        repeat.append(repeated_words(words.hashes[words.bounds[i] : words.bounds[i + 1]]))
    both = [-x / (lengths + 1) for x in model.score(words)]
    return [pa.array(x.astype(np.int64) if isinstance(x, np.ndarray) else x, pa.int64()) for x in (lengths, *per_text, dup, repeat)] + [pa.array(x.astype(float)) for x in both]


def with_blocks(docs: DataFrame, text: str, model) -> DataFrame:
    """``docs`` under numbered names with the features, ``block`` and ``place``, and a row with the words of each block.

    A block's row has no place. ``words`` are its distinct words, the most frequent first and the border among them,
    ``ids`` the places in these of all its tokens, ``lengths`` the tokens of its texts, each of which ends with a border.
    """
    there, _ = carried(docs, OWN)
    fields = [f for f in docs.select(*there).schema.fields]
    body = [T.StructField("block", T.LongType()), T.StructField("place", T.LongType())]
    body += [T.StructField(n, T.BinaryType()) for n in ("words", "ids", "lengths")]
    inner = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + FEATURES.fields + body)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, kinds, held, lengths = TaskContext.get().partitionId() << 32, None, [], []

        def whole() -> pa.RecordBatch:
            words, ids, n = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            raw = [pressed(x) for x in (apart(words[order]), rank[ids], np.concatenate(lengths))]
            own = [pa.array([block]), pa.nulls(1, pa.int64()), *(pa.array([x]) for x in raw)]
            return pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in kinds), *own], names=inner.names)

        size = place = 0
        for rows, texts in chunks_of(batches, "t"):
            words = hash_words(texts, lower=False)
            made = features(texts, words, model.value)
            n = len(texts)
            own = [pa.array(np.full(n, block)), pa.array(np.arange(place, place + n)), *(pa.nulls(n, pa.binary()) for _ in range(3))]
            columns = [*rows.columns[:-1], *made, *own]
            kinds = [c.type for c in columns[:-5]]
            yield pa.RecordBatch.from_arrays(columns, names=inner.names)
            held.append(np.insert(words.hashes, words.bounds[1:], BORDER))
            lengths.append((np.diff(words.bounds) + 1).astype(np.int32))
            size, place = size + len(held[-1]), place + n
            if size >= BLOCK:
                yield whole()
                block, held, lengths, size, place = block + 1, [], [], 0, 0
        if size:
            yield whole()

    return docs.select(*there, texts_as_bytes(F.col(f"`{text}`")).alias("t")).mapInArrow(run, inner)


class Tokens(NamedTuple):
    """The tokens of a block: the hash of each token, and of the pair that it ends."""

    hashes: tuple[np.ndarray, np.ndarray]
    lengths: np.ndarray

    @classmethod
    def of(cls, words: bytes, ids: bytes, lengths: bytes) -> Tokens:
        known = np.cumsum(unpressed(words, np.uint64), dtype=np.uint64)
        right = known[unpressed(ids, np.int32)]
        left = np.roll(right, 1)  # the border before a text is the one that ends the text before
        with np.errstate(over="ignore"):
            return cls((right, mix(left * np.uint64(0x9E3779B97F4A7C15) + right)), unpressed(lengths, np.int32))

    def sent(self, parts: int, part: int, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Kind, partition, keys and how often they stand here, for the partitions from ``part`` to before ``end``."""
        for kind, hashes in enumerate(self.hashes):
            to = part_of(hashes, parts)
            keys, n = np.unique(hashes[(to >= part) & (to < end)], return_counts=True)
            starts = np.searchsorted(part_of(keys, parts), np.arange(part, end + 1))
            for k in np.flatnonzero(np.diff(starts)):
                yield kind, part + int(k), keys[starts[k] : starts[k + 1]], n[starts[k] : starts[k + 1]]

    def log10(self, counts: list[np.ndarray], tokens: int, kinds: int) -> np.ndarray:
        """log10 probability of each text, from how often its words and pairs stand in all other texts.

        ``counts`` has how often each distinct word, and each distinct pair, stands in all texts, in order of their hashes.
        """
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        others = []
        for hashes, n in zip(self.hashes, counts, strict=True):
            at = np.unique(hashes, return_inverse=True)[1]
            _, same, own = np.unique(owner * len(n) + at, return_inverse=True, return_counts=True)
            others.append(n[at] - own[same])
        right, pair = others
        left = np.roll(right, 1)
        left[np.cumsum(self.lengths) - self.lengths] = right[np.cumsum(self.lengths) - 1]  # a text's own border
        single = (right + 1) / (tokens - self.lengths[owner] + kinds + 1)
        return np.bincount(owner, np.log10((pair + PRIOR * single) / (left + PRIOR)), len(self.lengths))


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The partition of each hash: ``parts`` ranges of equal size."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def log_words(blocks: DataFrame, tokens: int) -> DataFrame:
    """(block, place, log_words): log10 probability of each text under the counts of all words and pairs.

    The share of a pair among those of its left word is mixed with the share of its right word among all tokens, which is
    one more than its count; a text's own tokens are left out of all counts. ``blocks`` are the rows with words.
    """
    each = 1 + 2 * tokens // BLOCK // SLICES  # partitions of a slice
    parts = each * SLICES
    sent = "kind int, part long, block long, keys binary, n binary"

    def asker(part: int):
        def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    block, *raw = (c[r].as_py() for c in b.columns)
                    rows = [(k, p, block, pressed(apart(x)), pressed(n.astype(np.int32))) for k, p, x, n in Tokens.of(*raw).sent(parts, part, part + each)]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                            names=["kind", "part", "block", "keys", "n"],
                        )

        return ask

    def add(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpressed(x, np.uint64), dtype=np.uint64) for x in table["keys"].to_pylist()]
        n = np.concatenate([unpressed(x, np.int32) for x in table["n"].to_pylist()])
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(at, n).astype(np.int64)[at]
        cut = [pressed(x) for x in np.split(sums, np.cumsum([len(k) for k in keys])[:-1])]
        distinct = np.full(len(keys), 0)
        distinct[0] = len(found)
        return pa.table({"kind": table["kind"], "part": table["part"], "block": table["block"], "n": pa.array(cut, pa.binary()), "distinct": distinct})

    own = blocks.select("block", "words", "ids", "lengths")
    added = []
    for part in range(0, parts, each):
        asked = own.mapInArrow(asker(part), sent)
        added.append(materialize(asked.groupBy("kind", "part").applyInArrow(add, "kind int, part long, block long, n binary, distinct long"), "sums"))
    sums = reduce(DataFrame.unionByName, added)
    kinds = sums.where("kind = 0").agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]

    def score(own: pa.Table, given: pa.Table) -> pa.Table:
        block, words = own["block"][0].as_py(), Tokens.of(*(own[c][0].as_py() for c in ("words", "ids", "lengths")))
        back = sorted(zip(*(given[c].to_pylist() for c in ("kind", "part", "n"))))
        counts = [np.concatenate([unpressed(n, np.int64) for k, _, n in back if k == kind]) for kind in range(2)]
        found = words.log10(counts, tokens, kinds)
        return pa.table({"block": np.full(len(found), block), "place": np.arange(len(found)), "log_words": found})

    scored = []
    for k in range(SLICES):
        here = F.pmod(F.xxhash64("block"), F.lit(SLICES)) == k
        both = own.where(here).groupBy("block").cogroup(sums.where(here).drop("distinct").groupBy("block"))
        scored.append(materialize(both.applyInArrow(score, "block long, place long, log_words double"), "log_words"))
    for table in added:
        discard(table)
    return reduce(DataFrame.unionByName, scored)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bands(scored: DataFrame, column: str, lang: str = "lang", reach: float = 6.0, step: float = 0.001) -> DataFrame:
    """(lang_key, middle, below, above): accepted values of ``column`` in each language, null being one of its own.

    Measured over all texts that pass the base rules: ``below`` is ``reach`` times the median less the first quartile,
    ``above`` likewise with the third. Quartiles are exact on a grid of ``step``, from counts per grid point, so memory
    does not grow with the rows.
    """
    grid = F.round(F.col(column) / step).cast("long")
    bars = scored.where(~base_failed()).groupBy(lang_key(lang), grid.alias("bar")).agg(F.count("*").alias("n"))
    found = bars.groupBy("lang_key").agg(F.expr("percentile(bar, array(0.25D, 0.5D, 0.75D), n)").alias("q"))
    q = [F.col("q")[i] for i in range(3)]
    low, high = F.greatest(q[1] - q[0], F.lit(5.0)), F.greatest(q[2] - q[1], F.lit(5.0))
    return found.select(
        "lang_key",
        (q[1] * step).alias("middle"),
        (reach * low * step).alias("below"),
        (reach * high * step).alias("above"),
    )


def lang_key(lang: str) -> Column:
    return F.concat(F.lit("="), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("\0"))).alias("lang_key")


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    vocabulary: int = 4096,
    reach: tuple[float, float, float] = (4.0, 6.0, 6.0),
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the base counts, three perplexities, ``base_failed`` and ``kept``; columns of these names are replaced.

    A text is kept if it has at least 50 words, at most half of them in repeated windows of three words, and its
    perplexities lie within its language's bands, which are ``reach`` quartile distances wide and wider for short texts
    by a factor of 1 + 100 / words. ``log_order`` (the order of entries) and ``log_perplexity`` (of spelt words) have a
    lower and an upper end; ``log_words`` (all words and pairs, as they stand in other texts) has an upper end only, as a
    copy of another text is likely. Null and empty texts have no words and are not kept. Texts of any length are read
    whole; repeated rows count each time. A language without any text that passes the base rules has no bands and needs
    none. Without ``keep_text`` the column of texts is left out, which spares writing it.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, text, vocabulary))
    there, back = carried(docs, OWN)
    made = with_blocks(docs, text, model)
    if not keep_text:
        gone = [c for c in docs.columns if c.lower() not in OWN].index(text)
        made, back = made.drop(f"c{gone}"), back[:gone] + back[gone + 1 :]
    written = materialize(made, "perplexity")
    model.destroy()  # driver and executors each hold it as a file
    texts = written.where("place IS NOT NULL").drop("words", "ids", "lengths")
    tokens = texts.agg(F.coalesce(F.sum(F.col("n_words") + 1), F.lit(0))).first()[0]
    exact = log_words(written.where("place IS NULL"), tokens)
    scored = texts.join(exact, ["block", "place"]).withColumn("log_words", -F.col("log_words") / (F.col("n_words") + 1))
    own_lang = f"c{[c for c in docs.columns if c.lower() not in OWN].index(lang)}"
    joined = scored.withColumn("lang_key", lang_key(own_lang))
    wider, verdict = 1 + 100 / F.greatest("n_words", F.lit(1)), ~base_failed()
    for column, distances in zip(("log_order", "log_perplexity", "log_words"), reach, strict=True):
        band = bands(scored, column, own_lang, distances).select("lang_key", F.struct("middle", "below", "above").alias(f"band_{column}"))
        # written, so that Catalyst knows how small it is and no language's texts meet in one task
        joined = joined.join(materialize(band, "bands"), "lang_key", "left")
        b = F.col(f"band_{column}")
        off = F.col(column) - b["middle"]
        inside = off <= wider * b["above"] if column == "log_words" else off.between(-wider * b["below"], wider * b["above"])
        verdict &= F.coalesce(inside, F.lit(False))
    return joined.select(*back, *FEATURES.names, "log_words", base_failed().alias("base_failed"), verdict.alias("kept"))
