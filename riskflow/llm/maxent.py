"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

The model predicts one of 4096 events after each history: the most frequent words, the end of the text, and 256
buckets that all other words fall into by their last bytes. Events are factored into 16 classes of 16 groups of 16:
P(event) = P(class | history) P(group | class, history) P(place | group, history). Each factor is log-linear, the sum of
the weight rows that the history's features select by hash. Features are the last word, the last two words, and the
words two and three back (skips); those of a group or place also hold the class or group. A word of a bucket has the
probability (c + 1) / (sum over the bucket's training words of (c + 1), + 1) in it, so that all known words and one
unknown word per bucket add up to one.

Counts cover all training texts. Weights start at the events' frequencies and are learnt in ``ROUNDS`` rounds, each
over its own share of the training texts: every partition takes gradient steps from the common weights, and the
changes are averaged by how often each row was touched. So one pass over all training texts is made, and the driver
only ever holds the weights, whose number is fixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.perplexity import counted
from riskflow.llm.vectors import PARTIAL, parts, pieces, summed
from riskflow.llm.words import Words, carried, chunks_of, crc_of, hash_words_and_ends, mix, positions_of, texts_as_bytes, top_counts, with_columns
from riskflow.session import materialize

BRANCH = 16  # classes, groups in a class, events in a group
EVENTS = BRANCH**3
BUCKETS = 256
MODEL_WORDS = EVENTS - BUCKETS - 1
END = MODEL_WORDS  # event of the end of a text; buckets follow
BORDER = EVENTS  # stands before the first word of a history
ROWS = 1 << 13  # weight rows of each of the three softmax layers
ANCHORS = 48
ROUNDS = 3
HOT_WORDS = 1 << 17  # words whose counts are broadcast; all others are joined
BATCH = 8192
_LOW = np.uint64((1 << 56) - 1)
_BORDERS = np.full(3, BORDER, np.int16).tobytes()


def word_keys(texts: list[bytes]) -> Words:
    """Keys of all words: 56 bits of the word's hash below the 8 bits of the bucket of its last three bytes."""
    words, ends = hash_words_and_ends(texts, last=3)
    return Words((words.hashes & _LOW) | (ends & ~_LOW), words.bounds)


class Counts(NamedTuple):
    """What is broadcast of the training counts; its size does not depend on the corpus."""

    hot: np.ndarray  # sorted keys of the most frequent words
    count: np.ndarray  # their counts
    hot_is_rare: np.ndarray  # whether each is a bucket word
    model: np.ndarray  # sorted keys of the model's words
    bucket_log: np.ndarray  # log10 of each bucket's denominator
    tokens: int
    kinds: int
    ends: int
    events: np.ndarray  # training count of each event


def gather(train: DataFrame, counts: DataFrame) -> Counts:
    """``counts`` is (key, n) of the training words."""
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    top = top_counts(counts, HOT_WORDS).select("key", "n").toArrow()
    keys, n = np.asarray(top.column("key")).view(np.uint64), np.asarray(top.column("n"))
    model = np.sort(keys[:MODEL_WORDS])
    order = np.argsort(keys)
    by_bucket = counts.groupBy(F.shiftrightunsigned("key", 56).alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    sums, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in by_bucket:
        sums[r.b], kinds[r.b] = r.n, r.v
    own = keys[:MODEL_WORDS]
    sums -= np.bincount((own >> np.uint64(56)).astype(int), n[:MODEL_WORDS], BUCKETS)
    kinds -= np.bincount((own >> np.uint64(56)).astype(int), minlength=BUCKETS)
    events = np.zeros(EVENTS)
    events[positions_of(model, own)] = n[:MODEL_WORDS]
    events[END] = ends
    events[END + 1 :] = sums
    tokens, v = (total.n or 0) + ends, total.v + (1 if ends else 0)
    rare = positions_of(model, keys[order]) == len(model)
    return Counts(keys[order], n[order], rare, model, np.log10(sums + kinds + 1), tokens, v, ends, events)


def events_of(words: Words, model: np.ndarray) -> list[bytes]:
    """The events of each text as int16, its end last.

    Model words are numbered by the order of their keys; places up to MODEL_WORDS that have no word stay unused.
    """
    at = positions_of(model, words.hashes)
    rare = at == len(model)
    at[rare] = END + 1 + (words.hashes[rare] >> np.uint64(56)).astype(np.int64)
    at, end = at.astype(np.int16), np.int16(END).tobytes()
    return [at[a:b].tobytes() + end for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]


def stream_of(events: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Events of all texts, each text after three borders; and where each text's borders start."""
    stream = np.frombuffer(b"".join([_BORDERS + e for e in events]), np.int16).astype(np.int64)
    return stream, np.concatenate([[0], np.cumsum([len(e) // 2 + 3 for e in events])[:-1]]).astype(np.int64)


class Weights(NamedTuple):
    group: np.ndarray  # group of each event, of BRANCH * BRANCH; its class is group // BRANCH
    place: np.ndarray  # place of each event in its group
    biases: tuple[np.ndarray, np.ndarray, np.ndarray]  # by class; by class and group; by group and place
    rows: np.ndarray  # 3 x ROWS x BRANCH
    seen: np.ndarray  # 3 x ROWS: squared gradients so far


def hashed(kind: int, *values: np.ndarray) -> np.ndarray:
    """Rows of features, by a hash of their kind and values."""
    h = np.full(len(values[0]), kind + 1, np.uint64)
    with np.errstate(over="ignore"):
        for v in values:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + v.astype(np.uint64))
    return (h >> np.uint64(64 - 13)).astype(np.int64)


_table: list[np.ndarray] = []


def single(kind: int, values: np.ndarray) -> np.ndarray:
    """The rows of features of one event, from a table."""
    if not _table:
        everything = np.arange(EVENTS + 1)
        _table.extend(hashed(k, everything) for k in range(5))
    return _table[kind][values]


def layers(w: Weights, stream: np.ndarray, at: np.ndarray) -> list[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """(feature rows, bias, right answer) of the three softmax layers, for the events at places ``at``."""
    e1, e2, e3, event = stream[at - 1], stream[at - 2], stream[at - 3], stream[at]
    group = w.group[event]
    c = group >> 4
    first = [single(0, e1), single(1, e2), single(2, e3), hashed(5, e1 * (EVENTS + 1) + e2)]
    second = [hashed(6, e1 * BRANCH + c), hashed(7, e2 * BRANCH + c)]
    third = [(single(3, e1) + group * 2477) & (ROWS - 1), (single(4, e2) + group * 3571) & (ROWS - 1)]
    return [(first, w.biases[0], c), (second, w.biases[1][c], group & 15), (third, w.biases[2][group], w.place[event])]


_ONES = np.ones(BRANCH, np.float32)


def softmax(rows: np.ndarray, features: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    z = np.take(rows, features[0], axis=0)
    for f in features[1:]:
        z += np.take(rows, f, axis=0)
    z += bias
    np.clip(z, -60, 60, out=z)
    np.exp(z, out=z)
    z /= (z @ _ONES)[:, None]
    return z


def step(rows: np.ndarray, seen: np.ndarray, touched: np.ndarray, feature: np.ndarray, error: np.ndarray, rate: float) -> None:
    """One gradient step: each row moves by its summed error over the root of its squared errors so far."""
    at = (feature[:, None] * BRANCH + np.arange(BRANCH)).ravel()
    total = np.bincount(at, error.ravel(), ROWS * BRANCH).reshape(ROWS, BRANCH).astype(np.float32)
    seen += (total * total) @ _ONES
    touched += np.bincount(feature, minlength=ROWS)
    rows -= (rate / np.sqrt(seen))[:, None] * total


def train_on(w: Weights, stream: np.ndarray, at: np.ndarray, touched: np.ndarray, rate: float) -> None:
    """Gradient steps over the events at places ``at``, in a fixed shuffled order; changes the weights in place."""
    at = at[np.argsort(mix(at.astype(np.uint64)), kind="stable")]
    for own in np.array_split(at, max(1, round(len(at) / BATCH))):
        line = np.arange(len(own))
        for k, (features, bias, answer) in enumerate(layers(w, stream, own)):
            p = softmax(w.rows[k], features, bias)
            p[line, answer] -= 1
            for f in features:
                step(w.rows[k], w.seen[k], touched[k], f, p, rate)


def log10_events(w: Weights, events: list[bytes]) -> np.ndarray:
    """The log10 probability of each text's events."""
    stream, starts = stream_of(events)
    value = np.zeros(len(stream))
    at = np.flatnonzero(stream != BORDER)
    for k in range(0, len(at), BATCH):
        own = at[k : k + BATCH]
        line, p = np.arange(len(own)), 1.0
        for i, (features, bias, answer) in enumerate(layers(w, stream, own)):
            p = p * softmax(w.rows[i], features, bias)[line, answer].astype(float)
        value[own] = np.log10(np.maximum(p, 1e-30))
    total = np.concatenate([[0.0], np.cumsum(value)])
    return np.diff(total[np.append(starts, len(stream))])


def grouped(around: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal size: events split in halves, again and again, along what most tells their neighbours apart."""
    share = np.sqrt(around / np.maximum(around.sum(1, keepdims=True), 1))
    group, place = np.zeros(len(around), np.int64), np.zeros(len(around), np.int64)
    todo = [(np.arange(len(around)), 0, BRANCH * BRANCH)]
    while todo:
        own, first, n = todo.pop()
        if n == 1:
            group[own], place[own] = first, np.arange(len(own))
            continue
        weight = np.sqrt(counts[own]) + 1e-9
        x = share[own] - np.average(share[own], axis=0, weights=weight)
        weighted = x * weight[:, None]
        direction = np.linalg.eigh(weighted.T @ weighted)[1][:, -1]
        order = own[np.lexsort((own, x @ direction))]
        half = len(own) // 2
        todo += [(order[:half], first, n // 2), (order[half:], first + n // 2, n // 2)]
    return group, place


def _per_partition(events: DataFrame, length: int, work, kind: type = np.float64) -> np.ndarray:
    """Sum over partitions of ``work(iterator of event lists)``, a vector or None."""
    groups = parts(events)

    def lists(batches: Iterable[pa.RecordBatch]) -> Iterator[list[bytes]]:
        for _, found in chunks_of(batches, "events"):
            yield found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vector = work(lists(batches))
        if vector is not None:
            yield pieces(vector, TaskContext.get().partitionId() % groups, kind)

    return summed(events.select("events").mapInArrow(run, PARTIAL), length, kind)


def learn(train: DataFrame, counts: Counts, rate: float = 0.5) -> Weights:
    """Weights from (id, events binary) training rows."""
    context = train.sparkSession.sparkContext
    anchors = np.full(EVENTS + 1, ANCHORS)
    anchors[np.argsort(-counts.events, kind="stable")[:ANCHORS]] = np.arange(ANCHORS)
    width, f32 = ANCHORS + 1, np.float32

    def neighbours(chunks) -> np.ndarray:
        before, after = (np.zeros((EVENTS + 1) * width) for _ in range(2))
        for events in chunks:
            stream, _ = stream_of(events)
            a, b = stream[:-1], stream[1:]
            before += np.bincount(b * width + anchors[a], minlength=len(before))
            after += np.bincount(a * width + anchors[b], minlength=len(after))
        return np.concatenate([before, after])

    size = (EVENTS + 1) * width
    found = _per_partition(train, 2 * size, neighbours, f32).reshape(2, EVENTS + 1, width)[:, :EVENTS]
    group, place = grouped(np.concatenate([found[0], found[1]], axis=1), counts.events)
    mass = np.zeros((BRANCH * BRANCH, BRANCH))
    mass[group, place] = counts.events + 0.5
    by_group = mass.sum(1).reshape(BRANCH, BRANCH)
    by_class = by_group.sum(1)
    biases = (
        np.log(by_class / by_class.sum()).astype(f32),
        np.log(by_group / by_class[:, None]).astype(f32),
        np.log(mass / mass.sum(1, keepdims=True)).astype(f32),
    )
    w = Weights(group, place, biases, np.zeros((3, ROWS, BRANCH), f32), np.ones((3, ROWS), f32))
    n_rows, n = 3 * ROWS, 3 * ROWS * BRANCH
    for turn in range(ROUNDS):
        common = context.broadcast(w)

        def changes(chunks, common=common) -> np.ndarray | None:
            start = common.value
            own = start._replace(rows=start.rows.copy(), seen=start.seen.copy())
            touched = np.zeros((3, ROWS), f32)
            for events in chunks:
                stream, _ = stream_of(events)
                train_on(own, stream, np.flatnonzero(stream != BORDER), touched, rate)
            if not touched.any():
                return None
            # changes weighted by touches, the touches, and squared gradients weighted likewise
            moved = (own.rows - start.rows) * touched[:, :, None]
            return np.concatenate([moved.ravel(), touched.ravel(), ((own.seen - start.seen) * touched).ravel()])

        share = train.where(F.pmod(F.xxhash64("id"), F.lit(ROUNDS)) == turn)
        total = _per_partition(share, n + 2 * n_rows, changes, f32)
        by = np.maximum(total[n : n + n_rows], 1e-9).reshape(3, ROWS)
        w = w._replace(
            rows=(w.rows + total[:n].reshape(w.rows.shape) / by[:, :, None]).astype(f32),
            seen=(w.seen + total[n + n_rows :].reshape(3, ROWS) / by).astype(f32),
        )
    return w


TAIL = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())]))
PARTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known_hot")]
    + [T.StructField(n, T.DoubleType()) for n in ("base_hot", "rare_hot")]
    + [T.StructField("events", T.BinaryType()), T.StructField("tail", TAIL)]
)


def measured_parts(texts: list[bytes], counts: Counts) -> list[pa.Array]:
    """What the scores are made of, as far as the broadcast counts tell; ``tail`` lists each text's other words."""
    words = word_keys(texts)
    n, lengths = len(texts), np.diff(words.bounds)
    owner = np.repeat(np.arange(n), lengths)
    at = positions_of(counts.hot, words.hashes)
    hot = at < len(counts.hot)
    logs = np.zeros(len(at))
    logs[hot] = np.log10(counts.count[at[hot]] + 1)
    rare = np.ones(len(at), bool)
    rare[hot] = counts.hot_is_rare[at[hot]]
    buckets = np.where(rare, counts.bucket_log[(words.hashes >> np.uint64(56)).astype(np.int64)], 0)
    tail_owner, tail_key = owner[~hot], words.hashes[~hot]
    order = np.lexsort((tail_key, tail_owner))
    tail_owner, tail_key = tail_owner[order], tail_key[order]
    first = np.ones(len(order), bool)
    first[1:] = (tail_owner[1:] != tail_owner[:-1]) | (tail_key[1:] != tail_key[:-1])
    first = np.flatnonzero(first)
    times = np.diff(np.append(first, len(order)))
    rows = pa.StructArray.from_arrays([pa.array(tail_key[first].view(np.int64)), pa.array(times.astype(np.int64))], names=["key", "n"])
    cuts = pa.array(np.searchsorted(tail_owner[first], np.arange(n + 1)).astype(np.int32))
    return [
        pa.array((lengths + 1).astype(np.int64)),
        pa.array((np.bincount(owner, hot, n) + (counts.ends > 0)).astype(np.int64)),
        pa.array(np.bincount(owner, logs, n) + np.log10(counts.ends + 1), pa.float64()),
        pa.array(np.bincount(owner, logs * rare - buckets, n).astype(float), pa.float64()),
        pa.array(events_of(words, counts.model), pa.binary()),
        pa.ListArray.from_arrays(cuts, rows),
    ]


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", folds: int = 7, held: int = 2) -> DataFrame:
    """``docs`` with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Learns from the rows whose crc32 of the id, modulo ``folds``, is not ``held``, and scores all. Tokens are the
    words, letter case aside, and one end, so null and empty texts have one token. ``base_score`` is the add-one
    unigram score, ``score`` the model's log10 probability. Counts of words outside the broadcast table are joined, as
    one row per text and word. Repeated rows are learnt from and scored each time. Columns named like the new ones are
    replaced; an empty table gives no rows.
    """
    key = [
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("\0")).alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("row"),
    ]
    out_of_sample = (crc_of(doc_id, folds) == held).alias("held_out")
    plain = docs.select(*key, texts_as_bytes(F.col(f"`{text}`")).alias("t"), out_of_sample)
    train = plain.where(~F.col("held_out"))
    words = materialize(counted(train, "t", lambda texts: word_keys(texts).hashes), "counts")
    counts = gather(train, words)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(counts)

    def measure():
        return lambda texts: measured_parts(texts, shared.value)

    measured = materialize(with_columns(plain, "t", PARTS, measure).drop("t"), "measured")
    weights = context.broadcast(learn(measured.where(~F.col("held_out")).select("id", "events"), counts))
    one = measured.drop("held_out").dropDuplicates(["id", "row"])

    def of_events():
        return lambda events: [pa.array(log10_events(weights.value, events))]

    scores = T.StructType([T.StructField("event_score", T.DoubleType())])
    scored = with_columns(measured.drop("tail", "held_out"), "events", scores, of_events).drop("events").dropDuplicates(["id", "row"])
    tail = one.select("id", "row", F.explode("tail").alias("x")).select("id", "row", "x.key", F.col("x.n").alias("times"))
    n = F.coalesce("n", F.lit(0))
    more = tail.join(words, "key", "left").groupBy("id", "row").agg(
        F.sum(F.col("times") * F.log10(n + 1.0)).alias("tail_log"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"),
    )
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    sums = scored.join(more, ["id", "row"], "left").select(
        F.col("id").alias("id__"),
        F.col("row").alias("row__"),
        "n_tokens",
        (F.col("n_known_hot") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(counts.tokens)).cast("long").alias("train_tokens"),
        (F.col("base_hot") + tail_log - F.col("n_tokens") * float(np.log10(counts.tokens + counts.kinds + 1))).alias("base_score"),
        (F.col("event_score") + F.col("rare_hot") + tail_log).alias("score"),
    )
    there, back = carried(docs, ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
    result = docs.select(*there, key[0].alias("own_id__"), key[1].alias("own_row__"), out_of_sample)
    result = result.join(sums, (F.col("own_id__") == F.col("id__")) & (F.col("own_row__") == F.col("row__")))
    return result.select(*back, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
