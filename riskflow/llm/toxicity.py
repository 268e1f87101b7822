"""Toxicity: logistic regression on words and word starts, regularised by counterfactual identity terms."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.vectors import bounded_sample
from riskflow.llm.words import chunks_of, crc_of, hash_words, mix, positions_of, texts_as_bytes, with_columns
from riskflow.session import materialize

# Neutral names of groups of people; the terms of a line can take each other's place.
IDENTITY_TERMS = (
    "people women men girls boys mothers fathers",
    "people christians muslims jews hindus buddhists atheists catholics",
    "person christian muslim jewish hindu buddhist atheist catholic",
    "person black white asian latino african european american arab indigenous",
    "person gay lesbian straight bisexual transgender queer",
    "people immigrants refugees foreigners citizens",
    "person disabled deaf blind autistic elderly young",
    "personas mujeres hombres cristianos musulmanes judíos inmigrantes refugiados negros blancos",
    "personnes femmes hommes chrétiens musulmans juifs immigrés réfugiés noirs blancs",
    "menschen frauen männer christen muslime juden einwanderer flüchtlinge schwarze weiße",
)

_BYTES = np.arange(256)
_APART = ~(((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) | (_BYTES >= 48) & (_BYTES <= 57) | (_BYTES >= 128))
STARTS = (0, 4, 5, 6, 7, 8)


def text_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, text number) of all words and word starts, as 64-bit hashes."""
    found, whose = [], []
    for k, first in enumerate(STARTS):
        words = hash_words(texts, apart=_APART, first=first)
        owner = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
        used = words.hashes != EMPTY if first else np.ones(len(words.hashes), bool)
        with np.errstate(over="ignore"):
            found.append(mix(words.hashes[used] + np.uint64(k)))
        whose.append(owner[used])
    return np.concatenate(found), np.concatenate(whose)


with np.errstate(over="ignore"):
    EMPTY = mix(np.zeros(1, np.uint64))[0]


class Model(NamedTuple):
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def present(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (text number, place of a feature) of the model's features in each text, each pair once."""
        hashes, owner = text_features(texts)
        at = positions_of(self.features, hashes)
        hit = at < len(self.features)
        both = np.unique(owner[hit] * np.int64(len(self.features) + 1) + at[hit])
        return both // (len(self.features) + 1), both % (len(self.features) + 1)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        owner, at = self.present(texts)
        return 1 / (1 + np.exp(-np.clip(self.bias + np.bincount(owner, self.weights[at], len(texts)), -30, 30)))


def swapped(text: bytes, groups: Sequence[str] = IDENTITY_TERMS) -> list[bytes]:
    """The text with its identity terms replaced by the others of their line, one text per place in the line."""
    import regex

    lines = [line.split() for line in groups]
    where: dict[str, list[str]] = {}
    for line in lines:
        for term in line[1:]:
            where.setdefault(term, line)
    words = regex.split(r"(\w+)", text.decode("utf-8", "replace"))
    found = [(i, where[w.lower()]) for i, w in enumerate(words) if w.lower() in where]
    out = []
    for turn in range(max((len(line) for _, line in found), default=0)):
        other = list(words)
        for i, line in found:
            other[i] = line[(line.index(words[i].lower()) + turn) % len(line)]
        changed = "".join(other).encode("utf-8")
        if changed.lower() != text.lower():
            out.append(changed)
    return out


def counted_features(taught: DataFrame) -> DataFrame:
    """(key, toxic, total): in how many taught texts each feature occurs, counted within tasks first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks_of(batches, "t"):
            y = np.asarray(rows.column("y")).astype(np.int64)
            hashes, owner = text_features(texts)
            keys, at = np.unique(hashes, return_inverse=True)
            both = np.unique(at * np.int64(len(texts)) + owner)
            at, owner = both // len(texts), both % len(texts)
            total, toxic = np.bincount(at, minlength=len(keys)), np.bincount(at, y[owner], len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array(total.astype(np.int64))],
                names=["key", "toxic", "total"],
            )

    found = taught.select("t", "y").mapInArrow(run, "key long, toxic long, total long")
    return found.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))


def descend(owner, at, y, pairs, size: int, start: np.ndarray, bias: float, ridge: float, fair: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights that minimise the mean log loss, the ridge term and the squared score changes of swapped texts.

    ``pairs`` holds for each swapped text its original's number and the features lost and gained. Adam steps on all
    rows; the objective is convex.
    """
    n = len(y)
    w = np.append(start, bias)
    m, v = np.zeros_like(w), np.zeros_like(w)
    swap_row, swap_at, swap_sign, n_swaps = pairs
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[-1] + np.bincount(owner, w[at], n), -30, 30)))
        error = p - y
        grad = np.append(np.bincount(at, error[owner], size) / n + ridge * w[:-1] / n, error.mean())
        if n_swaps:
            change = np.bincount(swap_row, swap_sign * w[swap_at], n_swaps)
            grad[:-1] += 2 * fair / n_swaps * np.bincount(swap_at, swap_sign * change[swap_row], size)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        rate = 0.1 * (1 - step / (steps + 1)) + 0.002
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(
    taught: DataFrame,
    features: int = 4096,
    ridge: float = 0.3,
    fair: float = 1.0,
    steps: int = 300,
    groups: Sequence[str] = IDENTITY_TERMS,
) -> Model:
    """Fits on (t binary, y 0 or 1) rows, whose number the caller bounds.

    The ``features`` hashes that best tell toxic from other texts are found by counting in Spark; identity terms are
    always among them. The driver gets, for each taught text, the places of these features, and for each swap of an
    identity term what it changes. Without rows every score is one half; with one label only, that label's share.
    """
    totals = taught.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).first()
    n, ones = totals.n, totals.ones or 0
    prior = (ones + 0.5) / (n + 1)
    bias = float(np.log(prior / (1 - prior)))
    if not ones or ones == n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    a, b = F.col("toxic"), F.col("total")
    odds = F.log((a + 0.5 * prior * 2) / (b - a + 0.5 * (1 - prior) * 2)) - F.lit(bias)
    # signed root of the likelihood ratio: rare features need to be pure to be chosen
    expected = b * prior
    gain = (a - expected) * (a - expected) / (expected * (1 - prior))
    best = counted_features(taught).where("total >= 2").orderBy(F.desc(gain), "key").limit(features)
    chosen = [(r.key, r.odds) for r in best.select("key", odds.alias("odds")).collect()]
    terms = [t.encode("utf-8") for line in groups for t in line.split()]
    own = text_features(terms)[0] if terms else np.zeros(0, np.uint64)
    hashes = np.unique(np.concatenate([np.array([k for k, _ in chosen], np.int64).view(np.uint64), own]))
    model = Model(hashes, np.zeros(len(hashes)), bias)
    shared = taught.sparkSession.sparkContext.broadcast((hashes, tuple(groups)))

    def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lines = shared.value
        one = Model(known, np.zeros(len(known)), 0.0)
        for rows, texts in chunks_of(batches, "t"):
            others = [swapped(t, lines) for t in texts]
            owner, at = one.present(texts)
            places = np.split(at, np.searchsorted(owner, np.arange(1, len(texts))))
            changed = []
            for i, swaps in enumerate(others):
                own_places = set(places[i].tolist())
                found = []
                for text in swaps:
                    now = set(one.present([text])[1].tolist())
                    found.append([x + 1 for x in now - own_places] + [-x - 1 for x in own_places - now])
                changed.append(found)
            yield pa.RecordBatch.from_arrays(
                [rows.column("y").cast(pa.int32()), pa.array([p.tolist() for p in places], pa.list_(pa.int32())), pa.array(changed, pa.list_(pa.list_(pa.int32())))],
                names=["y", "at", "swaps"],
            )

    got = taught.select("t", "y").mapInArrow(rows_of, "y int, at array<int>, swaps array<array<int>>").collect()
    y = np.array([r.y for r in got], float)
    owner = np.repeat(np.arange(len(got)), [len(r["at"]) for r in got])
    at = np.array([x for r in got for x in r["at"]], np.int64)
    swaps = [s for r in got for s in r.swaps if s]
    signed = np.array([x for s in swaps for x in s], np.int64)
    pairs = (np.repeat(np.arange(len(swaps)), [len(s) for s in swaps]), np.abs(signed) - 1, np.sign(signed), len(swaps))
    weights, bias = descend(owner, at, y, pairs, len(hashes), model.weights, bias, ridge, fair, steps)
    return Model(hashes, weights, bias)


def score(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    folds: int = 5,
    sample: int = 40_000,
    groups: Sequence[str] = IDENTITY_TERMS,
    fair: float = 1.0,
) -> DataFrame:
    """``docs`` with ``held_out`` (boolean), ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Learns from at most ``sample`` labelled rows (those of lowest hashed id) whose crc32 of the id, modulo ``folds``,
    is not 0; that bound also bounds what is broadcast. Every text is scored, whole, by itself alone; null and empty
    texts get the score of a text without any known feature. Null labels teach nothing, repeated rows are scored each
    time, columns with the names of the new ones are replaced.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = bounded_sample(known.where(F.col("y").isin(0, 1) & (crc_of("id", folds) != 0)), "id", sample)
    plain = docs.select(F.col(f"`{doc_id}`").alias("id"), texts_as_bytes(F.col(f"`{text}`")).alias("t"))
    taught = materialize(plain.join(F.broadcast(known), "id").select("t", "y"), "taught")
    model = docs.sparkSession.sparkContext.broadcast(fit(taught, groups=groups, fair=fair))
    new = T.StructType([T.StructField("score", T.DoubleType())])

    def start():
        return lambda texts: [pa.array(model.value(texts))]

    scored = with_columns(docs, text, new, start)
    kept = [F.col(f"`{c}`") for c in scored.columns if c.lower() not in ("held_out", "score", "predicted")]
    held = crc_of(doc_id, folds) == 0
    return scored.select(*kept, held.alias("held_out"), F.col("score"), (F.col("score") >= 0.5).cast("int").alias("predicted"))
