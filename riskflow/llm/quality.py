"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.vectors import PARTIAL, parts, pieces, summed
from riskflow.llm.words import crc_of, hash_words, with_columns
from riskflow.session import materialize

# Classes of bytes.
_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_STOP = np.isin(_BYTES, list(b".,;:?"))
_HIGH = _BYTES >= 128
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>@^~_=+\\/{}[]"))
_BANG = _BYTES == ord("!")
_BAR = _BYTES == ord("|")
_MASKS = [_UPPER, _DIGIT, _STOP, _HIGH, _SYMBOL, _BANG, _BAR]
N_STATISTICS = len(_MASKS) + 12


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``N_STATISTICS`` numbers per text, each within about 0 and 10; an empty text has zeros."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[ends])

    words = hash_words(texts)
    n_words = np.diff(words.bounds)
    inked = np.maximum(per_text(~_SPACE[joined]), 1)
    columns = [per_text(mask[joined]) / inked * 10 for mask in _MASKS]
    some = np.maximum(n_words, 1)
    first = np.concatenate([[False], _SPACE[joined[:-1]]]) | (np.arange(len(joined)) == 0)
    columns += [
        np.log1p(n_words) / 2,
        np.log1p(inked / some) * 2,
        per_text(first & _UPPER[joined]) / some * 10,
        per_text(first & (_SYMBOL | _BANG)[joined]) / some * 10,
        per_text(joined == 10) / some * 10,
    ]
    rest = np.zeros((len(texts), 7))
    for i, text in enumerate(texts):
        own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        if not len(own):
            continue
        _, counts = np.unique(own, return_counts=True)
        with np.errstate(over="ignore"):
            pairs = own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]
        lines = [x for x in text.split(b"\n") if x.strip()]
        share = counts / len(own)
        rest[i] = (
            len(counts) / len(own) * 5,
            share.max() * 10,
            -(share * np.log(share)).sum() / np.log(len(own) + 1) * 5,
            (1 - len(np.unique(pairs)) / len(pairs)) * 10 if len(pairs) else 0,
            (len(lines) - len(set(lines))) / len(lines) * 10,
            (own[1:] == own[:-1]).mean() * 10 if len(own) > 1 else 0,
            np.log1p(max(map(len, lines))) / 2,
        )
    found = np.column_stack([*columns, rest]).astype(np.float64)
    found[n_words == 0] = 0
    return found


class Fourier(NamedTuple):
    """Cosines whose inner products approximate a Gaussian kernel of ``width`` on standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.column_stack([waves, z, np.ones(len(x))])


class Classifier(NamedTuple):
    fourier: Fourier
    weights: np.ndarray
    knots: np.ndarray  # raw scores, rising
    levels: np.ndarray  # calibrated scores at the knots, never falling

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return np.interp(self.fourier(x) @ self.weights, self.knots, self.levels)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, -1)
    return x, np.array(batch.column(1).to_pylist(), float)


def _partition_sum(labelled: DataFrame, length: int, add) -> np.ndarray:
    """Sum of ``add(x, y)`` over all batches of (statistics, label) rows, first within partitions."""
    groups = parts(labelled)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(length), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                x, y = _matrix(batch.slice(at, 2048))
                total += add(x, y)
                n += len(y)
        if n:
            yield pieces(total, n % groups)

    return summed(labelled.mapInArrow(run, PARTIAL), length)


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to ``values`` by weighted squares: neighbours out of order are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(labelled: DataFrame, features: int = 256, width: float = 4.0, ridge: float = 1.0, bins: int = 512, seed: int = 8) -> Classifier:
    """Fits on (statistics array, label 0 or 1) rows; sums over all of them, in three passes over a small table.

    First the means and deviations, then the normal equations of the Fourier features, then the labels per bin of raw
    score for the calibration. The driver solves one system of ``features`` unknowns. Without rows, or with one label
    only, every score is the share of ones (one half without rows).
    """
    k = N_STATISTICS
    moments = _partition_sum(labelled, 2 * k + 2, lambda x, y: np.concatenate([x.sum(0), (x**2).sum(0), [len(y), y.sum()]]))
    n, ones = moments[-2:]
    share = ones / n if n else 0.5
    mean = moments[:k] / max(n, 1)
    deviation = np.sqrt(np.maximum(moments[k : 2 * k] / max(n, 1) - mean**2, 0))
    rng = np.random.default_rng(seed)
    fourier = Fourier(
        mean, np.where(deviation > 1e-6, deviation, 1.0), rng.normal(size=(k, features)) / width, rng.uniform(0, 2 * np.pi, features)
    )
    size = features + k + 1
    if not n or ones in (0, n):
        return Classifier(fourier, np.zeros(size), np.array([0.0]), np.array([share]))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _partition_sum(labelled, size * size + size, normal)
    left = sums[: size * size].reshape(size, size) + ridge * np.eye(size)
    left[-1, -1] -= ridge * 0.999
    weights = np.linalg.solve(left, sums[size * size :])

    def counts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = fourier(x) @ weights
        at = np.clip(((raw + 0.5) / 2 * bins).astype(int), 0, bins - 1)
        return np.concatenate([np.bincount(at, minlength=bins), np.bincount(at, y, bins), np.bincount(at, raw, bins)])

    seen, good, raw = _partition_sum(labelled, 3 * bins, counts).reshape(3, bins)
    used = seen > 0
    level = pooled(good[used] / seen[used], seen[used])
    return Classifier(fourier, weights, raw[used] / seen[used], np.clip(level, 0, 1))


def score(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    folds: int = 5,
    threshold: float = 0.3,
) -> DataFrame:
    """``docs`` with ``held_out`` (boolean), ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Labels are learnt from rows whose crc32 of the id, modulo ``folds``, is not 0; the text alone decides a score.
    Null and empty texts have statistics of zero and get that point's score. Rows with a null label teach nothing;
    an id labelled twice counts twice; a repeated document is scored each time. Columns with the names of the new
    ones are replaced.
    """
    new = T.StructType([T.StructField("__statistics", T.ArrayType(T.DoubleType(), False))])

    def start():
        return lambda texts: [pa.array(list(statistics(texts)), pa.list_(pa.float64()))]

    known = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("t"))
    held = crc_of(doc_id, folds) == 0
    measured = materialize(with_columns(known, "t", new, start, keep_text=False).distinct(), "statistics")
    taught = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    taught = taught.where(F.col("y").isin(0, 1) & (crc_of("id", folds) != 0))
    labelled = materialize(measured.join(taught, "id").select("__statistics", "y"), "labelled")
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled))
    scores = T.StructType([T.StructField("score", T.DoubleType())])

    def score_start():
        return lambda texts: [pa.array(model.value(statistics(texts)))]

    scored = with_columns(docs, text, scores, score_start)
    kept = [F.col(f"`{c}`") for c in scored.columns if c.lower() not in ("held_out", "score", "predicted")]
    return scored.select(
        *kept, held.alias("held_out"), F.col("score"), (F.col("score") >= threshold).cast("int").alias("predicted")
    )
