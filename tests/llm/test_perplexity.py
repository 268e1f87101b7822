"""The Kneser-Ney model against plain Python, planted broken texts, and choices of few rows from many."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import perplexity
from riskflow.llm.vectors import bounded_sample
from riskflow.llm.words import hash_words, top_counts
from tests.llm.conftest import words


def some_texts() -> list[str]:
    rng = random.Random(4)
    kinds = [f"w{i}" for i in range(60)]
    return [" ".join(rng.choice(kinds[: rng.randint(2, 60)]) for _ in range(rng.randint(0, 80))) for _ in range(60)] + ["", "w1"]


def brute(texts: list[str], size: int) -> list[tuple[float, float]]:
    """log10 probability of the entries and of the words of each text, by the definition of the model."""
    counts = Counter(w for t in texts for w in t.split())
    key = {w: int(np.int64(hash_words([w.encode()], lower=False).hashes.view(np.int64)[0])) for w in counts}
    kept = set(sorted(counts, key=lambda w: (-counts[w], key[w]))[:size])
    lines = [["#", *(w if w in kept else "?" for w in t.split()), "#"] for t in texts]
    pairs = Counter(p for x in lines for p in zip(x, x[1:]))
    entries = len(kept) + 2

    def discount(values):
        n = Counter(min(v, 5) for v in values)
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0.0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return [0.0] + [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]

    d, total, taken, before = discount(pairs.values()), Counter(), Counter(), Counter()
    for (a, b), n in pairs.items():
        total[a] += n
        taken[a] += d[min(n, 3)]
        before[b] += 1
    e, kinds = discount(before.values()), sum(before.values())
    rest = sum(e[min(n, 3)] for n in before.values()) / kinds / entries

    def single(b):
        return max(before[b] - e[min(before[b], 3)], 0) / kinds + rest

    def probability(a, b):
        n = pairs[a, b]
        return (n - d[min(n, 3)]) / total[a] + taken[a] / total[a] * single(b)

    for a in total:  # what a word can be followed by adds up to one
        assert abs(sum(probability(a, b) for b in [*kept, "#", "?"]) - 1) < 1e-9
    out = []
    for x in lines:
        order = sum(math.log10(probability(a, b)) for a, b in zip(x, x[1:]))
        out.append((order, order - x.count("?") * math.log10(max(1, len(counts) - len(kept)))))
    return out


@pytest.mark.parametrize("size", [20, 58])
def test_model_against_brute_force(spark, size):
    texts = some_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    model = perplexity.fit(docs, vocabulary=size)
    got = model.score(hash_words([t.encode() for t in texts], lower=False))
    assert np.allclose(np.array(got).T, brute(texts, size), rtol=1e-5, atol=1e-4)


@pytest.mark.parametrize("block", [40, 1 << 21])
def test_every_word_and_pair_counts_without_the_text_itself(spark, monkeypatch, block):
    """log10 probability of each text from the counts of all other texts, however small the vocabulary is."""
    monkeypatch.setattr(perplexity, "BLOCK", block)
    texts = some_texts() + ["only here", "w1", None]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in perplexity.judge(docs, vocabulary=5).collect()}
    lines = [["#", *words(t, lower=False), "#"] for t in texts]
    kinds = len({w for x in lines for w in x})
    for i, x in enumerate(lines):
        others = [y for j, y in enumerate(lines) if j != i]
        single = Counter(w for y in others for w in y[1:])
        pairs = Counter(p for y in others for p in zip(y, y[1:]))
        tokens = sum(single.values())
        want = 0.0
        for a, b in zip(x, x[1:]):
            alone = (single[b] + 1) / (tokens + kinds + 1)
            want += math.log10((pairs[a, b] + perplexity.PRIOR * alone) / (single[a] + perplexity.PRIOR))
        assert got[i].log_words == pytest.approx(-want / (len(x) - 1), rel=1e-9)


def test_a_text_of_rare_words_out_of_order_is_rejected(spark):
    """The capped model takes rare words for one entry, so only the counts of all pairs tell their order."""
    rng = random.Random(7)
    phrases = [" ".join(f"rare{k}x{i}" for i in range(20)) for k in range(200)]
    frequent = " ".join(f"w{i}" for i in range(10))

    def prose():
        return " ".join(f"{frequent} {rng.choice(phrases)}" for _ in range(rng.randint(6, 12)))

    rows = [(i, "en", prose()) for i in range(400)]
    for k in range(20):
        parts = [rng.sample(prose().split()[10:30], 20) for _ in range(8)]
        rows.append((1000 + k, "en", " ".join(f"{frequent} {' '.join(p)}" for p in parts)))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = perplexity.judge(docs, vocabulary=10).collect()
    assert not any(r.kept for r in got if r.doc_id >= 1000)
    assert sum(r.kept for r in got if r.doc_id < 1000 and not r.base_failed) >= 0.99 * sum(not r.base_failed for r in got if r.doc_id < 1000)


def test_broken_texts_fall_out(spark):
    """Texts of misspelt words, texts of one frequent pair of words, and most shuffled ones, in two languages."""
    rng = random.Random(5)

    def prose(tongue, n):
        out, w = [], 0
        for _ in range(n):  # each word has a few that follow it
            w = (w * 7 + rng.choice((1, 2, 3, 5))) % 900
            out.append(f"{tongue}{w}" if rng.random() < 0.9 else f"{tongue}rare{rng.randrange(4000)}")
        return out

    given = [(tongue, prose(tongue, rng.randint(100, 400))) for tongue in ("en", "de") for _ in range(400)]
    rows = [(i, lang, " ".join(w)) for i, (lang, w) in enumerate(given)]
    for k, (lang, w) in enumerate(given[::20]):
        rows.append((10_000 + k, lang, " ".join(rng.sample(w, len(w)))))
        rows.append((20_000 + k, lang, " ".join("".join(rng.sample(x, len(x))) + rng.choice("xyz") for x in w)))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r.doc_id: r for r in perplexity.judge(docs, vocabulary=1000).collect()}
    assert all(len(words(t, lower=False)) == got[i].n_words for i, _, t in rows)
    plain = [r.kept for i, r in got.items() if i < 10_000]
    shuffled, broken = ([r.kept for i, r in got.items() if a <= i < a + 10_000] for a in (10_000, 20_000))
    assert sum(plain) >= 0.99 * len(plain)
    assert sum(shuffled) <= 0.1 * len(shuffled) and sum(broken) <= 0.1 * len(broken)


def test_top_counts(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(-(1 << 63), 1 << 63), rng.choice((1, 1, 1, 1, 2, 2, 3, 40, 41, 1000))) for _ in range(20_000)]
    counts = spark.createDataFrame(rows, "key long, n long").repartition(5)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    for size in (1, 10, 3000, 9000, 12_500, 30_000):
        assert [tuple(r) for r in top_counts(counts, size).collect()] == want[:size]
    assert top_counts(counts.limit(0), 5).count() == 0


def test_bounded_sample(spark):
    df = spark.range(5000).withColumn("id", F.when(F.col("id") < 1500, 7).otherwise(F.col("id")))
    for rows in (10, 200, 4000, 9000):
        want = df.orderBy(F.xxhash64("id"), "id").limit(rows).collect()
        assert bounded_sample(df, "id", rows).collect() == want
