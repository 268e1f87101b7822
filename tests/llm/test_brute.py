"""Operators against plain Python over the smallest tables, and classifiers on held-out rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from riskflow.llm import bpe, line_dedup, mixing, queries
from riskflow.session import materialize
from tests.compare import connect, difference
from tests.llm.conftest import words

SYMBOLS = set("#*$%&|<>")


def rows(small, table):
    return duckdb.sql(f"SELECT * FROM '{small}/{table}.parquet'").fetchdf()


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_query_equals_sql(spark, small, name):
    assert difference(spark, connect(small), small, queries.all_queries()[name], queries.all_oracles()[name]) is None


def test_links_of_close_vectors(spark):
    """Groups of near copies, one of them large, against all pairs."""
    from riskflow.llm import forest

    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    v = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0.05, 0.2, 0.3)] + [base[0] + rng.normal(size=(300, 16)) * 0.3])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in forest.near_duplicates(table, leaf_rows=100, block=64).collect()}
    want = {i: int(n) - 1 for i, n in enumerate(close.sum(1))}
    assert sum(got.values()) >= 0.99 * sum(want.values()) and all(got[i] <= want[i] for i in want)


def test_encoding(spark, small):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for r in rows(small, "documents").itertuples():
        ids = plain.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op5_byte_bpe(spark, small).collect()}
    assert got == want


def test_perplexity_base(spark, small):
    got = {r.doc_id: r for r in queries.op9_perplexity_rules(spark, small).collect()}
    for r in rows(small, "documents").itertuples():
        w = words(r.text, lower=False)
        windows = Counter(zip(w, w[1:], w[2:]))
        repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        have = got[r.doc_id]
        assert (have.n_words, have.word_chars) == (len(w), sum(map(len, w)))
        assert have.n_symbols == sum(c in SYMBOLS for c in r.text or "")
        assert (have.n_dup_lines, have.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert have.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert not (have.kept and have.base_failed)


def test_maxent_base(spark, small):
    docs = {r.doc_id: words(r.text) for r in rows(small, "documents").itertuples()}
    train = {i for i in docs if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = Counter(w for i in train for w in docs[i])
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    got = {r.doc_id: r for r in queries.op3_maxent_scoring(spark, small).collect()}
    for i, w in docs.items():
        base = sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w) + np.log10((len(train) + 1) / (n + v + 1))
        assert abs(got[i].base_score - base) < 1e-6 * (1 + abs(base)) and got[i].held_out == (i not in train)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize(("name", "label", "least"), [("op7_toxicity", "toxic", 0.9), ("op8_quality", "quality", 0.9)])
def test_classifiers_on_held_out_rows(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: getattr(r, label) for r in rows(folder, "labels").itertuples()}
    held = [r for r in queries.all_queries()[name](spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= least * len(held)


def test_swapped_identity_terms_hardly_change_a_score(spark):
    from riskflow.llm import toxicity

    texts = [(i, f"muslims are {'idiots scum' if i % 2 else 'kind people'} number {i}", i % 2) for i in range(60)]
    texts += [(100 + i, f"women in town {i} {'scum' if i % 5 == 0 else 'fine'}", int(i % 5 == 0)) for i in range(60)]
    docs = spark.createDataFrame([t[:2] for t in texts] + [(900, "christians in town"), (901, "muslims in town")], "doc_id long, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id long, toxic int")
    gaps = {}
    for fair in (0.0, 10.0):
        got = {r.doc_id: r.score for r in toxicity.score(docs, labels, fair=fair).collect()}
        gaps[fair] = abs(got[900] - got[901])
        assert got[901] < 0.5
    assert gaps[10.0] <= gaps[0.0] + 1e-9 and gaps[10.0] < 0.1


def test_line_runs(spark):
    long = [" ".join(f"w{k}x{i}" for i in range(12)) for k in range(6)]  # a passage of six lines of twelve words
    single = " ".join(f"s{i}" for i in range(55))
    docs = [
        (1, "\n".join(["first own line", *long, "tail"])), (2, "\n".join(["other", *long, "end"])), (3, single), (4, "before\n" + single + "\nafter"),
        (5, "\n".join(long[:1])), (6, "short line\nshort line\nshort line"), (7, "\n".join(["x", *[s.upper() for s in long[1:6]]])),
    ]
    got = {r.doc_id: r.text for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = dict(docs) | {2: "other\nend", 4: "before\nafter", 7: "x"}
    assert got == want


def test_no_long_line_is_kept_twice(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = [" ".join(words(line)) for r in line_dedup.dedup(docs).collect() for line in r.text.split("\n") if len(words(line)) >= 50]
    assert len(kept) == len(set(kept))


def test_mixture(spark, small):
    docs = rows(small, "documents")
    tokens = {r.doc_id: len(words(r.text)) for r in docs.itertuples()}
    source = dict(zip(docs.doc_id, docs.source, strict=True))
    each = Counter()
    for i, n in tokens.items():
        each[source[i]] += n
    found = mixing.mix(spark.read.parquet(f"{small}/documents.parquet"), repetition=1.5, block_tokens=2000).collect()
    used = Counter()
    for r in found:
        used[r.source] += r.n_tokens
    times = Counter((r.doc_id, r.epoch) for r in found)
    assert max(times.values()) == 1 and {r.doc_id for r in found} == set(tokens)
    share = {s: n / sum(each.values()) for s, n in each.items()}

    def most(a):
        p = {s: x**a for s, x in share.items()}
        scale = max(each[s] / p[s] for s in p)
        return max(p[s] * scale / each[s] for s in p), {s: p[s] * scale for s in p}

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if most(middle)[0] <= 1.5 else (middle, high)
    for s, quota in most(high)[1].items():
        assert -1 <= used[s] - quota <= max(n for i, n in tokens.items() if source[i] == s) + 1


def test_pipeline_against_brute_force(spark, small):
    """Each stage on what the one before it kept."""
    docs, texts = spark.read.parquet(f"{small}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, small), name)
        after = docs.collect()
        if name == "near_dedup":
            sets = {}
            for i, r in before.items():
                w = words(r.text)
                sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
            kept = {r.doc_id for r in after}
            for i, a in sets.items():
                close = [j for j, b in sets.items() if j < i and 100 * len(a & b) >= 80 * len(a | b) and a]
                assert (i in kept) == (not close)  # groups are small here: a smaller copy is a direct one
        if name == "mixing":
            assert {r.doc_id for r in after} == set(before)
            texts = {r.doc_id: r.text for r in after}
        if name == "encoding":
            assert all(r.round_trip for r in after) and {r.doc_id for r in after} == set(texts)
