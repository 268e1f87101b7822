"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from riskflow.llm import bpe, forest, html, line_dedup, maxent, minhash, mixing, perplexity, quality, toxicity

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_minhash(odd_docs, no_docs):
    found = minhash.near_duplicates(odd_docs)
    rows = found.collect()
    assert len(rows) == odd_docs.count() and "Score" in found.columns and found.columns[-1] == "kept"
    got = by_id(found)
    assert [got[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert {i: got[i].component_id for i in got} == {
        1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 9, 11: 11, 12: 12, 13: 13, 14: 4
    }
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_forest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0]), (11, []), (12, [1.0, 2.0, 3.0]),
    ]
    table = spark.createDataFrame([(*r, 1.5, "x") for r in rows], "vec_id long, embedding array<float>, N_LINKS double, label string")
    got = {r.vec_id: r for r in forest.near_duplicates(table).collect() if r.vec_id is not None}
    assert {i: got[i].n_links for i in got} == {1: 4, 2: 4, 3: 4, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 9, 11: 0, 12: 0}
    assert {i for i in got if got[i].component_id == 1} == {1, 2, 3, 10}
    assert forest.near_duplicates(table).count() == len(rows)
    assert forest.near_duplicates(table.limit(0)).count() == 0


def test_maxent(odd_docs, no_docs):
    rows = maxent.score(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.score <= 0 and r.base_score <= 0 and 0 <= r.n_known <= r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert maxent.score(no_docs).count() == 0


def test_html(spark):
    pages = [(1, None), (2, ""), (3, "<p></p>"), (4, "no markup"), (5, "<p>" * 30_000 + "deep"), (6, "<article><p>a &amp; b &#233;<br>c</p><p>x"), (6, "<!-- <p>no</p>")]
    table = spark.createDataFrame([(*p, "old", 3) for p in pages], "page_id long, html string, TEXT string, url long")
    rows = html.extract(table).collect()
    assert sorted((r.page_id, r.text) for r in rows) == sorted(
        [(1, ""), (2, ""), (3, ""), (4, "no markup"), (5, "deep"), (6, "a & b é c\n\nx"), (6, "")]
    )
    assert html.extract(table.limit(0)).count() == 0


def test_bpe(odd_docs, no_docs):
    coded = bpe.encode(odd_docs, PATH, PATTERN)
    rows = bpe.decode(coded, PATH).collect()
    assert len(rows) == odd_docs.count()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert bpe.encode(no_docs, PATH, PATTERN).count() == 0


def test_line_dedup(odd_docs, no_docs):
    rows = line_dedup.dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {(r.doc_id, r.text): r for r in rows}
    assert got[(12, "a line that comes back " * 12)].n_deleted == 2
    assert all(r.n_lines == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert line_dedup.dedup(no_docs).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers(module, odd_docs, no_docs, some_labels, no_labels):
    rows = module.score(odd_docs, some_labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in module.score(odd_docs, no_labels).collect()} == {0.5}
    assert module.score(no_docs, some_labels).count() == 0


def test_perplexity(odd_docs, no_docs):
    rows = perplexity.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert perplexity.judge(no_docs).count() == 0


def test_mixing(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in odd_docs.collect()}
    assert mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages(stage, spark, odd_docs, no_docs, some_labels, tmp_path):
    some_labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = stage(spark, odd_docs, str(tmp_path))
    assert out.count() > 0
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == odd_docs.columns
    assert stage(spark, no_docs, str(tmp_path)).count() == 0
