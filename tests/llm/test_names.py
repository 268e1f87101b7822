"""Extra columns under the names that operators use inside: nothing crashes and nothing is lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskflow.llm import forest, lexical, line_dedup, maxent, minhash, mixing, negatives, perplexity, token_file
from riskflow.session import work_path

NAMES = [
    "id__", "id2__", "row__", "row2__", "own__", "own_id__", "own_row__", "group__", "links__", "read_id", "read_row", "own_row", "row", "DECODED",
    "middle", "below", "above", "lang_key", "bar", "q", "c0", "c1", "t", "n", "N_LINES", "n_deleted", "Score", "predicted", "component_id_", "place", "part",
]


@pytest.fixture(scope="module")
def named(spark, odd_docs):
    """Each row with its own values in columns of all these names."""
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is null or doc_id <> 8")
    return plain.withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES})


def untouched(df, names=NAMES):
    wrong = [F.count_if(~F.col(f"`{n}`").eqNullSafe(F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))).alias(f"w{i}") for i, n in enumerate(names)]
    return all(v == 0 for v in df.agg(*wrong).first())


def test_operators_on_texts(spark, named):
    count = named.count()
    for found, replaced in (
        (minhash.near_duplicates(named), ()),
        (maxent.score(named), ("Score",)),
        (perplexity.judge(named), ()),
        (line_dedup.dedup(named), ("N_LINES", "n_deleted")),
    ):
        assert found.count() == count and untouched(found, [n for n in NAMES if n not in replaced])
    assert mixing.mix(named).count() >= count - 2
    path = work_path(spark, "files")
    token_file.write(named, path, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"), end=2)
    assert token_file.read(spark, path).count() == count
    items = named.select(F.col("doc_id").alias("item_id"), *[c for c in named.columns if c != "doc_id"])
    assert lexical.search(lexical.build_index(named), items).count() > 0


def test_operators_on_vectors(spark):
    rows = spark.range(0, 300).selectExpr("id AS vec_id", "id AS doc_id", "transform(sequence(0, 7), i -> float(sin(id * (i + 1) / 40))) AS embedding", "cast(id % 3 AS int) AS label")
    named = rows.withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in [*NAMES, "anchor", "d", "limits"]})
    found = forest.near_duplicates(named)
    assert found.count() == 300 and untouched(found)
    plain = sorted(map(str, negatives.mine(rows).collect()))
    assert sorted(map(str, negatives.mine(named).collect())) == plain and plain


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_the_columns_as_they_came(spark, named, some_labels, stage, tmp_path):
    some_labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = stage[1](spark, named, str(tmp_path))
    assert out.columns == named.columns and out.count() > 0 and untouched(out)


def test_the_last_stage(spark, named, tmp_path):
    out = corpus_pipeline.encode(spark, named, str(tmp_path))
    assert out.count() == named.count() and out.where("not round_trip").isEmpty()
