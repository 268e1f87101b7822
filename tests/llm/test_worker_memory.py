"""What Python workers hold: one operator's caches at a time, and each text once."""

from __future__ import annotations

import gc
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from riskflow import session
from riskflow.llm import bpe, line_dedup, minhash
from riskflow.llm.words import held, let_go, with_columns

PATH = "byte_bpe_multi_50k.tiktoken"
N = T.StructType([T.StructField("n", T.LongType())])


def encoders():
    """For each text, how many encoders its worker process holds."""
    return lambda texts: [pa.array([sum(isinstance(x, bpe.Encoder) for x in gc.get_objects())] * len(texts), pa.int64())]


def lengths():
    return lambda texts: [pa.array([len(t) for t in texts], pa.int64())]


def travelling(df):
    """The columns that go into the Python workers, and those that come back."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() != "MapInArrow":
        plan = plan.children().head()
    names = [re.findall(r"(\w+)#", x.output().mkString(" ")) for x in (plan.children().head(), plan)]
    return names[0], names[1]


def test_other_operators_let_an_encoder_go(spark):
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text")).repartition(8)
    path = public_tokenizers.path(PATH)
    for _ in range(3):
        coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
        assert coded.where(F.col("decoded").cast("string") == F.col("text")).count() == 64
    assert with_columns(docs, "text", N, encoders).agg(F.sum("n")).first()[0] == 0


def test_what_is_held_is_made_once_until_let_go():
    let_go()
    made = []
    for key in ("a", "a", "b"):
        let_go("a")
        held(key, lambda: made.append(1) or len(made))
    assert held("a", lambda: 0) == 1 and held("b", lambda: 0) == 2
    let_go("a")
    assert held("b", lambda: 3) == 3 and held("a", lambda: 0) == 1
    let_go()
    assert held("a", lambda: 4) == 4
    let_go()


def test_a_text_travels_once(spark):
    rows = [(1, None), (2, ""), (3, "ünï 😀\x00"), (4, "x" * 300_000), (4, "x" * 300_000), (None, "a\nb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = with_columns(docs, "text", N, lengths)
    assert travelling(made) == (["c0", "c1"], ["c0", "c1", "n0"])
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(map(tuple, made.collect()), key=key) == sorted([(i, t, len((t or "").encode())) for i, t in rows], key=key)
    binary = with_columns(docs.select("doc_id", F.col("text").cast("binary").alias("text")), "text", N, lengths)
    assert sorted(r.n for r in binary.collect()) == sorted(len((t or "").encode()) for _, t in rows)
    invalid = spark.sql("SELECT CAST(X'61FF62' AS STRING) AS text")
    assert with_columns(invalid, "text", N, lengths).select(F.hex("text"), "n").first() == ("61FF62", 3)


def test_texts_do_not_come_back_from_workers_that_only_measure(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    signed = minhash.signatures(docs, "text", 4, 2, 2)
    assert signed.columns == ["doc_id", *minhash.SIGNATURE.names]
    assert travelling(signed) == (["c0", "t"], ["c0", *(f"n{i}" for i in range(6))])
    lines = line_dedup.sequences(docs, "text", "doc_id", 25, 50)
    assert lines.columns == ["id", "row", "hashes", "marks", "windows"]
    assert travelling(lines)[1] == ["c0", "c1", "n0", "n1", "n2"]
    assert [r.n_shingles for r in signed.orderBy("doc_id").collect()] == [3, 0]


def test_batches_for_workers_are_bounded(spark):
    before = spark.conf.get(session._BATCH)
    try:
        spark.conf.set(session._BATCH, "64m")
        docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text")).coalesce(1)
        corpus_pipeline.keep_good(spark, docs.limit(0), "/root/testdata/sf0.001")
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long")
        found = [r.n for r in sizes.collect()]
        assert sum(found) > 20_000_000 and max(found) <= session.BATCH_BYTES + 10_000
        one = docs.limit(2).withColumn("text", F.repeat("text", 1000))
        assert with_columns(one, "text", N, lengths).agg(F.min("n")).first()[0] == 5_000_000
        for given, left in (("1000b", True), ("2m", True), ("64k", True), ("5m", False), ("64m", False), ("1g", False)):
            spark.conf.set(session._BATCH, given)
            session.bound_batches(spark)
            assert (spark.conf.get(session._BATCH) == given) == left
    finally:
        spark.conf.set(session._BATCH, before)
