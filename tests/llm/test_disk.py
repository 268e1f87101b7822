"""What operators leave on disk while they run: no shuffle files of finished steps, no rounds that are over."""

from __future__ import annotations

import random
import time
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from riskflow import session
from riskflow.llm import components as stars
from riskflow.llm import minhash, perplexity


def shuffle_bytes(spark) -> int:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for folder in folders for f in Path(folder).rglob("shuffle_*") if f.is_file())


def settled(spark) -> int:
    """Bytes of shuffle files once they stop to fall; they are removed in the background."""
    found = [shuffle_bytes(spark)]
    for _ in range(20):
        time.sleep(0.2)
        found.append(shuffle_bytes(spark))
    return found[-1]


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = settled(spark)
    rows = spark.range(200_000).select(F.xxhash64("id").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    table = session.materialize(rows, "rows")
    assert settled(spark) <= before + 10_000
    assert table.count() == 200_000 and spark.conf.get(session._CLEANUP) == "false"


def test_only_tables_that_were_written_are_discarded(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/given")
    session.discard(spark.read.parquet(f"{tmp_path}/given"))
    assert spark.read.parquet(f"{tmp_path}/given").count() == 3
    table = session.materialize(spark.range(3), "rows")
    folder = Path(table.inputFiles()[0].removeprefix("file:")).parent
    session.discard(table)
    assert not folder.exists()


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(stars, "materialize", lambda df, name: written.append(name) or session.materialize(df, name))
    given = spark.range(1, 100).select("id", (F.col("id") - F.col("id") % 10).alias("root")).where("id <> root")
    found = stars.components(given, "id", "root")
    assert len(written) == 1
    assert {(r.id, r.component_id) for r in found.collect()} == {(i, i - i % 10) for i in range(100)}
    again = stars.components(found, "id", "component_id")
    assert len(written) == 2 and sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(5, 5), (None, 3), (7, 2), (2, 7)]
    root = {x: x for e in edges for x in e}
    for _ in range(70):
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    joined = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    found = stars.components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.id, r.component_id) for r in found.collect()} == {(x, root[x]) for x in joined}


def test_near_duplicates_start_from_the_components_before(spark, monkeypatch):
    """After the first links, rounds are taken only for what further links change: here for nothing."""
    rounds = []

    def counted(df, name):
        rounds.append(name)
        return session.materialize(df, name)

    monkeypatch.setattr(stars, "materialize", counted)
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(30)]
    docs = spark.createDataFrame([(10 * k + j, t + " end" * j) for k, t in enumerate(texts) for j in range(3)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {10 * k + j: 10 * k for k in range(30) for j in range(3)}
    assert len(rounds) <= 3 + 2


def test_integers_by_byte_planes():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 1 << 63, 50_000).astype(np.uint64) * np.uint64(2))
    raw = perplexity.pressed(perplexity.apart(hashes))
    assert len(raw) < 0.9 * hashes.nbytes  # as random as they are
    assert (np.cumsum(perplexity.unpressed(raw, np.uint64), dtype=np.uint64) == hashes).all()
    shuffled = rng.permutation(hashes)
    assert (np.cumsum(perplexity.unpressed(perplexity.pressed(perplexity.apart(shuffled)), np.uint64), dtype=np.uint64) == shuffled).all()
    for kind in (np.int32, np.int64):
        few = np.array([5, -3, 1 << 30], kind)
        assert (perplexity.unpressed(perplexity.pressed(few), kind) == few).all()


def test_counts_of_all_pairs_go_in_slices(spark, monkeypatch):
    """The largest written or shuffled step holds a part of the keys: each table of sums about a quarter."""
    sizes = []

    def counted(df, name):
        table = session.materialize(df, name)
        if name == "sums":
            sizes.append(table.groupBy("kind").agg(F.sum("distinct").alias("n")).orderBy("kind").collect())
        return table

    monkeypatch.setattr(perplexity, "materialize", counted)
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(2000)}" for _ in range(200)), "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    perplexity.judge(docs, vocabulary=50).collect()
    assert len(sizes) == perplexity.SLICES
    words, pairs = ([r[k].n for r in sizes] for k in range(2))
    lines = [["#", *t.split(), "#"] for _, t, _ in rows]
    assert sum(words) == len({w for x in lines for w in x}) and max(words) < 0.4 * sum(words)
    assert sum(pairs) == len({p for x in lines for p in zip(x, x[1:])}) and max(pairs) < 0.3 * sum(pairs)


def test_the_model_goes_before_all_words_are_counted(spark, monkeypatch):
    """No broadcast of the capped model is left as a file when the exact counts begin to take disk."""
    folder = Path(spark.sparkContext._temp_dir)
    known, left, count = set(folder.iterdir()), [], perplexity.log_words
    monkeypatch.setattr(perplexity, "log_words", lambda *given: left.append(set(folder.iterdir()) - known) or count(*given))
    docs = spark.createDataFrame([(i, f"one two w{i} three " * 30, "en") for i in range(20)], "doc_id long, text string, lang string")
    assert len(perplexity.judge(docs).collect()) == 20
    assert left == [set()]
