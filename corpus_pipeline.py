"""A training corpus from raw documents: quality, line dedup, near dedup, mixing, encoding.

Each stage takes the documents that the one before it kept, as a stored table, and gives a DataFrame; all but the last
give the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import bpe, line_dedup, minhash, mixing, quality
from riskflow.llm.words import table
from riskflow.session import bound_batches, materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but doc_id and text under numbered names, which clash with none, and the way back."""
    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]
    given = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)]
    return docs.select(*given), [F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, each row as it came.

    Null and empty texts are scored as empty ones; rows with equal texts have equal scores, so they stay or go together;
    without a usable label every document scores 0.5 and stays; an empty table gives an empty one.
    """
    bound_batches(spark)
    rows, back = _numbered(docs)
    return quality.score(rows, table(spark, sf_dir, "labels")).where("predicted = 1").select(*back)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; one that is nothing but such runs goes.

    A null text becomes empty, and texts without a line stay. Of documents with equal lines the earlier keeps them; rows
    of equal id and text are one document. ``n_chars`` follows a text that has lost lines. An empty table gives an empty one.
    """
    bound_batches(spark)
    rows, back = _numbered(docs)
    cut = line_dedup.dedup(rows)
    left = cut.where((F.col("n_lines") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        size = f"c{docs.columns.index('n_chars')}"
        left = left.withColumn(size, F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col(size)).cast("long"))
    return left.select(*back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are 0.8 similar: the one of smallest id.

    Texts without words (null, empty, blank) are linked with nothing and stay, as do rows without an id. Rows that
    repeat the kept id stay too. An empty table gives an empty one.
    """
    bound_batches(spark)
    rows, back = _numbered(docs)
    return minhash.near_duplicates(rows, size=5).where("kept").select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture reads them: each at least once, those of small sources up to twice.

    Null sources are one source; texts without words are read once; rows of one id are told apart by their texts, and
    equal rows are read as often as they stand. An empty table gives an empty one.
    """
    rows, back = _numbered(docs)
    row = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = rows.withColumn("own_row", row).dropDuplicates(["doc_id", "own_row"])
    readings = mixing.mix(docs, repetition=2.0).select(F.col("doc_id").alias("read_id"), F.col("row").alias("read_row"))
    same = F.col("doc_id").eqNullSafe(F.col("read_id")) & (F.col("own_row") == F.col("read_row"))
    return rows.join(readings, same).select(*back)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it.

    A null or empty text has no ids. Every row gives one, equal rows equal ones; an empty table gives an empty one.
    """
    path = public_tokenizers.path(VOCABULARY)
    rows = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.decode(bpe.encode(rows, path, public_tokenizers.PATTERN), path)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: classifiers, near copies and encoding have no SQL form; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
