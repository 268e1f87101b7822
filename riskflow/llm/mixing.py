"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

All built from DataFrame operations. A source's weight is its token share to the power ``exponent``, scaled to one.
Exponent 1 keeps the shares, 0 makes all sources equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str) -> Column:
    """A source as a join key that is never null; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("")).alias("source_key")


def totals(tokens: DataFrame) -> DataFrame:
    """(source_key, n_tokens, n_docs, share) of all sources that have tokens."""
    each = tokens.groupBy("source_key").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    each = materialize(each.where("n_tokens > 0"), "sources")
    everything = each.agg(F.sum("n_tokens").alias("total")).first().total
    return each.withColumn("share", F.col("n_tokens") / F.lit(float(everything or 1)))


def reached(sources: DataFrame, exponents: list[float], entropy: float | None, repetition: float | None, budget: float | None) -> list[bool]:
    """For each exponent, whether its weights meet the target; one aggregation for all exponents.

    ``entropy``: the weights' entropy is at least that share of the greatest possible. ``repetition``: the most
    repeated source is read at most that often. With no budget, it is the least one that reads every source once.
    """
    columns = []
    for i, a in enumerate(exponents):
        p = F.pow(F.col("share"), F.lit(a))
        columns += [
            F.sum(p).alias(f"z{i}"), F.sum(p * F.log(p)).alias(f"h{i}"), F.max(p / F.col("n_tokens")).alias(f"most{i}"),
            F.min(p / F.col("n_tokens")).alias(f"least{i}"),
        ]
    row = sources.agg(F.count("*").alias("n"), *columns).first()
    if not row["n"]:
        return [True] * len(exponents)
    found = []
    for i in range(len(exponents)):
        z = row[f"z{i}"]
        if entropy is not None:
            spread = log(z) - row[f"h{i}"] / z
            found.append(spread >= entropy * log(row["n"]) - 1e-12)
        else:
            scale = budget / z if budget is not None else 1 / row[f"least{i}"]
            found.append(row[f"most{i}"] * scale <= repetition * (1 + 1e-12))
    return found


def log(x: float) -> float:
    return math.log(x) if x > 0 else 0.0


def bisect(sources: DataFrame, entropy: float | None = None, repetition: float | None = None, budget: float | None = None, rounds: int = 8) -> float:
    """The exponent in 0 to 1 at which the target is just met, to within 16 ** -rounds.

    A higher exponent follows the shares more closely: entropy falls with it, so the largest that still meets an
    entropy target is taken; the repetition of small sources falls too, so the smallest within a repetition limit
    is. Each round tries the 15 points that four halvings can reach, so four bisection steps cost one aggregation
    over the table of sources.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give either a target entropy or a repetition limit")
    low, high = 0.0, 1.0
    ends = reached(sources, [0.0, 1.0], entropy, repetition, budget)
    if entropy is not None:
        if ends[1] or not ends[0]:
            return 1.0 if ends[1] else 0.0
    elif ends[0] or not ends[1]:
        return 0.0 if ends[0] else 1.0
    for _ in range(rounds):
        points = [low + (high - low) * k / 16 for k in range(17)]
        met = [None, *reached(sources, points[1:-1], entropy, repetition, budget), None]
        a, b = 0, 16
        while b - a > 1:
            middle = (a + b) // 2
            if met[middle] == (entropy is not None):
                a = middle
            else:
                b = middle
        low, high = points[a], points[b]
    return low if entropy is not None else high


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    entropy: float | None = None,
    repetition: float | None = 2.0,
    budget: float | None = None,
    block_tokens: int = 1_000_000,
    seed: int = 10,
) -> DataFrame:
    """(doc_id, source, n_tokens, row, epoch, block, block_rank, doc_rank) of every reading of a document in the mixture.

    ``row`` is a hash of the text, to tell rows of one id apart; sorting by epoch and the ranks gives a source's order.

    Tokens are words. Source s gets weight x budget tokens. Its documents are dealt to blocks of about
    ``block_tokens`` by a hash of the id; each epoch reads the blocks in an order of its own, and a block's documents
    likewise. Whole epochs read every document once; the last one stops at the first document that starts at or beyond
    the tokens left, so a source exceeds its tokens by less than one document. Without a budget, the least one is
    taken that reads every document of every source at least once, so nothing is lost.

    Documents without words belong to no quota and are read once, in epoch 0. Null sources form one source, null ids
    and repeated rows are dealt like others (equal rows are interchangeable). No single task holds a source: sums are
    per block, running sums over the blocks of a source, and over the documents of a block.
    """
    tokens = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("n_tokens"), source_key(source), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("row"))
    tokens = materialize(tokens, "tokens")
    sources = totals(tokens)
    exponent = bisect(sources, entropy, repetition, budget)
    power = F.pow(F.col("share"), F.lit(exponent))
    z = sources.agg(F.sum(power).alias("z"), F.min(power / F.col("n_tokens")).alias("least")).first()
    if budget is not None:
        scale = budget / z.z if z.z else 0.0
    else:
        scale = 1 / z.least if z.least else 0.0
    blocks_of = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.lit(block_tokens)))
    plan = sources.select(
        "source_key",
        blocks_of.alias("n_blocks"),
        F.col("n_tokens").alias("source_tokens"),
        # a quota a hair below a whole number of epochs is that number
        F.ceil(power * F.lit(scale) * (1 - 1e-9)).cast("long").alias("quota"),
    ).withColumn("quota", F.greatest("quota", F.when(F.lit(budget is None), F.col("source_tokens")).otherwise(F.lit(0))))
    plan = materialize(plan, "plan")
    dealt = tokens.where("n_tokens > 0").join(plan, "source_key")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.col("n_blocks")))
    blocks = dealt.groupBy("source_key", "block").agg(
        F.sum("n_tokens").alias("block_tokens"), F.first("quota").alias("quota"), F.first("source_tokens").alias("source_tokens")
    )
    last = F.ceil(F.col("quota") / F.col("source_tokens")) - 1
    epochs = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0))))).where("quota > 0")
    order = Window.partitionBy("source_key", "epoch").orderBy(F.xxhash64("block", "epoch", F.lit(seed)), "block")
    before = F.coalesce(F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    epochs = epochs.withColumn("before", before).withColumn("block_rank", F.row_number().over(order) - 1)
    left = F.col("quota") - F.col("epoch") * F.col("source_tokens") - F.col("before")
    epochs = epochs.withColumn("left", left).where("left > 0")
    epochs = materialize(epochs.select("source_key", "block", "epoch", "block_rank", "left", "block_tokens"), "epochs")
    read = dealt.select("doc_id", "source", "n_tokens", "row", "source_key", "block").join(epochs, ["source_key", "block"])
    own = Window.partitionBy("source_key", "block", "epoch").orderBy(F.xxhash64("doc_id", "row", "epoch", F.lit(seed)), "doc_id", "row")
    start = F.coalesce(F.sum("n_tokens").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    read = read.withColumn("start", start).withColumn("doc_rank", F.row_number().over(own) - 1).where(F.col("start") < F.col("left"))
    empty = tokens.where("n_tokens = 0").select(
        "doc_id", "source", "n_tokens", "row", F.lit(0).cast("long").alias("epoch"), F.lit(-1).cast("long").alias("block"), F.lit(-1).alias("block_rank"), F.lit(-1).alias("doc_rank")
    )
    return read.select("doc_id", "source", "n_tokens", "row", "epoch", "block", "block_rank", "doc_rank").unionByName(empty)
