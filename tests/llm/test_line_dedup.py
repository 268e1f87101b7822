"""Line deduplication against all runs of lines that stand earlier."""

from __future__ import annotations

import itertools
import random

import numpy as np

from riskflow.llm import line_dedup


def line(name: str, n: int) -> str:
    return " ".join(f"{name}{i}" for i in range(n))


def covered(docs: list[tuple[int, str]], least: int) -> set[tuple[int, int]]:
    """(id, line) of the lines in runs of ``least`` words that stand in an earlier document or further up."""
    seen, gone = set(), set()
    for doc_id, text in sorted(docs):
        lines = text.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[a:b]) >= least:
                    run = tuple(lines[a:b])
                    if run in seen:
                        gone |= {(doc_id, i) for i in range(a, b)}
                    seen.add(run)
    return gone


def kept_lines(spark, docs: list[tuple[int, str]]) -> dict[int, str]:
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: r.text for r in line_dedup.dedup(df).collect()}


def test_a_run_that_stands_whole_in_a_later_earlier_document(spark):
    """The first documents with its grams hold only parts of the run; a later one holds all of it."""
    run = [line(f"r{k}x", 13) for k in range(5)]
    docs = [(i + 1, "\n".join(["own" + str(i), *run[a:b], "after" + str(i)])) for i, (a, b) in enumerate([(0, 2), (0, 3), (1, 3), (1, 4), (2, 4), (2, 5), (3, 5)])]
    docs += [(20, "\n".join(["head", *run, "foot"])), (21, "\n".join(["top", *run, "end"]))]
    assert kept_lines(spark, docs)[21] == "top\nend"


def test_all_runs_of_fifty_words_go(spark):
    """Random documents of few different lines: no long run that stands earlier stays, and no short one goes."""
    rng = random.Random(5)
    pool = [line(f"p{k}x", rng.choice([4, 9, 13, 17, 24])) for k in range(14)]
    docs = []
    for i in range(150):
        at = rng.randrange(len(pool))
        lines = []
        for _ in range(rng.randrange(2, 12)):
            lines.append(pool[at])
            at = (at + 1) % len(pool) if rng.random() < 0.8 else rng.randrange(len(pool))
        lines.insert(rng.randrange(len(lines) + 1), line(f"own{i}x", 5))
        docs.append((i, "\n".join(lines)))
    got = kept_lines(spark, docs)
    must, may = covered(docs, 50), covered(docs, 25)
    for doc_id, text in docs:
        lines = text.split("\n")
        least = [x for i, x in enumerate(lines) if (doc_id, i) not in must]
        most = [x for i, x in enumerate(lines) if (doc_id, i) not in may]
        stay = [x for x in got[doc_id].split("\n") if x]
        rest = iter(least)
        assert all(x in rest for x in stay), "a line of a run of fifty words that stands earlier was kept"
        again = iter(stay)
        assert all(x in again for x in most if x), "a line outside all earlier runs of 25 words was deleted"


def test_every_alignment_of_a_gram_is_extended():
    """The earlier document holds a notice twice, with different lines after it; no order of the links loses lines."""
    notice, z, y = [1, 2], [30, 31, 32], [40, 41, 42]
    other = np.array([*notice, *z, *notice, *y], np.uint64)
    own = np.array([9, *notice, *y, 8], np.uint64)
    links = [{"at": 1, "at2": 0, "n": 2}, {"at": 1, "at2": 5, "n": 2}, {"at": 2, "at2": 6, "n": 3}]
    for order in itertools.permutations(links):
        runs = line_dedup.linked_runs(own, other, list(order))
        assert {i for a, b in runs for i in range(a, b)} == set(range(1, 6))


def test_alignments_of_one_repeated_line():
    own = np.full(5000, 7, np.uint64)
    links = [{"at": i, "at2": 0, "n": 1} for i in range(1, 5000)]
    assert line_dedup.linked_runs(own, own, links) == [(1, 5000)]
