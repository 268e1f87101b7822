"""Lexical search against plain Python: pieces of any size, waves of any size, ties, repeated rows and odd texts."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from riskflow.llm import lexical
from tests.llm.conftest import ASCII_LOWER


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def ranked(docs, items, k):
    """(item, rank, doc, score) by the formula, without an index."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, tf, sum(tf.values())) for d, tf in held if tf]
    total, df = sum(n for *_, n in held), Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in items:
        scored = []
        for d, tf, n in held:
            m = 75 + 25 * n * len(held) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in terms(text)
                if t in tf
            )
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort()
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(scored[:k], 1)]
    return out


def found(spark, docs, items, k, **how):
    table = spark.createDataFrame([(*r, 1, "x", 2.0) for r in docs], "doc_id long, text string, m int, term string, ids double")
    asked = spark.createDataFrame([(*r, "x", 3) for r in items], "item_id long, text string, q string, score int")
    pieces = {n: how.pop(n) for n in ("piece_bytes", "piece_docs") if n in how}
    index = lexical.build_index(table, **pieces)
    return [tuple(r) for r in lexical.search(index, asked, k=k, **how).collect()]


def some(count):
    words = [f"w{i}" for i in range(40)] + ["Ünï", "cødé", "x1", "中文", "THE", "the"]
    return [" ".join(words[(i * 7 + j * j * (1 + i % 5)) % len(words)] for j in range(i * 13 % 60)) for i in range(count)]


@pytest.mark.parametrize("how", [{}, {"piece_docs": 3, "first_wave": 1, "item_block": 2}, {"piece_bytes": 200, "first_wave": 2}])
def test_search_equals_the_formula(spark, how):
    texts = some(150)
    docs = [*enumerate(texts), *((900 + i, texts[7]) for i in range(60))]
    items = [(i, texts[i] + " " + texts[(i * 3) % 150]) for i in range(0, 40, 3)] + [(500, "w1"), (501, "nowhere"), (502, "the THE The")]
    assert sorted(found(spark, docs, items, 20, **how)) == sorted(ranked(docs, items, 20))


def test_most_pieces_stay_closed(spark, monkeypatch):
    """Long and short documents of common words, and one piece with the rare ones: the first wave suffices."""
    docs = [(i, "common " * (1 + i % 30)) for i in range(600)] + [(1000 + i, "common rare query words here") for i in range(25)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    index = lexical.build_index(table)
    items = [(1, "common rare query words here")]
    waves, stored = [], lexical.materialize
    monkeypatch.setattr(lexical, "materialize", lambda df, name: waves.append(name) or stored(df, name))
    rows = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), first_wave=1).collect()
    assert [tuple(r) for r in sorted(rows, key=lambda r: r.rank)] == ranked(docs, items, 20)
    assert waves.count("wave") == 1


def test_edges(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, None), (2, ""), (3, "#$% !"), (4, "ONE"), (5, "same text here"), (5, "word1x1 end"), (None, "has cødé"), (6, "one"), (6, "one")]
    kept = [*items[:-1]]
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = lexical.search(lexical.build_index(odd_docs.withColumnRenamed("lang", "piece")), asked, k=3).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, ranked(docs, kept, 3)))
    assert lexical.search(lexical.build_index(no_docs), asked).count() == 0
    assert lexical.search(lexical.build_index(odd_docs), asked.limit(0)).count() == 0
