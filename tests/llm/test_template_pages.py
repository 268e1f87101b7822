"""Pages of one template: they share table keys in all combinations, but few of them link."""

from __future__ import annotations

import random

from riskflow.llm import minhash


def family(n: int, length: int, changed: float, seed: int = 5) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(length)]
    texts = [" ".join(w if rng.random() > changed else f"w{rng.randrange(10**9)}" for w in template) for _ in range(n)]
    for i in range(0, n, 25):  # a near copy of a page, linked with it
        texts.append(texts[i] + " and one end more")
    return list(enumerate(texts))


def brute_force(docs: list[tuple[int, str]]) -> dict[int, int]:
    sets = {}
    for i, text in docs:
        w = text.split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in sets}


def test_template_pages(spark):
    """Small cells, so that keys are joined as well as cut into several cells."""
    docs = family(220, 120, 0.05)
    want = brute_force(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(table, cell=4).collect()}
    assert got == want and len(set(want.values())) < len(want)
