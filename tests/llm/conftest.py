from __future__ import annotations

import re

import pytest

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(ASCII_LOWER) if lower else text)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, very long, tied and repeated rows, in a table with extra and clashing column names."""
    long = " ".join(f"word{i % 997}x{i % 31}" for i in range(60_000))
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "a b c"), (7, long), (8, long + " end"),
        (9, "same text here now and again"), (10, "same text here now and again"), (10, "same text here now and again"),
        (11, "ünï cødé   ok 😀 \x00 \x1f x"), (12, "\n".join(["a line that comes back " * 12] * 3)), (None, "no id has this one"),
        (None, None), (13, "#$% && !!"), (14, "one"),
    ]
    rows = [(i, t, "en" if i and i % 2 else None, None if i in (3, 4) else "s", 7, "old", 0.5, True) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, Score string, n_links double, KEPT boolean"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(i, i % 2, i % 3 == 0) for i in range(1, 15)] + [(None, 1, True), (3, None, None), (99, 1, False)]
    return spark.createDataFrame([(a, b, None if c is None else int(c)) for a, b, c in rows], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(some_labels):
    return some_labels.limit(0)
