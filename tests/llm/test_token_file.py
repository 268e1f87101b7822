"""Token files: the packed blocks, the encoder against the library, and whole files read back."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskflow.llm import queries, token_file
from riskflow.llm.packed import BLOCK, pack, unpack
from riskflow.session import work_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(path=PATH):
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


def expected(rows, end=2):
    """doc_id to its (start, n_tokens, ids_crc32) by the library, in ascending order of doc_id."""
    own, out, start = library(), {}, 0
    for doc_id, text in sorted(rows):
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=400),
    st.sampled_from([0.0, 50.0, 90.0, 100.0]),
    st.integers(0, 400),
    st.integers(0, 400),
)
def test_packed_values_come_back(values, percentile, first, last):
    given = np.array(values, np.uint32)
    body = pack(given, percentile)
    assert unpack(body).tolist() == values
    assert unpack(body, first, last).tolist() == values[first:last]


def test_outliers_are_exceptions():
    values = np.arange(BLOCK, dtype=np.uint32) % 8 + 1000
    plain = len(pack(values))
    values[[3, 77]] = 4_000_000_000
    assert len(pack(values)) == plain + 2 * 5  # a position and a value each, at the same width
    assert len(pack(values, 100)) > 4 * BLOCK
    assert (unpack(pack(values)) == values).all()


def test_pieces_give_the_ids_of_whole_texts():
    with open(PATH, encoding="utf-8") as lines:
        own = token_file.Encoder(lines.read())
    assert own.cuts
    parts = [*"    abcXYZ'.,!?0123-<|>\n\t", "é", "ß", "д", "中", "😀", "\x1f", "\x85", "\xa0", "×", "é", "²", "Ⅷ", "'s", "'ll", " the", "<|endoftext|>"]
    rng = random.Random(5)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(8000)]
    plain = library()
    for a in range(0, len(texts), 200):
        want = [e.ids for e in plain.encode_batch(texts[a : a + 200], add_special_tokens=False)]
        assert [found.tolist() for found in own.encode(texts[a : a + 200])] == want


def test_words_marks_and_lines_are_encoded_once():
    """The library gets each different word once, not each pair of words that a line feed joins or each mark behind a word."""
    with open(PATH, encoding="utf-8") as lines:
        own = token_file.Encoder(lines.read())
    given, whole = [], own._whole
    own._whole = lambda texts: given.extend(texts) or whole(texts)
    words = [f"{a}{b}" for a in ("bra", "ño", "stre", "Kü") for b in ("ven", "lim", "too", "rß")]
    texts = [f"{a} {b}%%%\n{a}.\n{b}\n\n{a}'s {b}'" for a in words for b in words]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [found.tolist() for found in own.encode(texts)] == want
    assert sum(map(len, given)) < sum(map(len, texts)) / 20
    before = len(given)
    assert [found.tolist() for found in own.encode(texts)] == want
    assert len(given) == before


def test_pieces_met_again_are_kept_when_others_are_forgotten(monkeypatch):
    with open(PATH, encoding="utf-8") as lines:
        own = token_file.Encoder(lines.read())
    monkeypatch.setattr(token_file, "KEPT_PIECES", 1000)
    plain = library()
    for k in range(12):
        text = " often again" + "".join(f" x{k}y{i}" for i in range(300)) + " " + "long" * 50
        assert own.encode([text, "", text])[2].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(own.pieces) <= 1000 and (k < 4 or own.pieces[b" again"] < 300)
    assert len(own.ids) < 12 * 300


@pytest.mark.parametrize("character", [*map(chr, [0x1C, 0x85, 0xA0, 0xAD, 0xD7, 0x301, 0x3A2, 0x61C, 0x1680, 0x180E, 0x2003, 0x2028, 0x202F, 0x3000, 0x4E2D, 0xFEFF, 0x1F600])])
def test_cuts_beside_rare_characters(character):
    with open(PATH, encoding="utf-8") as lines:
        own = token_file.Encoder(lines.read())
    around = ["", " ", "  ", "\n", "\n\n", "a", ".", "'s", "é", " \n", "\n "]
    texts = [f"{a}{character}{b}{c}" for a in around for b in around for c in ("", "x", "\nx", " x")]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [found.tolist() for found in own.encode(texts)] == want


def test_other_tokenizers_get_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as lines:
        own = token_file.Encoder(lines.read())
    texts = ["A cat  sat", "", " on <|endoftext|> mats"]
    assert not own.cuts
    assert [x.tolist() for x in own.encode(texts)] == [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]


def test_query_equals_the_library(spark, small):
    want = expected(duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_token_files(spark, small).collect()}
    assert got == want


@pytest.mark.parametrize("segment_ids", [1, 700])
def test_spans_over_segments_and_files(spark, small, segment_ids):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5)
    path = work_path(spark, "files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_file.write(docs, path, PATH, end=2, segment_ids=segment_ids)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = token_file.read(spark, path).orderBy("start").collect()
    whole = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    assert spark.read.parquet(path).select("part").distinct().count() > 1
    for first, last in ((0, 1), (650, 2100), (len(whole) - 3, len(whole) + 9)):
        found = token_file.read_span(spark, path, first, last).orderBy("start").collect()
        assert np.concatenate([r.ids for r in found]).tolist() == whole[first:last].tolist()


def test_edges(spark, odd_docs, no_docs):
    path = work_path(spark, "files")
    odd = odd_docs.withColumnsRenamed({"lang": "part", "source": "body"})
    token_file.write(odd, path, PATH, end=2)
    rows = token_file.read(spark, path).collect()
    assert len(rows) == odd.count()
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert all(r.start < min(x.start for x in rows if x.doc_id is not None) for r in rows if r.doc_id is None)
    assert len({(r.n_tokens, r.ids_crc32) for r in rows if r.doc_id == 10}) == 1
    by_start = sorted(rows, key=lambda r: r.start)
    assert [a.start + a.n_tokens for a in by_start[:-1]] == [b.start for b in by_start[1:]]
    empty = work_path(spark, "files")
    token_file.write(no_docs, empty, PATH, end=2)
    assert token_file.read(spark, empty).count() == 0
