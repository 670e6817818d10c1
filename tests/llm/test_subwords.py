"""Pieces of texts and back, against the public library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.llm import queries, subwords
from llm_data import ODD, rows


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_vocabulary())


@pytest.fixture(scope="module")
def vocabulary():
    with open(queries.piece_vocabulary(), "rb") as f:
        return subwords.Vocabulary(f.read())


def encoded(vocabulary, texts):
    raw = [t.encode() for t in texts]
    ids, bounds = vocabulary.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def thue_morse(n):
    """A word and its complement that polynomial hashes modulo 2^64 cannot tell apart."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_ids_and_texts_are_the_library_s(vocabulary, library):
    random.seed(5)
    pieces = [library.id_to_piece(k).replace("▁", " ") for k in range(259, library.vocab_size())]
    texts = [t or "" for t in ODD] + [" " * n + "x" for n in range(70)] + [c * n for c in "ax=-0\n▁漢" for n in (1, 2, 3, 7, 33)] + [*thue_morse(2048)]
    texts += ["".join(random.choices(pieces, k=random.randint(0, 12))) for _ in range(2000)]
    texts += ["".join(random.choices(pieces[:300], k=random.randint(0, 80))) for _ in range(2000)]
    texts += ["".join(random.choices(["a", " ", "  ", "\n", "é", "漢", "😀", "\x00", "▁"], k=40)) for _ in range(500)]
    found = encoded(vocabulary, texts)
    assert found == library.encode(texts)
    flat = np.array([i for x in found for i in x], np.int32)
    assert vocabulary.decode(flat, np.cumsum([0, *map(len, found)])) == [library.decode(x) for x in found]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_texts(vocabulary, library, texts):
    assert encoded(vocabulary, texts) == library.encode(texts)


def test_any_ids_decode_like_the_library(vocabulary, library):
    random.seed(6)
    pick = lambda: random.choice([0, 1, 2, 259, 28705, random.randint(3, 258), random.randint(3, 258), random.randint(259, 31999)])
    lists = [[pick() for _ in range(random.randint(0, 10))] for _ in range(5000)]
    flat = np.array([i for x in lists for i in x], np.int32)
    assert vocabulary.decode(flat, np.cumsum([0, *map(len, lists)])) == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([library.vocab_size()]), np.array([0, 1]))


def test_equal_hashes_do_not_merge_words(monkeypatch):
    monkeypatch.setattr(subwords, "mix64", lambda x: x * np.uint64(0))
    codes = np.frombuffer("abcabdabcx".encode("utf-32-le"), np.uint32)
    starts = np.array([0, 3, 6, 9])
    sample, inverse = subwords.distinct(codes, starts)
    texts = ["abc", "abd", "abc", "x"]
    assert [texts[sample[k]] for k in inverse] == texts


def test_query_on_the_whole_table(spark, small, library):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = rows(entry.queries()["op12_merge_round_pieces"](spark, small))
    expected = []
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        expected.append((r["doc_id"], len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert found == sorted(expected, key=repr)


def test_odd_rows_repeated_rows_and_clashing_columns(spark, make, library):
    table = [(k, t, "en", "s") for k, t in enumerate(ODD)] + [(None, "no id", None, None)] * 2
    docs = make(table).withColumn("ids", F.lit("clash")).withColumn("word", F.lit(1))
    path = queries.piece_vocabulary()
    found = rows(subwords.decode(subwords.encode(docs, path), path))
    expected = [(k, library.encode(t or "")) for k, t, *_ in table]
    assert found == sorted(((k, ids, library.decode(ids)) for k, ids in expected), key=repr)
    assert subwords.decode(subwords.encode(make([]), path), path).collect() == []
    blank = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert rows(subwords.decode(blank, path)) == [(1, [], ""), (2, [], "")]
