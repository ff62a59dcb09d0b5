"""Encoding equals the tokenizer library, whatever the text; decoding is its inverse."""

import base64
import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import TEXTS, awkward, empty

from revtide.llm import bpe
from revtide.llm.queries import op3_segment_tree_bpe


@pytest.fixture(scope="module")
def reference():
    with open(bpe.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(bpe.VOCABULARY, "rb") as file:
        return bpe.Encoder(file.read(), bpe.PATTERN)


@pytest.mark.parametrize("text", [t for t in TEXTS if t] + ["aaaaaaaaaaaa" * 99, "\x1c \x1c", "  a  b ", "a\n b", "<|endoftext|>"])
def test_equals_library(coder, decoder, reference, text):
    ids = coder.encode([text])[0].tolist()
    assert ids == reference.encode_ordinary(text)
    assert decoder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab' \n1é.", max_size=40))
def test_any_text(coder, decoder, reference, text):
    ids = coder.encode([text])[0].tolist()
    assert ids == reference.encode_ordinary(text)
    assert decoder.decode(ids) == text.encode()


@pytest.fixture(scope="module")
def decoder():
    with open(bpe.VOCABULARY, "rb") as file:
        return bpe.Decoder(file.read())


def test_leftmost_pair_first():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aab": 3}
    assert bpe.merged(b"aaa", ranks) == [2, 0]
    assert bpe.merged(b"aaab", ranks) == [2, 0, 1]
    assert bpe.merged(b"a", ranks) == [0]


def test_rows_equal_single_trees(coder):
    random = np.random.default_rng(1)
    pieces = [bytes(random.choice(list(b" abtheinon\xc3\xa9"), n).tolist()) for n in range(1, 17) for _ in range(30)]
    rows = bpe.merged_rows(pieces, 16, coder.pairs)
    assert [np.frombuffer(r, "<i4").tolist() for r in rows] == [bpe.merged(p, coder.ranks) for p in pieces]


def test_memory_is_bounded(coder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for i in range(20):
        text = f"word{i} other{i} a\nb{i} {'y' * 60}"
        assert coder.encode([text, text])[1].tolist() == reference.encode_ordinary(text)
    assert len(coder.known) < 30 and not any(len(w) > 48 for w in coder.known)


def test_query_equals_library(spark, sf_dir, reference):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_segment_tree_bpe(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = reference.encode_ordinary(docs[row["doc_id"]] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((docs[row["doc_id"]] or "").encode()).hexdigest()


def test_awkward_rows(spark):
    rows = awkward(spark)
    found = bpe.decoded(bpe.encoded(rows, keep=("doc_id", "text"))).withColumn("n", F.size("ids")).collect()
    assert len(found) == rows.count()
    assert all(bytes(r["raw"]) == (r["text"] or "").encode() for r in found)
    assert all(r["n"] == 0 for r in found if not r["text"])
    assert bpe.encoded(empty(spark)).count() == 0
