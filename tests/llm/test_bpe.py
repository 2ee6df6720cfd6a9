"""Byte-level BPE against the tokenizer library's own encoding, and the round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from datamove.llm import bpe

SCHEMA = "doc_id long, text string, ids string"
ALPHABET = ["a", "The", " ", " ", "\n", "\t", "'s", "1", "é", "!", "  ", "中", "🙂", "\u2003", "\x1c", "<|endoftext|>", "\0"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def encoded(spark, texts, ranks):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)
    ids = bpe.encode_texts(frame, ["doc_id"], ranks=ranks, pattern=public_tokenizers.PATTERN)
    rows = bpe.decode_ids(ids, ["doc_id", "ids"], ranks=ranks).collect()
    return {r["doc_id"]: (np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in rows}


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_equals_the_library(spark, ranks, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block)
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " ", "  ", "a b  c   d ", "The end.\n\nThe end.", "word " * 3000, "The end.\n\nThe end."]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = encoded(spark, texts, ranks)
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i] == (library.encode_ordinary(text or ""), (text or "").encode()), repr(text)


def test_repeated_rows_and_empty_tables(spark, ranks):
    twice = spark.createDataFrame([(1, "a b", "x")] * 2, SCHEMA)
    assert bpe.encode_texts(twice, ["doc_id", "text"], ranks=ranks, pattern=public_tokenizers.PATTERN).count() == 2
    nothing = spark.createDataFrame([], SCHEMA)
    assert bpe.encode_texts(nothing, ["doc_id"], ranks=ranks, pattern=public_tokenizers.PATTERN).collect() == []


def test_vocabulary_is_bounded(tmp_path, monkeypatch):
    (tmp_path / "v").write_text("YQ== 0\n")
    assert bpe.read_ranks(str(tmp_path / "v")) == {b"a": 0}
    monkeypatch.setattr(bpe, "VOCABULARY_LIMIT", 10)
    with pytest.raises(ValueError, match="too large"):
        bpe.read_ranks(str(tmp_path / "v"))
