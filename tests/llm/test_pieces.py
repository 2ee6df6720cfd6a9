"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from datamove.llm import pieces
from datamove.llm.arrow import text_slices
from datamove.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")

ODD = ["", " ", "   ", "▁", "▁▁ a", "a" * 700, " " * 300, "\x00", "\n\n x", "<s> </s> <0x41> <unk>", "日本語 ñ", "é 각", "ﬁ ① ㌀ …", "​", "😀👍🏽"]
LETTERS = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "日本", "é", "é", "😀", "\u0000", "0", "ＡＢ", "①", "㌀", "½", "　", "​", "क्षि", "ｶﾞ", "한", "¨"]


def _texts(n):
    rng = random.Random(5)
    return ODD + ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(50))) for _ in range(n)]


def _altered(**changes):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    for name, value in changes.items():
        part = proto.trainer_spec if name == "byte_fallback" else proto.normalizer_spec
        setattr(part, name, value)
    if not proto.trainer_spec.byte_fallback:
        for piece in proto.pieces:
            if piece.type == pieces.BYTE:
                piece.type = pieces.NORMAL
                piece.piece = "\U000F0000" + piece.piece
    return pieces._model(proto), sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def _compiled(rule):
    spec = sentencepiece_model_pb2.NormalizerSpec()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    return spec.precompiled_charsmap


def _compare(model, library, texts):
    surfaces = pieces._surfaces(model)
    column, at = pa.array([t.encode() for t in texts], pa.large_binary()), 0
    for _, _, data, offsets in text_slices(column, 5000):
        ids, of, starts, ends = pieces.encode_slice(model, data, offsets)
        decoded = pieces.decode_ids(model, ids, of, surfaces)
        for i, (x, y) in enumerate(zip(of[:-1], of[1:])):
            text = texts[at + i]
            assert ids[x:y].tolist() == library.encode(text, add_eos=True), text
            assert decoded[i].decode() == library.decode(ids[x:y].tolist()), text
            proto = library.encode(text, return_type="proto")
            assert list(zip(starts[x : y - 1].tolist(), ends[x : y - 1].tolist())) == [(p.begin, p.end) for p in proto.pieces], text
        at += len(offsets) - 1
    assert at == len(texts)


def test_ids_spans_and_texts_are_the_librarys():
    model = pieces.read_model(PATH)
    assert model.cuts_at_spaces
    _compare(model, sentencepiece.SentencePieceProcessor(model_file=PATH), _texts(1500))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_compiled_maps(rule, squeeze):
    model, library = _altered(precompiled_charsmap=_compiled(rule), remove_extra_whitespaces=squeeze)
    _compare(model, library, _texts(1500))


def test_no_mark_in_front_and_no_byte_pieces():
    _compare(*_altered(add_dummy_prefix=False), _texts(500))
    _compare(*_altered(byte_fallback=False), _texts(500))


def test_any_ids_decode_as_in_the_library():
    rng = random.Random(2)
    model, library = pieces.read_model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    surfaces = pieces._surfaces(model)
    for _ in range(1500):
        kinds = [0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(259, 32000), 28705, 259]
        ids = [rng.choice(kinds) for _ in range(rng.randrange(12))]
        got = pieces.decode_ids(model, np.array(ids, np.int32), np.array([0, len(ids)]), surfaces)
        assert got[0].decode() == library.decode(ids), ids
    with pytest.raises(ValueError):
        pieces.decode_ids(model, np.array([32000]), np.array([0, 1]), surfaces)


def test_long_parts_are_merged_like_short_ones(monkeypatch):
    model = pieces.read_model(PATH)
    texts = [t.encode() for t in _texts(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    want = pieces.encode_slice(model, data, offsets)
    monkeypatch.setattr(pieces, "SHORT", 0)
    for a, b in zip(want, pieces.encode_slice(model, data, offsets)):
        assert (a == b).all()


def test_models_of_another_kind_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="other than BPE"):
        pieces._model(proto)


def test_frames(spark):
    model = pieces.read_model(PATH)
    rows = [(1, None, "x"), (1, "", "x"), (2, "a b", "y"), (2, "a b", "y"), (None, "long " * 60_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string")
    coded = pieces.encode_pieces(docs, ["doc_id", "decoded", "text"], model=model)
    assert coded.columns == ["doc_id", "decoded", "text", "ids", "starts", "ends"]
    got = pieces.decode_pieces(coded, ["doc_id", "text", "ids"], model=model).collect()
    assert [r["decoded"] for r in got] == [t or "" for _, t, _ in rows]
    assert [len(r["ids"]) for r in got[:4]] == [1, 1, 3, 3]
    with pytest.raises(ValueError, match="decoded"):
        pieces.decode_pieces(coded, ["decoded"], model=model)
    with pytest.raises(ValueError, match="ids"):
        pieces.encode_pieces(coded, ["ids"], model=model)
    assert pieces.encode_pieces(docs.limit(0), ["doc_id"], model=model).count() == 0
    bare = spark.createDataFrame([(None,), ([2],)], "ids array<int>")
    assert [r["decoded"] for r in pieces.decode_pieces(bare, [], model=model).collect()] == ["", ""]


def test_query(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op13_sentencepiece"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r["n_spanned"] == len(docs[r["doc_id"]].encode())
