import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import TEXTS, documents, empty
from sentencepiece import sentencepiece_model_pb2 as proto

from provenlake.llm import op8_sentencepiece as op

PATH = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["  two  spaces   and    more ", " ", "   ", "tab\tand\nnewline\r\n", "<s> </s> <unk> <0x0A> ▁ ▁▁", "x" * 300, "aaaaabababab" * 9, "\x00\x01", "é"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_file_is_read_as_the_library_reads_it():
    want = proto.ModelProto()
    data = open(PATH, "rb").read()
    want.ParseFromString(data)
    spec = op.parsed(data)
    assert spec.pieces == [(p.piece, p.score, p.type) for p in want.pieces]
    n = want.normalizer_spec
    assert (spec.model_type, spec.byte_fallback, spec.charsmap) == (want.trainer_spec.model_type, True, n.precompiled_charsmap)
    assert (spec.dummy_prefix, spec.remove_spaces, spec.escape_spaces) == (n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces)


def test_ids_and_round_trip(spark, library):
    docs = documents(spark, [*TEXTS, *MORE])
    texts = [*TEXTS, *MORE]
    own = {r.doc_id: r for r in op.encoded(docs, PATH).collect() if r.doc_id is not None}
    back = {r.doc_id: r.text for r in op.decoded(op.encoded(docs, PATH), PATH).collect()}
    rows = op.measured(docs, PATH).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id] if r.doc_id is not None else "text of a row without an id"
        want = library.encode(text or "")
        assert (r.n_ids, r.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        if r.doc_id is not None:
            assert own[r.doc_id].ids == (None if text is None else want)
            # The library itself reads a marker in a text as a space.
            assert back[r.doc_id] == (None if text is None else text.replace("▁", " ")) and r.round_trip == (text is None or "▁" not in text)
    assert op.measured(empty(spark), PATH).count() == 0


def test_parity_of_a_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op.measured(docs, PATH).collect():
        want = library.encode(texts[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes()) and r.n_differing == 0 and r.round_trip


def test_small_memo(library, monkeypatch):
    monkeypatch.setattr(op, "CHUNKS", 50)
    texts = [t for t in TEXTS if t] * 3
    for t, (ids, _, _) in zip(texts, op.Encoder(open(PATH, "rb").read()).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t)


@pytest.mark.parametrize("remove", [False, True])
def test_a_unigram_model_made_by_hand(remove):
    m = proto.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *[(f"<0x{b:02X}>", 0, 6) for b in range(256)],
                               ("▁the", -2.0, 1), ("▁", -3.0, 1), ("▁t", -3.5, 1), ("he", -3.2, 1), ("cat", -4.0, 1), ("▁cat", -4.1, 1), ("s", -4.5, 1),
                               ("c", -7.0, 1), ("a", -7.1, 1), ("t", -7.2, 1), ("h", -7.3, 1), ("e", -7.4, 1)]:
        p = m.pieces.add()
        p.piece, p.score, p.type = piece, score, kind
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, True
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = "identity", True, remove
    data = m.SerializeToString()
    library, encoder = sentencepiece.SentencePieceProcessor(model_proto=data), op.Encoder(data)
    texts = ["the cats", "cat the  the cat", "thé catz 日本", "tttt heat", ""]
    for t, (ids, wrong, _) in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t) and wrong == 0, t
