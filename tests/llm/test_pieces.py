import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from lakemart.llm import pieces
from lakemart.llm.queries import PIECES, op4_pieces

SF = "/root/testdata/sf0.001"
TEXTS = {
    1: None, 2: "", 3: " ", 4: "   three  spaces\n\nlines\t", 5: "ñandú 漢字 🦙 \x00 x", 6: "a" * 700, 7: "word " * 300,
    8: "nospace" * 90, 9: " lead", 10: "The end.",
}


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces in the library's unigram mode."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def brute_score(own, text):
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - own.longest), end):
            found = own.piece.get(text[start:end])
            gain = found[0] if found else own.unknown if end == start + 1 else None
            if gain is not None:
                best[end] = max(best[end], best[start] + gain)
    return best[-1]


def frame(spark, texts):
    return spark.createDataFrame([(k, v, 1.0) for k, v in texts.items()], "doc_id long, text string, score double")


@pytest.mark.parametrize("chunk", [5, 16, 40, 16_384])
def test_chunks_agree_with_brute_force(spark, chunk):
    own = pieces.lattice(PIECES)
    rows = pieces.encode(frame(spark, TEXTS), PIECES, chunk=chunk, block=3).collect()
    assert sorted(r.doc_id for r in rows) == sorted(TEXTS)
    whole = {k: own.whole(pieces.normalized(t)) for k, t in TEXTS.items()}
    for r in rows:
        assert r.score == pytest.approx(brute_score(own, pieces.normalized(TEXTS[r.doc_id])), rel=1e-12)
        assert r.score == pytest.approx(whole[r.doc_id][1], rel=1e-12)
    texts = {r.doc_id: r.text for r in pieces.decode(spark.createDataFrame(rows, pieces.ENCODED), PIECES).collect()}
    assert texts == {k: t or "" for k, t in TEXTS.items()}


def test_no_worse_than_library(unigram):
    """The library keeps a path of its own in rare cases; it never scores higher."""
    own, same = pieces.lattice(PIECES), 0
    texts = ("The end.", "Hello world of pieces", "El niño come", "antion thereof")
    for text in texts:
        ids, score = own.whole(pieces.normalized(text))
        theirs = unigram.encode(text)
        assert score >= sum(unigram.get_score(i) for i in theirs)
        same += np.frombuffer(ids, "<i4").tolist() == theirs
    assert same >= 3


def test_vocabulary_with_pieces_over_word_starts(spark):
    own = pieces.Lattice(PIECES)
    own.parted = False
    text = pieces.normalized("one two three four five six")
    cut = 9
    first, second = own.transfer(text[: cut + 15], cut), own.transfer(text[cut:], len(text) - cut)
    assert pieces.times(first, second)[0, 0] == pytest.approx(brute_score(own, text))


def test_query_restores_every_text(spark):
    rows = {r.doc_id: r for r in op4_pieces(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        text = (d.text or "").replace(pieces.MARK, " ")
        assert (rows[d.doc_id].n_chars, rows[d.doc_id].text_crc32) == (len(text), zlib.crc32(text.encode()))


def test_empty_null_and_repeated(spark):
    docs = spark.createDataFrame([(None, "x y"), (4, "same"), (4, "same")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in pieces.encode(docs, PIECES).collect()) == ["4", "4", "None"]
    assert pieces.encode(docs.limit(0), PIECES).count() == 0


def test_texts_are_encoded_some_at_a_time():
    texts = [f"word{i} a line, and more" for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts)], ["doc_id", "text"])
    got = list(pieces.Scan(PIECES).short(iter([batch])))
    assert max(map(len, got)) <= 256
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(1000))
    own = pieces.lattice(PIECES)
    assert [ids for b in got for ids in b.column(1).to_pylist()] == [
        np.frombuffer(own.whole(pieces.normalized(t))[0], "<i4").tolist() for t in texts]


def test_decoding_needs_no_lattice():
    own, by_id = pieces.lattice(PIECES), pieces.spelled(PIECES)
    assert all(by_id[i] == p.replace(pieces.MARK, " ").encode() for p, (_, i) in own.piece.items())
    assert all(by_id[i] == bytes([b]) for b, i in own.byte_ids.items())
    assert sum(map(bool, by_id)) == len(own.piece) + len(own.byte_ids)
