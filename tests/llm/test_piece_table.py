import hashlib
import random

import pytest

from practica.llm import piece_table
from practica.llm.tokens import vocabulary_path

from .conftest import SCHEMA, rows, words


def whole(text):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(piece_table.MODEL))
    ids = model.encode(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(model.decode(ids).encode()).hexdigest())


ODD = ["", " ", "  ", "\n", "\n\n", " \n ", "a", " a", "a  b ", "a\nb", "a \n b", "\na", "a▁b", "▁", "é🙂\x00x",
       "<s> hi </s> <0x41> <unk>", "� x \t y\r\n", "ﬁ ①ⅳ", "日本語 テキスト", "x" * 3000, " " * 50, "a" + " " * 33 + "b",
       " a b", "don't stop—now", "́combining", "a​b"]


@pytest.mark.parametrize("head_bytes", [0, 300, 10_000_000])
def test_equals_the_library_on_whole_texts(spark, odd_docs, head_bytes):
    rng = random.Random(1)
    alphabet = "ab é\n\t▁🙂。x1-'"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["Thtion they tionoues ereh\n " + words(rng, 40, 90) for _ in range(40)] + texts[:20]
    docs = spark.createDataFrame(rows(texts, 1000), SCHEMA).unionByName(odd_docs)
    got = sorted(map(tuple, piece_table.digest_documents(docs, head_bytes=head_bytes).collect()), key=str)
    assert got == sorted([(r.doc_id, *whole(r.text)) for r in docs.collect()], key=str)


def test_each_distinct_chunk_is_segmented_once(spark):
    path = vocabulary_path(piece_table.MODEL)
    docs = spark.createDataFrame(rows(["a b a", "b  a\nb", None] * 30), SCHEMA)
    counts = {r["chunk"]: r["n"] for r in piece_table.count_chunks(docs, path).collect()}
    assert counts == {" a": 60, " b": 60, "  a": 30, "\nb": 30}
    counts = piece_table.count_chunks(docs, path)
    table = piece_table.segment_chunks(counts, path).collect()
    assert len(table) == 4 and all(r["decoded"] is None for r in table)
    assert piece_table.head_least(counts, 1000) <= 30 < piece_table.head_least(counts, 5) <= 60
    assert piece_table.head_least(counts, 0) > 60


def test_ids_and_texts(spark):
    docs = spark.createDataFrame(rows(["a b\n c", "", "x▁ y"]), SCHEMA)
    got = {r.doc_id: (r.ids, r.decoded) for r in piece_table.encode_documents(docs, head_bytes=4).collect()}
    assert [got[i][1] for i in range(3)] == ["a b\n c", "", "x  y"] and got[1][0] == [] and len(got[0][0]) == 4


def test_empty_table(spark, no_docs):
    assert piece_table.digest_documents(no_docs).count() == 0


def test_a_model_whose_pieces_cross_markers_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(vocabulary_path(piece_table.MODEL), "rb") as f:
        proto.ParseFromString(f.read())
    proto.pieces[500].piece = "a▁b"
    (tmp_path / "crossing.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="crosses"):
        piece_table.Chunks(str(tmp_path / "crossing.model"))
