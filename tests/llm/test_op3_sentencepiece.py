import hashlib

import public_tokenizers
import sentencepiece

from editstream.llm.op3_sentencepiece import ChunkTable, encode_decode

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  \n c\t d ", "\u2581x \u2581\u2581y\u2581", "été Σίσυφος 東京 🙂🙂 \u200b",
         "x" * 5000, "word " * 3000, "\n\n  \n", "</s> <s> <unk> <0x0A>", "a\u00a0b\u3000c", "▁", "e\u0301 \x00 z"]


def test_same_as_library_and_round_trip():
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    table = ChunkTable(PATH, most=3)  # emptied again and again
    assert table.by_chunk
    for part in (TEXTS[:5], TEXTS[5:], TEXTS):
        got = table.encode(part)
        assert got == [lib.encode(t, add_eos=True) for t in part]
        assert table.decode(got) == [lib.decode(i) for i in got]


def test_whole_texts_where_pieces_may_cross():
    table = ChunkTable(PATH)
    table.by_chunk = False
    assert table.encode(TEXTS) == ChunkTable(PATH).encode(TEXTS)


def test_frame(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None])], "doc_id long, text string, ids string")
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = {r.doc_id: r for r in encode_decode(df, PATH).collect()}
    assert len(out) == len(TEXTS) + 1
    for i, t in enumerate([*TEXTS, ""]):
        ids = lib.encode(t, add_eos=True)
        assert out[i].ids == ids and out[i].decoded == lib.decode(ids)
    assert hashlib.sha256(out[3].decoded.encode()).hexdigest() == hashlib.sha256(b"a").hexdigest()
    assert encode_decode(df.limit(0), PATH).count() == 0
