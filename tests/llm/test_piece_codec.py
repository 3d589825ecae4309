from __future__ import annotations

import random

import public_tokenizers
import sentencepiece

from telemill.llm.piece_codec import PieceCodec, decode_ids, encode_texts, ids_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "   a", "a  ", " a", "▁x", "a ▁b", "▁", "▁▁", "\x00a", "<s> x", "a\nb\n\n c", "  \n  ", "日本 語",
    "é́ｆ 😀 x", "a" * 3000 + " b", " " * 40 + "x", "<0x41>", "x y", "▁ ▁a  b ▁", "it's 3.14, isn't it?\tyes",
]


def test_equals_the_library(spark, frame):
    r = random.Random(1)
    texts = ODD + ["".join(r.choice("ab  ▁\nthé1,日😀") for _ in range(r.randint(0, 20))) for _ in range(2000)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoded = encode_texts(frame(list(enumerate(texts))), MODEL).withColumn("ids", ids_of("ids"))
    rows = decode_ids(encoded, MODEL, decoded="again").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id])
        assert row.ids == ids and row.decoded == row.again == library.decode(ids)
    assert rows[0].asDict().keys() == {"doc_id", "lang", "source", "n_chars", "ids", "decoded", "again"}


def test_characters_of_every_kind_equal_the_library():
    """A difference to the library is an error, so encoding is the test; numbers that are no digits count as such."""
    r = random.Random(5)
    ranges = [range(0x250), range(0x300, 0x370), range(0x1E00, 0x2100), range(0x2150, 0x2190), range(0x2460, 0x2500), range(0x2580, 0x25C0), range(0x3000, 0x3100)]
    pool = [chr(x) for part in ranges for x in part] + list("².½:①一😀‍ﬁａ\ue000\ufeff") * 20
    texts = ["²", "x².", "½-", "a½b", "①.", "Ⅷ."] + ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(20_000)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids, decoded = PieceCodec(MODEL).encode_batch(texts)
    want = library.encode(texts)
    assert ids == [",".join(map(str, x)) for x in want] and decoded == library.decode(want)


def test_nulls_repeats_and_empty_table(spark, frame):
    assert encode_texts(frame([]), MODEL).count() == 0
    rows = encode_texts(frame([(None, None), (1, "a b"), (1, "a b")]), MODEL).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in rows] == [(None, "", ""), (1, "264,287", "a b"), (1, "264,287", "a b")]


def test_decoded_text_comes_from_the_ids():
    worker, text = PieceCodec(MODEL), "one two one"
    plain = worker.encode_batch([text, "", *ODD])
    assert plain[1] == [worker.decode([int(i) for i in ids.split(",") if i]) for ids in plain[0]]
    worker = PieceCodec(MODEL)
    worker.pieces = [piece.replace("two", "2") for piece in worker.pieces]
    assert worker.encode_batch([text]) == ([plain[0][0]], ["one 2 one"])
