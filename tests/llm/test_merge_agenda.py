"""The merges by themselves, checked against the library, which fails on any difference."""

from __future__ import annotations

import random

import public_tokenizers

from telemill.llm.piece_codec import MARK, PieceCodec


def test_no_segment_differs_and_both_agendas_agree():
    codec = PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    r = random.Random(12)
    letters = "etaoinshrdlucéñüß.,日本😀\x00梦"
    segments = ["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(3000)] + ["a" * 5000, MARK * 30 + "x"]
    assert len(codec.learn(segments)) == len(segments)
    for segment in segments[:500]:
        symbols = [codec.ids.get(c, codec.size) for c in MARK + segment]
        merged = codec._merge_long(list(symbols))
        again = [i for s in merged for i in ([s] if s != codec.size else [None])]
        assert [i for i in again if i is not None] == [i for i in codec.merge(MARK + segment) if i not in codec.byte_of]
