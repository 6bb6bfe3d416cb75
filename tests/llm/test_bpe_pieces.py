import hashlib
import random

import pytest

from fleetgauge.llm import bpe_stream
from fleetgauge.llm.bpe_stream import LONGEST_REMEMBERED, BpeTransducer

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")


@pytest.mark.parametrize("name", NAMES)
def test_pieces_give_the_digests_of_the_whole(vocabulary, monkeypatch, name):
    monkeypatch.setattr(bpe_stream, "BLOCK", 50)
    bpe = BpeTransducer(vocabulary(name))
    random.seed(2)
    letters = ["a", "e", "t", "st", "ing", " ", " ", "\n", "é", "\U0001f600", "1", ".", "<|endoftext|>"]
    for length in (0, 1, 49, 50, 51, 200, 400):
        for text in ("".join(random.choices(letters, k=length)), "ab" * length, " " * length, "x" * length + " y"):
            ids = bpe.encode(text)
            sha = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), bpe.decode(ids))]
            assert bpe.digests(text) == (len(ids), *sha)


def test_no_piece_grows_with_the_text(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe_stream, "BLOCK", 50)
    bpe = BpeTransducer(vocabulary(NAMES[0]))
    for text in ("some words " * 400, "abcdefgh" * 500):
        sizes = [len(ids) for ids, _ in bpe.encode_pieces(text)]
        assert len(sizes) > 5 and max(sizes) <= 50


def test_long_chunks_are_not_remembered(vocabulary):
    bpe = BpeTransducer(vocabulary(NAMES[0]))
    bpe.encode("short " + "Qz" * LONGEST_REMEMBERED + ".")
    assert "short" in bpe.known and max(map(len, bpe.known)) <= LONGEST_REMEMBERED
