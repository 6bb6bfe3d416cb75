import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetgauge.llm.bpe_stream import BpeTransducer, decode_documents, encode_documents, round_trip, sufficient_lookahead, transducer

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
TEXTS = [
    "", " ", "\n\n a  b\n\n\nc ", "tab\there x", "a <|endoftext|> b<|startoftext|>c <|ENDOFTEXT|>", "it's  'S don't\n 's",
    "é ́a  12345 Σας İ. ǅ ß. ª º. ŉ", "$" * 3000, "a" * 5000, "thethethe" * 700, "ing" * 999 + "!",
]


@pytest.mark.parametrize("name", FILES)
def test_ids_and_texts_are_the_librarys(vocabulary, name):
    own, library = transducer(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    random.seed(5)
    mixed = ["".join(random.choices("ab'sZ 1\n\t .Σé́ß中\U0001f600", k=40)) for _ in range(300)]
    mixed += ["".join(random.choices("thein", k=4000))]
    for text in TEXTS + mixed:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_stable_tokens_are_those_of_the_whole(data):
    """For any merge list and any sequence, a window with the computed lookahead gives the whole's tokens."""
    alphabet = "abc"
    pieces, merges = list(alphabet), []
    for _ in range(data.draw(st.integers(0, 12))):
        pair = (data.draw(st.sampled_from(pieces)), data.draw(st.sampled_from(pieces)))
        if pair not in merges and "".join(pair) not in pieces:
            merges.append(pair)
            pieces.append("".join(pair))
    bpe = object.__new__(BpeTransducer)
    bpe.ranks = {pair: rank for rank, pair in enumerate(merges)}
    bpe.lookahead = sufficient_lookahead(merges)
    bpe.window = bpe.lookahead + max((len(a + b) for a, b in merges), default=1)
    text = data.draw(st.text(alphabet, max_size=120))
    assert list(bpe.transduce(text)) == bpe.merge(list(text))


def test_lookahead_follows_chains_of_earlier_merges():
    assert sufficient_lookahead([]) == 1
    assert sufficient_lookahead([("b", "c"), ("a", "b")]) == 2
    assert sufficient_lookahead([("a", "b"), ("b", "c")]) == 1


def test_streams_of_blocks(vocabulary):
    bpe = transducer(vocabulary(FILES[0]))
    text = "Some words, cut anywhere at all \n" * 20
    blocks = [text[at : at + 7] for at in range(0, len(text), 7)]
    assert list(bpe.encode_stream(blocks)) == bpe.encode(text)
    assert "".join(bpe.decode_stream(bpe.encode(text))) == bpe.decode(bpe.encode(text))


def test_round_trip_of_odd_rows(odd, vocabulary):
    found = round_trip(odd, vocabulary(FILES[0])).collect()
    library = Tokenizer.from_file(vocabulary(FILES[0]))
    assert len(found) == odd.count()
    texts = sorted((row.doc_id is None, row.doc_id or 0, row.text or "") for row in odd.collect())
    wanted = []
    for none, doc, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        shown = [" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        wanted.append((None if none else doc, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in shown)))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert round_trip(odd.limit(0), vocabulary(FILES[0])).isEmpty()


def test_encoded_documents_decode(docs, vocabulary):
    path = vocabulary(FILES[1])
    table = docs("Some text, with é.", "", None)
    encoded = encode_documents(table, path)
    assert {r.doc_id: r.text for r in decode_documents(encoded, path).collect()} == {0: "Some text, with é.", 1: "", 2: ""}
