"""Runs without white space of up to a million letters, and what tasks remember."""

import random

import pytest

from fleetgauge.llm.batches import Remembered
from fleetgauge.llm.token_counts import LONGEST_IN_TRIE, WORD_START, CountingTrie, _Counts, count_tokens, piece_scores


def test_what_is_remembered_is_bounded():
    asked = []
    known = Remembered(lambda key: asked.append(key) or len(key), most=3, longest=5)
    assert [known[key] for key in ("a", "bb", "a", "ccc", "123456", "123456")] == [1, 2, 1, 3, 6, 6]
    assert asked == ["a", "bb", "ccc", "123456", "123456"] and len(known) == 3
    assert known["dddd"] == 4 and dict(known) == {"dddd": 4}


def test_counts_without_nodes_are_those_of_the_trie(vocabulary):
    random.seed(3)
    trie = CountingTrie(piece_scores(vocabulary("piece_bpe_32k.model")))
    for _ in range(200):
        word = WORD_START + "".join(random.choices("abcdeßé\U0001f600tion", k=random.randint(1, 60)))
        alone = trie.count_alone(word)
        assert alone == trie.count(word)


def test_long_words_get_no_nodes(vocabulary):
    counts = _Counts(vocabulary("piece_bpe_32k.model"))
    n = counts["x" * (LONGEST_IN_TRIE + 1)]
    assert n > 0 and len(counts.trie.best) == 1 and not counts
    assert counts["hello"] and "hello" in counts


@pytest.mark.parametrize("word", ["abcdefghij" * 100_000])
def test_a_million_letters_are_counted(docs, vocabulary, word):
    found = {r.doc_id: r for r in count_tokens(docs(word, word[:1_000] + " b"), vocabulary("piece_bpe_32k.model")).collect()}
    assert found[0].n_words == 1 and 100_000 <= found[0].n_tokens <= 1_000_000 and found[1].n_words == 2
