"""Token counts under a unigram model, by dynamic programming shared along a trie.

Distinct words are inserted in a trie. Each node stands for a prefix and keeps the best score of all ways to
cut that prefix into vocabulary pieces, and the number of pieces in it; both come from the nodes above,
so they are computed once for all words that share the prefix. The node where a word ends has its count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.batches import Remembered, map_batches, text_slices, texts_of

#: The mark of a word's start in the vocabulary. A fixed value.
WORD_START = "▁"
_SPACE = re.compile(r"[ \t-\r]+")
_RARE_SPACE = re.compile(r"[\t\x0b-\r]")
#: Nodes that a trie may grow to before a task starts afresh.
MOST_NODES = 1_000_000
#: Characters of a word that is put into the trie at most.
LONGEST_IN_TRIE = 1_024


@lru_cache(maxsize=2)
def piece_scores(path: str) -> dict[str, float]:
    """Log scores of the pieces in a sentencepiece file; characters it lacks are spelt in bytes.

    A unigram file states log probabilities. A file of merges states their negated ranks; there Zipf's law
    turns a rank into a probability, which is what such scores can be worth in a unigram model.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))
    ]
    scores = np.array([model.get_score(i) for i in plain], float)
    if len(scores) and (scores == np.round(scores)).all():
        weights = 1 / (np.argsort(np.argsort(-scores, kind="stable"), kind="stable") + 2.7)
        scores = np.log(weights / weights.sum())
    return dict(zip(map(model.id_to_piece, plain), scores.tolist(), strict=True))


class CountingTrie:
    """Trie of words; nodes hold the best score and the number of pieces of their prefix."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte_score = min(scores.values(), default=0.0) - 10.0
        self.children: dict[tuple[int, str], int] = {}
        self.best = [0.0]
        self.pieces = [0]

    def count(self, word: str) -> int:
        """Pieces in the best cut of ``word``; among equally good cuts, the fewest."""
        node, path = 0, [0]
        for end, char in enumerate(word, 1):
            below = self.children.get((node, char))
            if below is None:
                below = self.children[node, char] = len(self.best)
                self._add(word, end, path)
            node = below
            path.append(node)
        return self.pieces[node]

    def _add(self, word: str, end: int, path: list[int]) -> None:
        """Append the node of ``word[:end]``; ``path`` has the nodes of all shorter prefixes."""
        top, fewest = self._step(word, end, lambda start: (self.best[path[start]], self.pieces[path[start]]))
        self.best.append(top)
        self.pieces.append(fewest)

    def _step(self, word: str, end: int, state) -> tuple[float, int]:
        """Best score and fewest pieces of ``word[:end]``; ``state`` gives those of shorter prefixes."""
        spelt = len(word[end - 1].encode("utf-8", "surrogatepass"))
        top, fewest = state(end - 1)
        top, fewest = top + spelt * self.byte_score, fewest + spelt
        for start in range(max(0, end - self.longest), end):
            score = self.scores.get(word[start:end])
            if score is not None:
                whole, number = state(start)
                if (whole + score, -number - 1) > (top, -fewest):
                    top, fewest = whole + score, number + 1
        return top, fewest

    def count_alone(self, word: str) -> int:
        """``count`` without a node: only the last prefixes are kept, as many as the longest piece has characters."""
        size = self.longest + 1
        last = [(0.0, 0)] * size
        for end in range(1, len(word) + 1):
            last[end % size] = self._step(word, end, lambda start: last[start % size])
        return last[len(word) % size][1]


class _Counts(Remembered):
    """Pieces of each word met so far. A very long word gets no nodes, and a full trie makes way for a new one."""

    def __init__(self, path: str):
        super().__init__(self._count, MOST_NODES, LONGEST_IN_TRIE)
        self.trie = CountingTrie(piece_scores(path))

    def _count(self, word: str) -> int:
        if len(word) > LONGEST_IN_TRIE:
            return self.trie.count_alone(WORD_START + word)
        if len(self.trie.best) > MOST_NODES:
            self.clear()
            self.trie = CountingTrie(self.trie.scores)
        return self.trie.count(WORD_START + word)


@lru_cache(maxsize=2)
def _counts(path: str) -> _Counts:
    """The counts of this Python worker, kept from task to task."""
    return _Counts(path)


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens.

    Words are the runs outside ASCII white space, each with a word-start mark ahead; ``n_tokens`` adds up
    the pieces of their best cuts. NULL, empty and blank texts have none. Rows are counted one by one:
    NULL or repeated doc_ids stay as they are, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary_path)
        for batch in text_slices(batches):
            words, tokens = [], []
            for text in texts_of(batch):
                found = _SPACE.split(text) if _RARE_SPACE.search(text) else text.replace("\n", " ").split(" ")
                found = [word for word in found if word]
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, "int64"), pa.array(tokens, "int64")],
                ["doc_id", "n_words", "n_tokens"],
            )

    schema = "doc_id long, n_words long, n_tokens long"
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)
