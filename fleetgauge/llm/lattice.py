"""Language-model scores from subword lattices.

The vocabulary is that of an existing tokenizer file. A word's probability is the sum over all ways to cut it
into pieces, found by a forward recursion in log space; characters that no piece has are spelt in
bytes. Piece probabilities start from the file's scores and are re-estimated on the distinct training words
by expected counts (forward and backward). A word met in training has one more arc, over its whole length,
by its share of the training tokens; the pieces get the share that Good and Turing leave for what was
never met, the number of words met once over all tokens. So the probabilities of all texts add up
to one. A document is its words, each with a word-start mark, and an end.

The corpus is read once and written in blocks, each with a vocabulary of its own and its documents as numbers
in it. Counts of all blocks' words meet in one shuffle by word, which grows with the corpus; a block then gets
back the counts and scores of its own words. No vocabulary of words passes the driver or a broadcast:
that is for the pieces alone, whose number the file fixes.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.batches import held_out, map_batches, ship_package, text_slices, texts_of
from fleetgauge.llm.token_counts import WORD_START, piece_scores
from fleetgauge.session import new_scratch_path

#: Words, and distinct ones among them, that a block takes about.
BLOCK_WORDS = 4_000_000
BLOCK_DISTINCT = 400_000
ROUNDS = 2
#: Words in a matrix of the recursion.
MATRIX_CELLS = 200_000

_K = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << 20
#: Words of more characters go through the recursions one by one, some 5 microseconds a character and pass.
LONG_WORD = 256
#: Places of such a word that are unpacked at once.
UNPACKED = 1 << 12
_LOG10 = float(np.log(10))


class Pieces:
    """Vocabulary pieces and their log probabilities, looked up by hashes of character spans."""

    def __init__(self, log_probability: dict[str, float]):
        pieces = list(log_probability)
        self.longest = max(map(len, pieces))
        self.count = len(pieces)
        # Then come the 256 bytes, the end, and an entry that matches nothing.
        rest = np.full(256 + 1, min(log_probability.values()) - 3.0)
        self.scores = np.r_[np.array([log_probability[p] for p in pieces]), rest, -np.inf]
        self.end = self.count + 256
        hashes = np.array([self._hash(piece) for piece in pieces], np.uint64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces have the same hash")
        # One piece a slot; the few that find theirs taken are searched for in a short sorted list.
        slots = (hashes >> np.uint64(44)).astype(np.int64)
        self.slot = np.full(_SLOTS, self.end + 1, np.int32)
        self.slot[slots[::-1]] = np.arange(self.count, dtype=np.int32)[::-1]
        self.hashes = np.r_[hashes, np.zeros(258, np.uint64)]
        late = np.flatnonzero(self.slot[slots] != np.arange(self.count))
        order = late[np.argsort(hashes[late])]
        self.late, self.late_hashes = np.r_[order, self.end + 1].astype(np.int32), np.r_[hashes[order], _K]
        self.normalise()

    def normalise(self) -> None:
        self.scores[:-1] -= np.logaddexp.reduce(self.scores[:-1])

    def rescored(self, scores: np.ndarray) -> Pieces:
        """The same pieces with other scores, without the last entry."""
        other = copy.copy(self)
        other.scores = np.r_[scores, -np.inf]
        other.normalise()
        return other

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for char in piece:
            value = ((value ^ (value >> 29)) * int(_K) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return value * int(_K) & 0xFFFFFFFFFFFFFFFF

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers of span hashes; the number behind the end for spans that are no piece."""
        found = self.slot[(hashes >> np.uint64(44)).astype(np.int64)]
        missed = self.hashes[found] != hashes
        at = np.minimum(np.searchsorted(self.late_hashes[:-1], hashes[missed]), len(self.late_hashes) - 1)
        found[missed] = np.where(self.late_hashes[at] == hashes[missed], self.late[at], self.end + 1)
        return found


def _matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, characters) of words of equal length, in matrices of bounded size."""
    lengths = np.array([len(word) for word in words])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        length = lengths[order[at]]
        stop = int(np.searchsorted(lengths[order], length, side="right"))
        stop = min(stop, at + max(1, MATRIX_CELLS // int(length)))
        text = "".join(words[place] for place in order[at:stop])
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(stop - at, length)
        yield order[at:stop], chars
        at = stop


def _apart(places: np.ndarray, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Long words one by one, others as they come."""
    if chars.shape[1] <= LONG_WORD:
        yield places, chars
        return
    for at in range(len(places)):
        yield places[at : at + 1], chars[at : at + 1]


def _arcs(chars: np.ndarray, pieces: Pieces) -> tuple[list[np.ndarray], np.ndarray]:
    """Piece numbers of all spans, by length less one, and for each character the score of its bytes."""
    found = []
    value = np.zeros_like(chars, np.uint64)
    for length in range(1, min(pieces.longest, chars.shape[1]) + 1):
        value = value[:, : chars.shape[1] - length + 1]
        value = (value ^ (value >> np.uint64(29))) * _K + chars[:, length - 1 :].astype(np.uint64) + np.uint64(1)
        found.append(pieces.find(value * _K))
    spelt = np.full(chars.shape, -np.inf)
    for code in np.unique(chars[found[0] > pieces.end]):
        data = chr(code).encode("utf-8", "surrogatepass")
        spelt[chars == code] = pieces.scores[[pieces.count + byte for byte in data]].sum()
    return found, spelt


def _forward(found: list[np.ndarray], spelt: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log of the summed probability of all cuts of each prefix."""
    n, length = spelt.shape
    alpha = np.full((n, length + 1), -np.inf)
    alpha[:, 0] = 0
    for end in range(1, length + 1):
        ways = [alpha[:, end - size - 1] + pieces.scores[found[size][:, end - size - 1]] for size in range(min(len(found), end))]
        ways = np.stack([*ways, alpha[:, end - 1] + spelt[:, end - 1]])
        most = ways.max(axis=0)
        alpha[:, end] = most + np.log(np.exp(ways - most).sum(axis=0))
    return alpha


def _ways(found: list[np.ndarray], spelt: np.ndarray, pieces: Pieces) -> Iterator[list[tuple[int, int, float]]]:
    """For each place of a single word, from the first on: (size, piece, score) of the arcs that start there.

    A byte spelling comes last, with no piece. Arrays are unpacked a stretch at a time.
    """
    length = spelt.shape[1]
    for first in range(0, length, UNPACKED):
        last = min(first + UNPACKED, length)
        arcs = [row[0, first:last].tolist() for row in found]
        scores = [pieces.scores[row[0, first:last]].tolist() for row in found]
        bytes_of = spelt[0, first:last].tolist()
        for at in range(last - first):
            here = [
                (size, own[at], score[at])
                for size, (own, score) in enumerate(zip(arcs, scores, strict=True), 1)
                if at < len(own) and score[at] > -math.inf
            ]
            if bytes_of[at] > -math.inf:
                here.append((1, -1, bytes_of[at]))
            yield here


def _log_sum(values: list[float]) -> float:
    most = max(values, default=-math.inf)
    return most + math.log(sum(math.exp(value - most) for value in values)) if most > -math.inf else most


def _forward_alone(found: list[np.ndarray], spelt: np.ndarray, pieces: Pieces) -> np.ndarray:
    """``_forward`` of a single word by a plain loop: its arrays are too narrow for it to pay there."""
    length = spelt.shape[1]
    alpha = np.full((1, length + 1), -np.inf)
    alpha[0, 0] = 0
    # Ways into the next places, as far as the longest piece reaches.
    ahead: list[list[float]] = [[] for _ in range(len(found) + 1)]
    now = 0.0
    for at, arcs in enumerate(_ways(found, spelt, pieces)):
        for size, _, score in arcs:
            ahead[(at + size) % len(ahead)].append(now + score)
        into = ahead[(at + 1) % len(ahead)]
        now = alpha[0, at + 1] = _log_sum(into)
        into.clear()
    return alpha


def _expected_alone(
    found: list[np.ndarray], spelt: np.ndarray, chars: np.ndarray, pieces: Pieces, times: float, sums: np.ndarray
) -> None:
    """Add what ``expected_counts`` finds for a single word, by plain loops."""
    length = spelt.shape[1]
    alpha = _forward_alone(found, spelt, pieces)[0]
    # Read from its end, an arc of some size starts where it ended: the same recursion gives the way back.
    beta = _forward_alone([row[:, ::-1] for row in found], spelt[:, ::-1], pieces)[0, ::-1]
    whole = float(alpha[length])
    for at, arcs in enumerate(_ways(found, spelt, pieces)):
        before = float(alpha[at]) - whole
        for size, piece, score in arcs:
            share = math.exp(before + score + float(beta[at + size])) * times
            if piece >= 0:
                sums[piece] += share
            else:
                for byte in chr(chars[0, at]).encode("utf-8", "surrogatepass"):
                    sums[pieces.count + byte] += share


def log_probabilities(words: list[str], pieces: Pieces) -> np.ndarray:
    """Natural log of the marginal probability of each word, over all its cuts; words are not empty."""
    result = np.zeros(len(words))
    for places, chars in _matrices(words):
        for own, part in _apart(places, chars):
            found, spelt = _arcs(part, pieces)
            forward = _forward_alone if part.shape[1] > LONG_WORD else _forward
            result[own] = forward(found, spelt, pieces)[:, -1]
    return result


def expected_counts(words: list[str], counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    """How often each piece and byte is expected in ``counts`` times each word."""
    sums = np.zeros(pieces.end + 2)
    for places, chars in _matrices(words):
        if chars.shape[1] > LONG_WORD:
            for own, part in _apart(places, chars):
                _expected_alone(*_arcs(part, pieces), part, pieces, float(counts[own][0]), sums)
            continue
        found, spelt = _arcs(chars, pieces)
        alpha = _forward(found, spelt, pieces)
        n, length = spelt.shape
        beta = np.full((n, length + 1), -np.inf)
        beta[:, length] = 0
        times = counts[places]
        for start in range(length - 1, -1, -1):
            sizes = range(min(len(found), length - start))
            arcs = [found[size][:, start] for size in sizes]
            ways = [pieces.scores[arc] + beta[:, start + size + 1] for size, arc in zip(sizes, arcs, strict=True)]
            ways = np.stack([*ways, spelt[:, start] + beta[:, start + 1]])
            most = ways.max(axis=0)
            beta[:, start] = most + np.log(np.exp(ways - most).sum(axis=0))
            shares = np.exp(ways + (alpha[:, start] - alpha[:, length])) * times
            sums += np.bincount(np.concatenate(arcs), shares[:-1].ravel(), len(sums))
            for row in np.flatnonzero(shares[-1]):
                for byte in chr(chars[row, start]).encode("utf-8", "surrogatepass"):
                    sums[pieces.count + byte] += shares[-1, row]
    sums[-1] = 0
    return sums


# --- the corpus in blocks -------------------------------------------------------------------

_BLOCKS = "block long, doc_id long, held_out boolean, ids binary, place int, word string, trained long"
_BLOCKS_ARROW = pa.schema(
    [("block", "int64"), ("doc_id", "int64"), ("held_out", "bool"), ("ids", "binary"), ("place", "int32"),
     ("word", "string"), ("trained", "int64")]
)


def _in_blocks(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: documents as numbers of words, and each block's words with their training counts."""

    def flush(block: int, rows: list[tuple], places: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(places), np.int64)
        for _, is_held_out, ids in rows:
            if not is_held_out:
                counts += np.bincount(ids, minlength=len(places))
        docs, held, ids = zip(*rows, strict=True)
        n, m = len(rows), len(places)
        empty = lambda length, kind: pa.nulls(length).cast(kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * n, "int64"), pa.array(docs, "int64"), pa.array(held, "bool"),
             pa.array([i.astype(np.uint32).tobytes() for i in ids], "binary"), empty(n, "int32"), empty(n, "string"),
             empty(n, "int64")], schema=_BLOCKS_ARROW,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * m, "int64"), empty(m, "int64"), empty(m, "bool"), empty(m, "binary"),
             pa.array(range(m), "int32"), pa.array([word.decode() for word in places], "string"),
             pa.array(counts, "int64")], schema=_BLOCKS_ARROW,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        rows, places, words = [], {}, 0
        for batch in text_slices(batches):
            for doc, is_held_out, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts_of(batch), strict=True
            ):
                found = text.encode().lower().split()
                ids = [places.setdefault(word, len(places)) for word in found]
                rows.append((doc, is_held_out, np.array(ids, np.int64)))
                words += len(ids)
            if words >= BLOCK_WORDS or len(places) >= BLOCK_DISTINCT:
                yield from flush(block, rows, places)
                rows, places, words, block = [], {}, 0, block + 1
        if rows:
            yield from flush(block, rows, places)

    return map_batches(docs, run, _BLOCKS)


def _trained_pieces(words: DataFrame, pieces: Pieces, rounds: int) -> Pieces:
    """Piece probabilities after ``rounds`` of expectation and maximisation over distinct words, each once."""
    spark = words.sparkSession
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(pieces)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(sent.value.end + 2)
            for batch in batches:
                found = [WORD_START + word for word in batch.column("word").to_pylist()]
                sums += expected_counts(found, np.ones(len(found)), sent.value)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, "int32"), pa.array(sums[at])], ["piece", "expected"])

        # Exact sums: the order in which tasks end must not show in the scores.
        expected = F.sum(F.col("expected").cast("decimal(38,9)")).cast("double").alias("expected")
        rows = map_batches(words, run, "piece int, expected double").groupBy("piece").agg(expected).collect()
        counts = np.full(len(pieces.scores) - 1, 0.01)
        for piece, expected in rows:
            counts[piece] += expected
        pieces = pieces.rescored(np.log(counts))
    return pieces


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_documents(docs: DataFrame, vocabulary_path: str, modulus: int = 7, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32 of the id modulo ``modulus`` is 2 are held out, all others are learnt from, those with a
    NULL id too. Tokens are the words, A to Z in lower case, and one end; ``base_score`` is by add-one
    smoothed counts of training tokens, ``score`` the lattice model's log10 probability. A NULL, empty or
    blank text is an end alone. Repeated rows count and are scored each; other columns are ignored. Where
    nothing is learnt from, counts are 0 and pieces keep the file's scores.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), modulus).alias("held_out"), "text")
    path = new_scratch_path(spark, "blocks")
    _in_blocks(docs).write.parquet(path)
    blocks = spark.read.parquet(path)
    texts = blocks.where("word is null").select("block", "doc_id", "held_out", "ids")
    of_word = Window.partitionBy("word")
    words = blocks.where("word is not null").select(
        "block",
        "place",
        "word",
        F.sum("trained").over(of_word).alias("count"),
        (F.row_number().over(of_word.orderBy("block")) == 1).alias("first"),
    )
    path = new_scratch_path(spark, "words")
    words.write.parquet(path)
    words = spark.read.parquet(path)
    distinct = words.where("first and count > 0").select("word", "count")
    once = F.count(F.when(F.col("count") == 1, 1))
    n, v, once = distinct.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*"), once).first()
    ends = texts.where("not held_out").count()
    n, v = n + ends, v + (ends > 0)
    pieces = Pieces(piece_scores(vocabulary_path))
    if v > 1:
        pieces = _trained_pieces(distinct.select("word"), pieces, rounds)
    sent = spark.sparkContext.broadcast(pieces)
    new_share = (once + 1) / (n + 2) if n else 1.0
    end_score = float(np.log10((1 - new_share) * ends / n)) if ends else float(pieces.scores[pieces.end]) / _LOG10

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").dictionary_encode()  # neighbours repeat a word of many blocks
            scores = log_probabilities([WORD_START + word for word in found.dictionary.to_pylist()], sent.value)
            cut = np.log(new_share) + scores[found.indices.to_numpy(zero_copy_only=False)]
            counts = batch.column("count").to_numpy(zero_copy_only=False)
            whole = np.log(np.where(counts > 0, (1 - new_share) * counts / max(n, 1), 1))
            by_row = np.where(counts > 0, np.logaddexp(whole, cut), cut) / _LOG10
            columns = [batch.column(name) for name in ("block", "place", "count")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(by_row)], ["block", "place", "count", "score"])

    def documents(texts: pa.Table, words: pa.Table) -> pa.Table:
        place = words.column("place").to_numpy()
        counts, scores = np.zeros(len(place)), np.zeros(len(place))
        counts[place] = words.column("count").to_numpy()
        scores[place] = words.column("score").to_numpy()
        base = np.log10((counts + 1) / (n + v + 1))
        known = counts > 0
        end = float(np.log10((ends + 1) / (n + v + 1)))
        ids = [np.frombuffer(data, np.uint32) for data in texts.column("ids").to_pylist()]
        return pa.table({
            "doc_id": texts.column("doc_id"),
            "held_out": texts.column("held_out"),
            "n_tokens": pa.array([len(i) + 1 for i in ids], "int64"),
            "n_known": pa.array([int(known[i].sum()) + (ends > 0) for i in ids], "int64"),
            "train_tokens": pa.array([n] * len(ids), "int64"),
            "base_score": pa.array([float(base[i].sum()) + end for i in ids]),
            "score": pa.array([float(scores[i].sum()) + end_score for i in ids]),
        })

    of_words = map_batches(words.select("block", "place", "word", "count"), scored, "block long, place int, count long, score double")
    ship_package(spark)
    return texts.groupBy("block").cogroup(of_words.groupBy("block")).applyInArrow(documents, _SCORES)
