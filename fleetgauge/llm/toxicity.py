"""Toxicity: bags of subword embeddings, averaged into a linear softmax, trained jointly in numpy.

A word stands for its character 3- to 7-grams between word marks, hashed into a table of embeddings. A
document is the average of all its n-grams' embeddings. Words never seen share n-grams with
words that were, so misspellings and compounds are judged too. The model is trained on a bounded
sample; scoring needs only each word's summed contribution to the two logits' difference, which a
task remembers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.batches import held_out, map_batches, one_text_each, text_slices, texts_of

#: Labelled documents of each class that the model is trained on at most.
SAMPLE_PER_CLASS = {0: 1_200, 1: 800}
BUCKETS = 1 << 18
DIMENSIONS = 4
N_GRAMS = (3, 4, 5, 6, 7)
#: A bucket must occur in so many training documents to be learnt; others stay at zero.
LEAST_DOCUMENTS = 8
#: Added to a document's number of n-grams, so that a few words alone decide little.
FEW_GRAMS = 100
#: Words a task remembers the contributions of.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64

_WORD = re.compile(r"\w\S*\w|\w")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of its word) of every n-gram of every word, all words at once."""
    text = "".join(f"<{word}>" for word in words)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners = [], []
    value = chars * _MIX
    for n in range(2, max(N_GRAMS) + 1):
        value = value[:-1] if len(value) else value
        value = (value ^ (value >> np.uint64(29))) * _MIX + chars[n - 1 :]
        if n in N_GRAMS:
            whole = word[: len(value)] == word[n - 1 :]
            mixed = value[whole] * _MIX
            buckets.append((mixed >> np.uint64(32)).astype(np.int64) & (BUCKETS - 1))
            owners.append(word[: len(value)][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def words_of(text: str) -> list[str]:
    """Lower-case runs without white space, without the symbols at their ends."""
    return _WORD.findall(text.lower())


@dataclass
class SubwordModel:
    """Contribution of each bucket to the toxic logit over the other one, and the bias."""

    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.known = _Contributions(self)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of the toxic class; a text without words has that of the bias."""
        known = self.known
        found = [words_of(text) for text in texts]
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*found).difference(known))
        known.learn(new)
        sums = [sum(map(known.__getitem__, words), 0j) for words in found]
        for word in [word for word in new if len(word) > LONGEST_REMEMBERED]:
            del known[word]
        sums = np.array(sums, complex)
        logits = self.bias + sums.real / (sums.imag + FEW_GRAMS)
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()


class _Contributions(dict):
    """For each word the sum of its n-grams' weights (real part) and their number (imaginary part)."""

    def __init__(self, model: SubwordModel):
        self.model = model

    def learn(self, words: list[str]) -> None:
        for start in range(0, len(words), 20_000):
            part = words[start : start + 20_000]
            buckets, owners = subwords(part)
            sums = np.bincount(owners, self.model.weights[buckets], len(part))
            numbers = np.bincount(owners, minlength=len(part))
            self.update(zip(part, (sums + 1j * numbers).tolist(), strict=True))


def gram_counts(bags: list[Counter]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each bag of words, none of them empty, its distinct buckets and how many of its n-grams are in each."""
    vocabulary = sorted(set().union(*bags))
    number = {word: at for at, word in enumerate(vocabulary)}
    buckets, owners = subwords(vocabulary)
    buckets = buckets[np.argsort(owners, kind="stable")].astype(np.int32)
    ends = np.cumsum(np.bincount(owners, minlength=len(vocabulary)))
    spans = np.split(buckets, ends[:-1])
    counted = []
    for bag in bags:
        own = [spans[number[word]] for word in bag]
        weights = np.repeat(np.array([*bag.values()], np.float64), [len(span) for span in own])
        found, inverse = np.unique(np.concatenate(own), return_inverse=True)
        counted.append((found, np.bincount(inverse, weights)))
    return counted


def _shares(counts: np.ndarray) -> np.ndarray:
    return (counts / (counts.sum() + FEW_GRAMS)).astype(np.float32)


def gram_shares(bags: list[Counter]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each bag of words, none of them empty, its distinct buckets and their shares of all its n-grams."""
    return [(found, _shares(counts)) for found, counts in gram_counts(bags)]


_BLOCKS = np.arange(0, BUCKETS, 1 << 16)


def pack(found: np.ndarray, counts: np.ndarray) -> bytes:
    """Distinct ascending buckets and their counts, as a rule in four bytes for each."""
    width = np.uint16 if counts.max(initial=0) < 1 << 16 else np.uint64
    head = np.r_[np.dtype(width).itemsize, np.searchsorted(found, _BLOCKS)].astype(np.uint32)
    return head.tobytes() + (found & 0xFFFF).astype(np.uint16).tobytes() + counts.astype(width).tobytes()


class PackedShares(bytes):
    """What ``pack`` gives; as a pair it is the buckets and their shares."""

    def __iter__(self) -> Iterator[np.ndarray]:
        head = np.frombuffer(self, np.uint32, 1 + len(_BLOCKS))
        width = int(head[0])
        n = (len(self) - head.nbytes) // (2 + width)
        low = np.frombuffer(self, np.uint16, n, head.nbytes).astype(np.int32)
        # Counts need not lie at a multiple of their width.
        counts = np.frombuffer(self[head.nbytes + 2 * n :], f"u{width}")
        block = np.searchsorted(head[1:], np.arange(n), side="right") - 1
        return iter((low + (block << 16).astype(np.int32), _shares(counts.astype(np.float64))))


def train(
    shares: list[tuple[np.ndarray, np.ndarray]],
    targets: np.ndarray,
    epochs: int = 12,
    rate: float = 0.5,
    decay: float = 1e-4,
    batch: int = 64,  # 256 at most
    toxic_weight: float = 0.3,
    seed: int = 7,
) -> SubwordModel:
    """Train embeddings and softmax together on the n-gram shares of whole documents (see ``gram_shares``).

    An n-gram's share of a document is divided by the root of its mean share, so that chance puts the
    same noise on rare and on frequent n-grams. Together, toxic documents weigh ``toxic_weight``.
    """
    random = np.random.default_rng(seed)
    order = random.permutation(len(shares))
    shares, targets = [shares[at] for at in order], targets[order]
    n_docs = len(shares)
    often, total = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS)
    for found, share in shares:
        often[found] += 1
        total[found] += share
    learnt = often >= min(LEAST_DOCUMENTS, max(1, n_docs // 50))
    compact = (np.cumsum(learnt) - 1).astype(np.int32)
    width = int(learnt.sum())
    spread = np.sqrt(total[learnt] / n_docs + 1e-7).astype(np.float32)
    weight = np.where(targets == 1, toxic_weight / (targets == 1).sum(), (1 - toxic_weight) / (targets == 0).sum())
    weight = weight * n_docs
    wanted = np.stack([targets == 0, targets == 1], axis=1).astype(np.float32)
    batches = []
    for start in range(0, n_docs, batch):
        part = shares[start : start + batch]
        part = [(compact[found[learnt[found]]], share[learnt[found]]) for found, share in part]
        row = np.repeat(np.arange(len(part), dtype=np.uint8), [len(found) for found, _ in part])
        column = np.concatenate([found for found, _ in part])
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        cell = np.concatenate([share for _, share in part])[order] / spread[column]
        shares[start : start + batch] = [None] * len(part)
        batches.append((slice(start, start + len(part)), row, column, cell))
    embedding = np.zeros((width, DIMENSIONS), np.float32)
    softmax = random.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = epochs * len(batches), 0
    for _ in range(epochs):
        for docs, row, column, cell in batches:
            n = docs.stop - docs.start
            hidden = np.stack([np.bincount(row, cell * side[column], n) for side in embedding.T], axis=1).astype(np.float32)
            logits = hidden @ softmax + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = ((p - wanted[docs]) * weight[docs, None] / n).astype(np.float32)
            back = error @ softmax.T
            pace = np.float32(rate * (1 - step / steps))
            values = cell[:, None] * back[row]
            starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else column
            if len(starts):
                touched = column[starts]
                embedding[touched] *= 1 - pace * np.float32(decay)
                embedding[touched] -= pace * np.add.reduceat(values, starts, axis=0)
            softmax -= pace * (hidden.T @ error + np.float32(decay) * softmax)
            bias -= pace * error.sum(axis=0)
            step += 1
    weights = np.zeros(BUCKETS)
    weights[learnt] = (embedding @ (softmax[:, 1] - softmax[:, 0])) / spread
    return SubwordModel(weights, float(bias[1] - bias[0]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = SAMPLE_PER_CLASS) -> SubwordModel | None:
    """Train on ``labels`` (doc_id, toxic) whose crc32 of the id modulo 4 is not 2.

    At most ``per_class[toxic]`` documents of a class, picked by a hash of the id, are reduced to their
    n-gram shares, which the driver trains on; of rows that repeat an id one counts, that with the least text.
    None without examples of both classes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = zip(batch.column("toxic").to_pylist(), texts_of(batch), strict=True)
            bags = [(toxic, bag) for toxic, text in found if (bag := Counter(words_of(text)))]
            counted = gram_counts([bag for _, bag in bags]) if bags else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([toxic for toxic, _ in bags], "int32"), pa.array([pack(*pair) for pair in counted], "binary")],
                ["toxic", "counts"],
            )

    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), 4))
    chosen = chosen.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    classes = [
        chosen.where(F.col("toxic") == kind).orderBy(F.xxhash64("label_id"), "label_id").limit(per_class[kind])
        for kind in (0, 1)
    ]
    sample = classes[0].union(classes[1])
    rows = map_batches(one_text_each(docs, sample, "toxic"), run, "toxic int, counts binary").collect()
    rows = sorted((row.toxic, bytes(row.counts)) for row in rows)
    targets = np.array([toxic for toxic, _ in rows])
    if len(np.unique(targets)) < 2:
        return None
    shares = [PackedShares(counts) for _, counts in rows]
    del rows
    return train(shares, targets)


def _score(texts: list[str], model: SubwordModel | None) -> np.ndarray:
    return model.score(texts) if model else np.zeros(len(texts))


def score_toxicity(docs: DataFrame, model: SubwordModel | None, threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    A NULL, empty or blank text has the score of a document about which nothing is known. Without a
    model all scores are 0. A NULL doc_id is not held out; repeated rows are scored alike; other
    columns are ignored. Scores depend on texts alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            scores = _score(texts_of(batch), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 4).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: SubwordModel | None, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``.

    Rows are judged one by one by their text: repeated ones stay or go together, whatever their ids. NULL, empty and
    blank texts have the score of the bias alone; without a model, or rows, all stay. Columns may have any name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield batch.filter(pa.array(_score(texts_of(batch), sent.value) < threshold))

    return map_batches(docs, run, docs.schema)
