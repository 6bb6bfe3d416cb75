"""Languages by error-correcting output codes over character n-grams.

Every language gets a codeword of bits. One binary classifier a bit, linear in the shares of a document's
character n-grams, says on which side of the code's split the document's language is; all are fitted
together on a bounded sample. Decoding weighs each bit's loss by how well the bit did on each
language's own samples and takes the codeword of least loss, so one or two wrong bits do no harm. Where
the runner-up is close the document is flagged as ambiguous.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.batches import held_out, map_batches, text_slices, texts_of

#: Documents that the classifiers are fitted on at most, for each language and in all.
SAMPLE_PER_LANGUAGE = 300
SAMPLE = 1_500
#: Groups of each language that a sample is first taken of.
SALTS = 16
BUCKETS = 1 << 13
N_GRAMS = (1, 2, 3)
#: Up to so many languages have the exhaustive code; more get a random one with bits for each doubling.
EXHAUSTIVE = 6
BITS_PER_DOUBLING = 12
#: A document whose two best languages are nearer to each other than this is ambiguous.
AMBIGUOUS = 0.2
#: Words whose contributions a task remembers.
REMEMBERED = 300_000
#: Letters of a word at most; a longer run is cut into words.
LONGEST_WORD = 1 << 12
#: Words that are cut into n-grams at once.
AT_ONCE = 20_000

UNDETERMINED = "und"

_RUN = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters, very long ones cut up."""
    words = _RUN.findall(text.lower())
    if text.isascii():
        return words
    # Superscripts, fractions and letter-like numbers are word characters, yet no letters.
    return [part for word in words for part in ([word] if word.isalpha() else _letters(word))]


def _letters(word: str) -> list[str]:
    return "".join(c if c.isalpha() else " " for c in word).split()


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of its word) of every n-gram of every word between word marks."""
    text = "".join(f" {word} " for word in words)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners, value = [], [], np.zeros(len(chars) + 1, np.uint64)
    for n in range(1, max(N_GRAMS) + 1):
        value = value[:-1]
        value = (value ^ (value >> np.uint64(29))) * _MIX + chars[n - 1 :]
        if n in N_GRAMS:
            whole = word[: len(value)] == word[n - 1 :]
            mixed = (value[whole] + np.uint64(n)) * _MIX
            buckets.append((mixed >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1))
            owners.append(word[: len(value)][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def gram_shares(bag: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a bag of words, which is not empty, and their shares of all its n-grams."""
    sums, words = np.zeros(BUCKETS), list(bag)
    for start in range(0, len(words), AT_ONCE):
        part = words[start : start + AT_ONCE]
        buckets, owners = buckets_of(part)
        sums += np.bincount(buckets, np.array([bag[word] for word in part])[owners], BUCKETS)
    found = np.flatnonzero(sums)
    return found.astype(np.int32), (sums[found] / sums.sum()).astype(np.float32)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """One row of -1 and 1 for each of ``n`` languages; no column is constant for more than one language.

    Few languages have every split there is; for more, the random code whose rows are farthest apart is taken.
    """
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))
        return np.where(splits >> np.arange(n)[:, None] & 1, 1, -1).astype(np.int8)
    random = np.random.default_rng(seed)
    bits = math.ceil(BITS_PER_DOUBLING * math.log2(n))
    best, best_distance = None, -1
    for _ in range(50):
        code = random.choice(np.array([-1, 1], np.int8), (n, bits))
        code[0] = np.where(np.abs(code.sum(axis=0, dtype=int)) == n, -code[0], code[0])
        products = code.astype(np.float32) @ code.T.astype(np.float32)
        np.fill_diagonal(products, -bits)
        distance = bits - products.max()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@dataclass
class LanguageModel:
    """Languages, their codewords, bit weights by language, and the classifiers' n-gram weights and biases."""

    languages: list[str]
    code: np.ndarray
    trust: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def __post_init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.rows = np.zeros((1 << 10, self.code.shape[1] + 1), np.float32)

    def __getstate__(self) -> dict:
        return {name: self.__dict__[name] for name in ("languages", "code", "trust", "weights", "bias")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def _learn(self, words: list[str]) -> None:
        """Keep each word's sums of n-gram weights by bit, and its number of n-grams, as a row."""
        for start in range(0, len(words), AT_ONCE):
            part = words[start : start + AT_ONCE]
            buckets, owners = buckets_of(part)
            sums = [np.bincount(owners, weights[buckets], len(part)) for weights in self.weights.T]
            first = len(self.row)
            if first + len(part) > len(self.rows):
                self.rows = np.resize(self.rows, (2 * (first + len(part)), self.rows.shape[1]))
            self.rows[first : first + len(part)] = np.stack([*sums, np.bincount(owners, minlength=len(part))], axis=1)
            self.row.update(zip(part, range(first, first + len(part)), strict=True))

    def margins(self, bags: list[Counter]) -> np.ndarray:
        """Each bit's classifier on each bag of words."""
        if len(self.row) > REMEMBERED:
            self._forget()
        self._learn([word for word in set().union(*bags) if word not in self.row])
        out = np.zeros((len(bags), self.code.shape[1]))
        for at, bag in enumerate(bags):
            own = self.rows[np.fromiter(map(self.row.__getitem__, bag), np.int64, len(bag))]
            sums = np.fromiter(bag.values(), float, len(bag)) @ own
            out[at] = sums[:-1] / sums[-1] + self.bias
        return out

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Share of each language: the softmax of its codeword's weighted loss, taken negative."""
        margins = np.clip(margins, -6, 6)
        losses = np.stack([np.logaddexp(0, -margins * word) @ trust for word, trust in zip(self.code, self.trust, strict=True)], axis=1)
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        return shares / shares.sum(axis=1, keepdims=True)


def fit_codes(shares: list[tuple[np.ndarray, np.ndarray]], languages: list[str], rounds: int = 150) -> LanguageModel | None:
    """Fit one logistic classifier a bit on n-gram shares, all bits together, by gradient steps with momentum.

    An n-gram's share is divided by the root of its mean share, so that rare and frequent ones learn at
    like pace; each language weighs the same whatever its number of samples. None without samples.
    """
    names = sorted(set(languages))
    if not names:
        return None
    code = codewords(len(names))
    own = np.searchsorted(names, languages)
    table = np.zeros((len(shares), BUCKETS), np.float32)
    for at, (found, share) in enumerate(shares):
        table[at, found] = share
    spread = np.sqrt(table.mean(axis=0) + 1e-6)
    table /= spread
    wanted = code[own].astype(np.float32)
    weight = (1 / np.bincount(own)[own] / len(names)).astype(np.float32)[:, None]
    weights, bias = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    pace, drift, drift_bias = np.float32(2.0), np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(rounds):
        margins = table @ weights + bias
        error = -wanted * weight / (1 + np.exp(np.clip(wanted * margins, -30, 30)))
        drift = np.float32(0.9) * drift - pace * (table.T @ error + np.float32(1e-4) * weights)
        drift_bias = np.float32(0.9) * drift_bias - pace * error.sum(axis=0)
        weights, bias = weights + drift, bias + drift_bias
    right = (table @ weights + bias) * wanted > 0
    trust = np.stack([right[own == k].mean(axis=0) for k in range(len(names))])
    trust = np.maximum(trust - 0.5, 0.01)
    trust /= trust.sum(axis=1, keepdims=True)
    # A weight for each bit's share of the loss; the factor sets how sharply losses part the languages.
    return LanguageModel(names, code, trust * min(code.shape[1], 8), weights / spread[:, None], bias)


def fit_languages(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, in_all: int = SAMPLE) -> LanguageModel | None:
    """Learn from ``docs`` (doc_id, text, lang) whose crc32 of the id modulo 4 is not 2.

    Languages are the non-NULL values of ``lang`` there. At most ``per_language`` ids of each and
    ``in_all`` together, picked by a hash of the id and by turns, are reduced to n-gram shares on the
    executors; the driver fits on these. Of rows that repeat id and language one counts, that with the least
    text; rows without an id or a letter are not learnt from. None if nothing is left.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), 4))
    # Limits are taken in every task, then by salt, then by language: one with most rows is never sorted whole.
    chosen = rows.select("lang", "doc_id").distinct()
    for groups in (["lang", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(F.xxhash64("doc_id", F.lit(0)), "doc_id"))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= per_language)
    chosen = chosen.orderBy("place", "lang").limit(in_all).collect()
    if not chosen:
        return None
    sample = spark.createDataFrame([(row.lang, row.doc_id) for row in chosen], "own_lang string, own_id long")
    met = rows.join(F.broadcast(sample), (F.col("lang") == F.col("own_lang")) & (F.col("doc_id") == F.col("own_id")))
    met = met.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            bags = [Counter(words_of(text)) for text in texts_of(batch)]
            found = [(lang, *gram_shares(bag)) for lang, bag in zip(batch.column("lang").to_pylist(), bags, strict=True) if bag]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, _, _ in found], "string"),
                    pa.array([buckets.tobytes() for _, buckets, _ in found], "binary"),
                    pa.array([shares.tobytes() for _, _, shares in found], "binary"),
                ],
                ["lang", "buckets", "shares"],
            )

    found = sorted(map(tuple, map_batches(met, run, "lang string, buckets binary, shares binary").collect()))
    shares = [(np.frombuffer(buckets, np.int32), np.frombuffer(values, np.float32)) for _, buckets, values in found]
    return fit_codes(shares, [lang for lang, _, _ in found])


def _predict(texts: list[str], model: LanguageModel | None) -> tuple[list[str], np.ndarray, list[bool]]:
    predicted, score, ambiguous = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [False] * len(texts)
    if model is None:
        return predicted, score, ambiguous
    bags = [Counter(words_of(text)) for text in texts]
    at = [i for i, bag in enumerate(bags) if bag]
    if at:
        shares = model.decode(model.margins([bags[i] for i in at]))
        ranked = np.sort(shares, axis=1)
        second = ranked[:, -2] if shares.shape[1] > 1 else np.zeros(len(at))
        for i, best, top, next_best in zip(at, shares.argmax(axis=1).tolist(), ranked[:, -1].tolist(), second.tolist(), strict=True):
            predicted[i], score[i], ambiguous[i] = model.languages[best], top, top - next_best < AMBIGUOUS
    return predicted, score, ambiguous


def predict_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score, ambiguous.

    ``score`` is the predicted language's share among the decoded ones, ``ambiguous`` says that the next one
    is close. A NULL text, or one without a letter, is ``und`` with score 0, and so is every text without a model. Equal
    scores go to the language that comes first by name. A NULL doc_id is not held out; repeated
    rows are judged alike; other columns are ignored. Predictions depend on texts alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            predicted, score, ambiguous = _predict(texts_of(batch), sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(predicted, "string"), pa.array(score), pa.array(ambiguous, "bool")],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = map_batches(columns, run, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return found.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", "score", "ambiguous")
