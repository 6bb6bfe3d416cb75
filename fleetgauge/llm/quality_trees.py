"""Quality rules: gradient-boosted trees over document statistics, scored as flat node arrays.

Statistics are exact and per document. The trees are fitted on a bounded sample of labelled documents
and may only raise the probability of poor quality as the shares of symbols, repeated lines and
repeated words rise. Scoring walks all trees of a batch at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches, one_text_each, text_slices, texts_of

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Labelled documents the trees are fitted on at most.
SAMPLE = 6_000

_SPACES = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_STOPS = b".!?"

#: Inputs of the trees, and +1 where the probability of poor quality may only rise with one.
FEATURES = {
    "log_words": 0,
    "chars_per_word": 0,
    "symbols_per_word": 1,
    "dup_line_share": 1,
    "repeat_share": 1,
    "upper_share": 0,
    "digit_share": 0,
    "stops_per_word": 0,
    "commas_per_word": 0,
    "distinct_share": 0,
    "words_per_line": 0,
    "short_word_share": 0,
    "long_word_share": 0,
}


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words that stand in a window of ``window`` words found twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = {word: at for at, word in enumerate(dict.fromkeys(words))}
    code = places = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    code = code[:n]
    for at in range(1, window):
        if int(code.max() + 1) * (len(number) + 1) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(number) + places[at : n + at]
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(code, np.unique(twice))
    covered = np.zeros(len(words), bool)
    for at in range(window):
        covered[at : n + at] |= found
    return int(covered.sum())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The counts of a text (see COUNTS) and the inputs of the trees (see FEATURES)."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n = len(words)
    chars = len(text) - _count(data, _SPACES)
    symbols = _count(data, SYMBOLS)
    dup_lines = len(lines) - len(set(lines))
    repeated = repeat_words(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    per_word, per_line, per_char = max(n, 1), max(len(lines), 1), max(chars, 1)
    return (n, chars, symbols, dup_lines, repeated), (
        float(np.log1p(n)),
        chars / per_word,
        symbols / per_word,
        dup_lines / per_line,
        repeated / per_word,
        _count(data, _UPPER) / per_char,
        _count(data, _DIGITS) / per_char,
        _count(data, _STOPS) / per_word,
        data.count(b",") / per_word,
        len(set(words)) / per_word,
        n / per_line,
        float((lengths <= 3).sum()) / per_word,
        float((lengths >= 20).sum()) / per_word,
    )


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Too few words, or too many of them in repeated windows, for rows of COUNTS."""
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


@dataclass
class Trees:
    """All trees' nodes in flat arrays; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def probability(self, inputs: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(inputs), len(self.roots))).copy()
        rows = np.arange(len(inputs))[:, None]
        for _ in range(self.depth):
            goes_left = inputs[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_trees(
    inputs: np.ndarray,
    targets: np.ndarray,
    monotone: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 1.0,
    least: int = 8,
) -> Trees:
    """Boost ``trees`` trees on the log loss; ``monotone`` has 1, 0 or -1 for each input.

    Splits lie at quantiles. A split on a constrained input must order its leaves, and the midpoint
    bounds what either side may become further down.
    """
    n, width = inputs.shape
    edges = [np.unique(np.quantile(inputs[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], inputs[:, f], side="left") for f in range(width)], axis=1)
    share = np.clip(targets.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots = []
    score = np.full(n, base)

    def grow(rows: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value = float(np.clip(-g / (h + ridge), low, high))
        here = len(nodes)
        nodes.append([0, np.inf, here, here, rate * value])
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for f in range(width):
                size = len(edges[f]) + 1
                of = binned[rows, f]
                below = [np.cumsum(np.bincount(of, w, size))[:-1] for w in (gradient[rows], hessian[rows], None)]
                gl, hl, nl = below
                gr, hr, nr = g - gl, h - hl, len(rows) - nl
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                gain = -(gl * vl + (hl + ridge) * vl**2 / 2) - (gr * vr + (hr + ridge) * vr**2 / 2)
                gain += g * value + (h + ridge) * value**2 / 2
                gain[(nl < least) | (nr < least) | (monotone[f] * (vr - vl) < 0)] = 0
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (float(gain[at]), (f, at, float(vl[at]), float(vr[at])))
        if best[1]:
            f, at, vl, vr = best[1]
            middle = (vl + vr) / 2
            lower, upper = (low, high), (low, high)
            if monotone[f] > 0:
                lower, upper = (low, middle), (middle, high)
            elif monotone[f] < 0:
                lower, upper = (middle, high), (low, middle)
            to_left = binned[rows, f] <= at
            children = grow(rows[to_left], gradient, hessian, level + 1, *lower), None
            children = children[0], grow(rows[~to_left], gradient, hessian, level + 1, *upper)
            nodes[here][:4] = [f, edges[f][at], *children]
        return here

    def flat() -> Trees:
        table = np.array(nodes, float).reshape(-1, 5)
        feature, left, right = (table[:, c].astype(np.int64) for c in (0, 2, 3))
        return Trees(feature, table[:, 1], left, right, table[:, 4], np.array(roots, np.int64), depth, base)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(n), p - targets, p * (1 - p), 0, -4.0, 4.0))
        last = flat()
        last.roots, last.base = last.roots[-1:], 0.0
        p = last.probability(inputs)
        score += np.log(p / (1 - p))
    return flat()


_STATISTICS = "quality int, inputs array<double>"


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, where=None) -> DataFrame:
    """``text`` and ``label`` of at most ``limit`` labelled documents, picked by a hash of their ids.

    The ids are broadcast; ``limit`` bounds them. Repeated labels of a document count once; of rows that
    repeat an id that with the least text counts.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        chosen = chosen.where(where)
    chosen = chosen.groupBy(F.col("doc_id").alias("label_id")).agg(F.max(label).cast("int").alias(label))
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(limit)
    return one_text_each(docs, chosen, label)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees for the probability that ``labels.quality`` is 0; None without examples of both kinds.

    The statistics of at most ``sample`` labelled documents come to the driver, a row of numbers each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            inputs = [list(statistics(text)[1]) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(inputs, pa.list_(pa.float64()))], ["quality", "inputs"]
            )

    rows = map_batches(labelled_sample(docs, labels, "quality", sample), run, _STATISTICS).collect()
    rows.sort()
    targets = np.array([row.quality == 0 for row in rows], float)
    if len(np.unique(targets)) < 2:
        return None
    return fit_trees(np.array([row.inputs for row in rows]), targets, np.array([*FEATURES.values()]))


def _verdicts(texts: list[str], trees: Trees | None, threshold: float) -> tuple[np.ndarray, ...]:
    found = [statistics(text) for text in texts]
    counts = np.array([counts for counts, _ in found], np.int64)
    inputs = np.array([inputs for _, inputs in found])
    poor = trees.probability(inputs) if trees else np.zeros(len(texts))
    failed = base_failed(counts)
    return counts, failed, poor, ~failed & (poor < threshold)


_SCORED = "doc_id long, " + "".join(f"{name} long, " for name in COUNTS) + "base_failed boolean, poor double, kept boolean"


def score_quality(docs: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, the counts, base_failed, poor (a probability), kept.

    ``kept`` is false where the base rule fails, else the trees' verdict; without trees all the
    rest are kept. A NULL or empty text has no words and fails the base rule. Rows are judged one by
    one: NULL and repeated doc_ids stay as they are, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            counts, failed, poor, kept = _verdicts(texts_of(batch), trees, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, counts.T), pa.array(failed), pa.array(poor), pa.array(kept)],
                ["doc_id", *COUNTS, "base_failed", "poor", "kept"],
            )

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _SCORED)


def keep_quality(docs: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that ``score_quality`` keeps.

    Rows are judged one by one by their text: repeated ones stay or go together, whatever their ids. NULL, empty and
    blank texts have too few words and go; without trees the base rule alone decides. Columns may have any name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield batch.filter(pa.array(_verdicts(texts_of(batch), trees, threshold)[3]))

    return map_batches(docs, run, docs.schema)
