"""Document fingerprints from prefix polynomial hashes.

The hash of every prefix of a text, modulo a prime, is one cumulative sum. From it the hash of any span is
a subtraction, so spans compare in constant time and the longest common extension of two places
is found by binary search. A fingerprint holds a text's length, the hash of its whole, the hashes of its
prefixes at fixed places, and two sketches: the smallest mixed hashes of its windows of 24 and of 4
characters. By these the likeness of two texts is estimated without them: binary search over the
places finds how far they start alike, and the sketches the share of windows they have in common.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches, ship_package, text_slices

#: Characters in a window of the sketch.
WINDOW = 24
#: Characters in a window of the other sketch. The longer the shorter text, the more the wide windows count: half
#: at ``EVEN`` characters.
FINE_WINDOW = 4
EVEN = 256
#: Window hashes that a sketch keeps.
KEPT = 64
#: Places of prefix hashes between a length and its double; up to twice as many characters each place has one.
PLACES = 16

#: Two Mersenne primes' moduli would overflow 64 bits in products; one of 31 bits, with two bases, does not.
PRIME = (1 << 31) - 1
BASES = (1_000_003, 1_566_083_941)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_P = np.uint64(PRIME)
_S = np.uint64(31)


def _reduced(values: np.ndarray) -> np.ndarray:
    """Values below 2**62 modulo the Mersenne prime."""
    values = (values & _P) + (values >> _S)
    values = (values & _P) + (values >> _S)
    return np.where(values >= _P, values - _P, values)


class _Powers:
    """Powers of a base and of its inverse, grown as longer texts come."""

    def __init__(self, base: int):
        self.steps = (base, pow(base, -1, PRIME))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> list[np.ndarray]:
        for side, step in enumerate(self.steps):
            table = self.tables[side]
            while len(table) < n:
                # The next stretch is the whole table so far, times the power it lacks.
                table = np.r_[table, _reduced(table * np.uint64(pow(step, len(table), PRIME)))]
            self.tables[side] = table
        return self.tables


_powers = [_Powers(base) for base in BASES]


class PrefixHash:
    """Prefix hashes of a text by each of the bases."""

    def __init__(self, text: str, bases: int = len(BASES)):
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.length = len(chars)
        self.prefixes, self.inverses = [], []
        for powers in _powers[:bases]:
            ahead, back = powers.upto(self.length + 1)
            terms = _reduced(chars * ahead[: self.length])
            sums = np.zeros(self.length + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])  # below 2**63 for texts of up to 2**32 characters
            self.prefixes.append(_reduced(sums))
            self.inverses.append(back)

    def spans(self, starts: np.ndarray, lengths, base: int = 0) -> np.ndarray:
        """Hashes of the spans at ``starts``, whatever their places; equal spans have equal hashes."""
        prefix = self.prefixes[base]
        difference = prefix[starts + lengths] + _P - prefix[starts]
        return _reduced(_reduced(difference) * self.inverses[base][starts])

    def whole(self) -> tuple[int, ...]:
        return tuple(int(prefix[-1]) for prefix in self.prefixes)

    def equal(self, at: int, other: PrefixHash, other_at: int, length: int) -> bool:
        """Whether two spans are equal, but for a chance of about 2**-60 that unequal ones pass."""
        if at + length > self.length or other_at + length > other.length:
            return False
        one, two = np.array([at]), np.array([other_at])
        return all(
            self.spans(one, length, base)[0] == other.spans(two, length, base)[0] for base in range(len(self.prefixes))
        )

    def common_extension(self, at: int, other: PrefixHash, other_at: int) -> int:
        """Characters from the two places on that are equal, by binary search."""
        low, high = 0, min(self.length - at, other.length - other_at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(at + low, other, other_at + low, middle - low):
                low = middle
            else:
                high = middle - 1
        return low


_STEPS = np.arange(PLACES, 2 * PLACES)
_PLACES = np.r_[np.arange(1, PLACES), (_STEPS << np.arange(32 - PLACES.bit_length())[:, None]).ravel()]


def places_upto(length: int) -> np.ndarray:
    """Places of the prefix hashes of a text: 1 to 31, then 16 to 31 times each power of two, up to its length."""
    return _PLACES[: np.searchsorted(_PLACES, length, side="right")]


def _least_windows(prefix: PrefixHash, window: int) -> np.ndarray:
    """The smallest distinct mixed window hashes; a text shorter than a window is one window."""
    if not prefix.length:
        return np.empty(0, np.uint32)
    length = min(window, prefix.length)
    mixed = prefix.spans(np.arange(prefix.length - length + 1), length) + np.uint64(length)
    mixed = (mixed * _MIX) ^ ((mixed * _MIX) >> np.uint64(29))
    mixed = ((mixed * _MIX) >> np.uint64(32)).astype(np.uint32)
    few = 4 * KEPT
    if len(mixed) > few:
        # Windows repeat, so look at more than are kept, and at all if that is not enough.
        least = np.unique(np.partition(mixed, few)[:few])
        if len(least) >= KEPT:
            return least[:KEPT]
    return np.unique(mixed)[:KEPT]


@dataclass(eq=False)
class Sketch:
    """What a fingerprint says of a text: length, hash of the whole, prefix hashes, least windows."""

    length: int
    whole: str
    starts: np.ndarray
    wide: np.ndarray
    fine: np.ndarray

    def __eq__(self, other: Sketch) -> np.bool_:
        return np.bool_(str(self) == str(other))

    def __str__(self) -> str:
        hashes = (values.astype(">u4").tobytes().hex() for values in (self.starts, self.wide, self.fine))
        return "-".join((f"{self.length:x}", self.whole, *hashes))

    def common_start(self, other: Sketch) -> int:
        """The last place up to which the texts are equal, by binary search, but for a chance of about 2**-31 a step.

        Exact up to 31 characters, from there on less than a sixteenth too low.
        """
        if self.length == other.length and self.whole == other.whole:
            return self.length
        both = min(len(self.starts), len(other.starts))
        equal = bisect_left(range(both), True, key=lambda at: bool(self.starts[at] != other.starts[at]))
        return int(places_upto(min(self.length, other.length))[equal - 1]) if equal else 0


def fingerprint(text: str) -> tuple[str, Sketch]:
    """A text's fingerprint as text, and what it says."""
    prefix = PrefixHash(text)
    whole = "".join(f"{value:08x}" for value in prefix.whole())
    starts = prefix.prefixes[0][places_upto(prefix.length)].astype(np.uint32)
    sketch = Sketch(prefix.length, whole, starts, _least_windows(prefix, WINDOW), _least_windows(prefix, FINE_WINDOW))
    return str(sketch), sketch


def sketch_of(fingerprint_text: str) -> Sketch:
    length, whole, *hashes = fingerprint_text.split("-")
    return Sketch(int(length, 16), whole, *(np.frombuffer(bytes.fromhex(h), ">u4").astype(np.uint32) for h in hashes))


def _shared(one: np.ndarray, two: np.ndarray) -> float:
    """Share of common values among the least of both, which ascend and are distinct."""
    merged = np.concatenate((one, two))
    merged.sort()
    again = merged[1:] == merged[:-1]
    first = np.flatnonzero(np.concatenate(([True], ~again)))
    if len(one) == KEPT or len(two) == KEPT:
        first = first[:KEPT]
    return int(np.append(again, False)[first].sum()) / len(first)


def likeness(one: Sketch, two: Sketch) -> float:
    """Estimated share of what two texts have in common, 0 to 1; two empty texts are alike.

    The larger of two shares: of the characters, counted as far as the texts start alike, and of the windows, both
    sketches weighed. The weight of the wide ones grows with the length of the shorter text, without a step.
    """
    common = one.common_start(two)
    if not one.length or not two.length or common == one.length == two.length:
        return float(one.length == two.length)
    shorter = min(one.length, two.length)
    windows = (shorter * _shared(one.wide, two.wide) + EVEN * _shared(one.fine, two.fine)) / (shorter + EVEN)
    return max(windows, common / (one.length + two.length - common))


def edited_text(text: str, following: str) -> str:
    """The text with its last quarter of characters replaced by the first as many of ``following``."""
    replaced = len(text) // 4
    return text[: len(text) - replaced] + following[:replaced] if replaced else text


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_RESULT_ARROW = pa.schema(
    [("doc_id", "int64"), ("n_chars", "int64"), ("edited_sha256", "string"), ("fingerprint", "string"),
     ("edited_fingerprint", "string"), ("near_edited", "float64"), ("near_next", "float64")]
)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of each document, from rows in order of (bucket, only_next, doc_id, hash, text)."""
    before = None
    for batch in text_slices(batches):
        found = []
        columns = [batch.column(name).to_pylist() for name in ("bucket", "only_next", "doc_id", "text")]
        for bucket, only_next, doc, text in zip(*columns, strict=True):
            text = text or ""
            own = before[4] if before and before[3] == text else fingerprint(text)
            if before and before[0] == bucket and not before[1]:
                _, _, left_doc, left_text, left = before
                edited = edited_text(left_text, text)
                changed = fingerprint(edited) if edited != left_text else left
                digest = hashlib.sha256(edited.encode()).hexdigest()
                near = likeness(left[1], changed[1]), likeness(left[1], own[1])
                found.append((left_doc, len(left_text), digest, left[0], changed[0], *near))
            before = (bucket, only_next, doc, text, own)
        arrays = zip(*found, strict=True) if found else [[]] * len(_RESULT_ARROW)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(arrays, _RESULT_ARROW, strict=True)],
            schema=_RESULT_ARROW,
        )


def fingerprint_documents(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is that with the next larger doc_id, after the last the first. A NULL text is empty.
    NULL ids come first; rows that repeat an id follow one another in the order of ``xxhash64`` of their texts; a
    single row is its own next. An empty table gives no rows. Other columns are ignored.

    Documents are dealt into ranges of ids by quantiles. An id that fills several of them, and the rows without
    one, are dealt further by their texts' hash. The first document of a range goes along to the range before
    it; of each range one id and hash come to the driver, and one row is copied.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
    tasks = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranges = 2 * tasks
    shares = [at / ranges for at in range(1, ranges)]
    cuts, rows, ids = docs.agg(
        F.percentile_approx("doc_id", shares, 100 * tasks), F.count(F.lit(1)), F.count("doc_id")
    ).first()
    without_id = 1 + (rows - ids) * ranges // max(rows, 1)
    edges, groups = _segments(cuts or [], without_id)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        segment = np.searchsorted(edges, ids.fillna(0).astype(np.int64), side="right") + 1
        segment = np.where(ids.isna(), 0, segment)
        # The upper half of the hash, as a number from 0, times the groups.
        upper = (hashes.to_numpy(np.int64) >> 32) + (1 << 31)
        return pd.Series((np.cumsum(groups) - groups)[segment] + (upper * groups[segment] >> 32))

    dealt = docs.withColumn("bucket", bucket_of("doc_id", "text_hash"))
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    firsts = sorted((row.bucket, row.first.doc_id, row.first.text_hash) for row in firsts.collect())
    to_left = [(doc, text_hash, firsts[at - 1][0]) for at, (_, doc, text_hash) in enumerate(firsts)]
    wanted = F.broadcast(spark.createDataFrame(to_left, "first_id long, first_hash long, to_bucket int"))
    copied = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash")))
    # Of equal rows one is copied; which is of no account.
    copied = copied.groupBy("to_bucket", "doc_id", "text_hash").agg(F.min("text").alias("text"))
    columns = ["bucket", "only_next", "doc_id", "text_hash", "text"]
    dealt = (
        dealt.withColumn("only_next", F.lit(False))
        .select(*columns)
        .union(copied.withColumn("only_next", F.lit(True)).withColumnRenamed("to_bucket", "bucket").select(*columns))
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket", "only_next", F.col("doc_id").asc_nulls_first(), "text_hash", F.col("text").asc_nulls_first())
    )
    return map_batches(dealt.drop("text_hash"), _pairs, _RESULT)


def _segments(cuts: list[int], without_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of segments of ids, and each segment's number of groups; the first one is of the rows without an id.

    An id that is a quantile several times is a segment of its own, with as many groups.
    """
    edges, groups = [], [without_id, 1]
    for cut, times in sorted(Counter(cuts).items()):
        edges.append(cut)
        groups.append(times)
        if times > 1 and cut < np.iinfo(np.int64).max:
            edges.append(cut + 1)
            groups.append(1)
    # Where a segment of one id is followed by the next id's, the edge between them stands twice.
    kept = [at for at, edge in enumerate(edges) if at + 1 == len(edges) or edges[at + 1] != edge]
    return np.array([edges[at] for at in kept], np.int64), np.array([*groups[:2], *(groups[at + 2] for at in kept)], np.int64)
