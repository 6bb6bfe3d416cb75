"""Best-fit decreasing packing of tokenized documents into sequences of a fixed capacity.

Best fit looks at lengths alone, and pieces of equal length are interchangeable. So the whole corpus
is packed exactly from its histogram of lengths, which has at most ``capacity`` entries whatever the
input's size: for each length, from the longest, the tightest bins that still have room are found
in a segment tree over remaining capacities, and runs of bins in the same state are filled
together. The resulting plan says which ranks of a length go to which run of bins; Spark ranks the
pieces of each length (counts per input split, then prefix sums) and joins them with the plan.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches, text_slices, texts_of
from fleetgauge.llm.library_tokens import encoder
from fleetgauge.session import new_scratch_path

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, split int, rank long"
#: Rows of a plan that is sent to all tasks at most, of 48 bytes each.
MOST_SENT = 200_000
_PLAN = "length long, rank_from long, rank_to long, first_sequence long, per_bin long, filled long"


class CapacityTree:
    """Segment tree over remaining capacities 0 to ``capacity``: how many open bins have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.bins = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        at = room + self.leaves
        while at:
            self.bins[at] += bins
            at //= 2

    def tightest(self, length: int) -> int | None:
        """Smallest remaining capacity of at least ``length`` that an open bin has."""
        at = length + self.leaves
        while not self.bins[at]:
            while at & 1:  # a right child: go up until there is something to the right
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at *= 2
            at += not self.bins[at]
        return at - self.leaves


def best_fit_plan(lengths: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Plan rows (length, rank_from, rank_to, first_sequence, per_bin, filled) from (length, count).

    Ranks ``rank_from`` to ``rank_to`` of a length go, ``per_bin`` each, to the sequences from
    ``first_sequence`` on, behind ``filled`` tokens. The bins are those of best fit decreasing.
    """
    plan = []
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}
    sequences = 0

    def put(room: int, first: int, bins: int) -> None:
        if room and bins:
            runs.setdefault(room, []).append((first, bins))
            tree.add(room, bins)

    for length, count in sorted(lengths, reverse=True):
        rank = 0
        while rank < count:
            room = tree.tightest(length)
            if room is None:
                room, bins = capacity, -(-(count - rank) // (capacity // length))
                first, sequences = sequences, sequences + bins
            else:
                first, bins = runs[room].pop()
                tree.add(room, -bins)
            # A bin just filled is the tightest until the length no longer fits.
            per_bin = room // length
            full = min(bins, (count - rank) // per_bin)
            if full:
                plan.append((length, rank, rank + full * per_bin, first, per_bin, capacity - room))
                put(room - per_bin * length, first, full)
                rank += full * per_bin
                first, bins = first + full, bins - full
            if bins and 0 < count - rank < per_bin:
                rest = count - rank
                plan.append((length, rank, count, first, per_bin, capacity - room))
                put(room - rest * length, first, 1)
                rank = count
                first, bins = first + 1, bins - 1
            put(room, first, bins)
    return plan


def _cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ids) of each piece: all of ``capacity`` ids but the first, which has the rest."""
    head = len(ids) % capacity or min(len(ids), capacity)
    start = 0
    for stop in range(head, len(ids) + 1, capacity):
        yield start, ids[start:stop]
        start = stop


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) into pieces of at most ``capacity`` ids, ranked per split and length.

    Returns doc_id, piece, start, length, ids_crc32, split, rank, and ids if ``with_ids``. Other
    columns are ignored. A NULL or empty text is a single piece of the end id; rows with a NULL or
    repeated doc_id are kept as they are.
    """
    from pyspark import TaskContext

    names = [field.split()[0] for field in _PIECES.split(", ")]
    kinds = {"piece": "int32", "split": "int32"}
    arrow = pa.schema([(name, kinds.get(name, "int64")) for name in names] + [("ids", "binary")] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, ranks = TaskContext.get().partitionId(), Counter()
        encode = encoder(tokenizer_path).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in text_slices(batches):
            rows = []
            found = encode(texts_of(batch))
            for doc, data in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                for piece, (start, ids) in enumerate(_cut(np.frombuffer(data + end, "<u4"), capacity)):
                    raw = ids.tobytes()
                    row = (doc, piece, start, len(ids), zlib.crc32(raw), split, ranks[len(ids)])
                    rows.append(row + (raw,) * with_ids)
                    ranks[len(ids)] += 1
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, arrow, strict=True)], schema=arrow
            )

    schema = _PIECES + ", ids binary" * with_ids
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, schema)


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False
) -> DataFrame:
    """Place every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    See ``pieces_of`` for NULLs, empty texts and repeated rows; an empty table gives no rows. The
    pieces are written once to the shared folder, so that ranks stand when a task is repeated. The
    driver sees the histogram of lengths, at most ``capacity`` rows.
    """
    spark = docs.sparkSession
    path = new_scratch_path(spark, "pieces")
    pieces_of(docs, tokenizer_path, end_id, capacity, with_ids).write.parquet(path)
    pieces = spark.read.parquet(path)
    in_split = pieces.groupBy("length", "split").agg((F.max("rank") + 1).alias("pieces"))
    ahead = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = in_split.withColumn("base", F.coalesce(F.sum("pieces").over(ahead), F.lit(0))).drop("pieces")
    lengths = in_split.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    rows = best_fit_plan(lengths, capacity)
    plan = spark.createDataFrame(rows, _PLAN)
    # A plan has a few rows for each length, whatever the corpus; sent along, it spares the pieces a shuffle by length.
    plan = F.broadcast(plan) if len(rows) <= MOST_SENT else plan
    ranked = pieces.join(bases, ["length", "split"]).withColumn("rank", F.col("base") + F.col("rank"))
    nth = F.col("rank") - F.col("rank_from")
    placed = ranked.join(plan.withColumnRenamed("length", "plan_length"),
        (F.col("length") == F.col("plan_length"))
        & (F.col("rank") >= F.col("rank_from"))
        & (F.col("rank") < F.col("rank_to")),
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("filled") + (nth % F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
        *["ids"] * with_ids,
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (little-endian 32-bit integers).

    ``placed`` is the result of ``pack(..., with_ids=True)``. A sequence has at most ``capacity`` ids. Pieces of
    one sequence lie at different offsets, so there are no ties; those of an empty text are its end id, and no
    pieces give no sequences. Other columns are ignored.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
