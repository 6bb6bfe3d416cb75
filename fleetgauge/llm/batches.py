"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task unpacks into Python objects at once; a longer text comes alone.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='fleetgauge-code-')}/fleetgauge", "zip", package.parent, package.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with at most ``limit`` bytes of text, in order."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Remembered(dict):
    """Values of ``find`` by text: what is met again is looked up.

    Bounded in bytes: a key longer than ``longest`` is found anew each time, and at ``most`` keys all are forgotten.
    """

    def __init__(self, find: Callable, most: int, longest: int = 256):
        self.find, self.most, self.longest = find, most, longest

    def __missing__(self, key):
        value = self.find(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def one_text_each(docs: DataFrame, sample: DataFrame, label: str) -> DataFrame:
    """``text`` and ``label`` of each document of ``sample`` (label_id, label), a row an id.

    Rows that repeat an id are reduced to the least text, on the map side first; a NULL text counts only alone.
    """
    found = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    return found.groupBy("label_id", label).agg(F.min("text").alias("text")).select("text", label)


def ascii_words(text: str) -> list[bytes]:
    """Maximal runs of UTF-8 bytes outside 0x20 and 0x09 to 0x0D."""
    return text.encode().split()


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key's text modulo ``modulus``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def held_out(key: Column, modulus: int, fold: int = 2) -> Column:
    """Whether a row belongs to the held-out fold; rows without a key do not."""
    return F.coalesce(remainder(key, modulus) == fold, F.lit(False))
