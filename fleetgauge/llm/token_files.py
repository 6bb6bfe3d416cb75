"""Token ids as flat binary files with 64-bit document offsets, read through memory maps.

A store is a folder of shards and a manifest. A shard has three files: ``.ids`` (all token ids,
unsigned little-endian integers of the smallest width that holds the vocabulary), ``.offsets`` (n + 1
unsigned 64-bit positions, the first 0) and ``.docs`` (n signed 64-bit document ids). Shards
follow one another in ascending document order; the manifest gives each shard's place, and the number
of ids and documents before it, summed up over the shards ahead of it.

Shards are written under names of their own by each task attempt and count only once the manifest names
them, so a repeated or lost attempt leaves nothing but a file nobody reads.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches, text_slices, texts_of
from fleetgauge.llm.library_tokens import encoder

_SHARD = "first_doc_id long, n_docs long, n_ids long, name string"
_PLACED = _SHARD + ", place int"
_MANIFEST = _SHARD + ", docs_before long, ids_before long, dtype string"
_MISSING_ID = -(1 << 63)


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def _write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str, end_id: int, dtype: str
) -> Iterator[pa.RecordBatch]:
    store, path = _file_system(folder)
    name = uuid.uuid4().hex
    end = np.array([end_id], dtype).tobytes()
    encode = encoder(tokenizer_path, dtype).encode
    offsets, docs, first = array("Q", [0]), array("q"), None
    width = np.dtype(dtype).itemsize
    with store.open_output_stream(f"{path}/{name}.ids") as out:
        for batch in text_slices(batches):
            ids_of_docs = batch.column("doc_id").to_pylist()
            first = first if docs else ids_of_docs[0]
            docs.extend(_MISSING_ID if doc is None else doc for doc in ids_of_docs)
            for ids in encode(texts_of(batch)):
                out.write(ids + end)
                offsets.append(offsets[-1] + len(ids) // width + 1)
    if not docs:
        store.delete_file(f"{path}/{name}.ids")
        return
    for suffix, values, kind in (("offsets", offsets, "<u8"), ("docs", docs, "<i8")):
        with store.open_output_stream(f"{path}/{name}.{suffix}") as out:
            out.write(np.array(values, kind).tobytes())
    yield pa.RecordBatch.from_pylist(
        [{"first_doc_id": first, "n_docs": len(docs), "n_ids": offsets[-1], "name": name,
          "place": TaskContext.get().partitionId()}],
        pa.schema([("first_doc_id", "int64"), ("n_docs", "int64"), ("n_ids", "int64"), ("name", "string"), ("place", "int32")]),
    )


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Encode ``docs`` (doc_id, text) into a store below ``folder``; returns the manifest.

    ``folder`` must be on storage that all executors reach. Other columns are ignored. A NULL text is
    empty, an empty text has only the end id. A NULL doc_id stands before all others; rows that
    repeat a doc_id are all kept, in the order of ``xxhash64`` of their texts. An empty table gives an empty store.
    Ranges are cut by id and that hash, so the rows of one id go to several shards if they are many and
    their texts differ. One row per shard passes the driver, nothing that grows with a shard.
    """
    spark = docs.sparkSession
    store, path = _file_system(folder)
    store.create_dir(path, recursive=True)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("text_hash", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "text_hash")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text_hash", F.col("text").asc_nulls_first())
        .drop("text_hash")
    )
    shards = map_batches(
        ordered, lambda batches: _write_shard(batches, folder, tokenizer_path, end_id, dtype), _PLACED
    ).collect()
    # Ranges are numbered in their order; several shards may start with the same id.
    shards.sort(key=lambda shard: shard.place)
    shards = [shard[:-1] for shard in shards]
    docs_before = accumulate((shard[1] for shard in shards), initial=0)
    ids_before = accumulate((shard[2] for shard in shards), initial=0)
    rows = [(*shard, d, i, dtype) for shard, d, i in zip(shards, docs_before, ids_before)]  # noqa: B905
    manifest = spark.createDataFrame(rows, _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest


class Shard:
    """The documents of one shard. Where files can be mapped they are, else they are read."""

    def __init__(self, folder: str, name: str, dtype: str):
        store, path = _file_system(folder)

        def values(suffix: str, kind: str) -> np.ndarray:
            if isinstance(store, fs.LocalFileSystem):
                return np.memmap(f"{path}/{name}.{suffix}", kind, "r")
            with store.open_input_file(f"{path}/{name}.{suffix}") as file:
                return np.frombuffer(file.read(), kind)

        self.ids = values("ids", dtype)
        self.offsets = values("offsets", "<u8")
        self.docs = values("docs", "<i8")

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, at: int) -> np.ndarray:
        """Ids of the document at place ``at``, its end id included."""
        return self.ids[int(self.offsets[at]) : int(self.offsets[at + 1])]


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
_READ_ARROW = pa.schema([(name, "int64") for name in ("doc_id", "start", "n_tokens", "ids_crc32")])


def _read_shards(batches: Iterator[pa.RecordBatch], folder: str, step: int = 10_000) -> Iterator[pa.RecordBatch]:
    for entry in (row for batch in batches for row in batch.to_pylist()):
        shard = Shard(folder, entry["name"], entry["dtype"])
        for low in range(0, len(shard), step):
            places = range(low, min(low + step, len(shard)))
            docs = [int(shard.docs[at]) for at in places]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if doc == _MISSING_ID else doc for doc in docs], "int64"),
                    pa.array([entry["ids_before"] + int(shard.offsets[at]) for at in places], "int64"),
                    pa.array([len(shard[at]) for at in places], "int64"),
                    pa.array([zlib.crc32(shard[at].astype("<u4").tobytes()) for at in places], "int64"),
                ],
                schema=_READ_ARROW,
            )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A task maps one shard at a time. ``ids_crc32`` is over the ids as little-endian 32-bit integers.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    tasks = max(1, spark.sparkContext.defaultParallelism * 4)
    return map_batches(manifest.repartition(tasks, "name"), lambda batches: _read_shards(batches, folder), _READ)
