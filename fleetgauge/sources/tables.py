"""Sinks: replace a stored table, or the part of it that a batch covers."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetgauge.labels import SNAPSHOT_PREFIX


def replace_sink(
    df: DataFrame,
    target: str,
    *,
    as_path: bool = False,
    partition_by: Sequence[str] = (),
    only_touched_partitions: bool = False,
    metrics: Mapping[str, Column] | None = None,
    measured: dict[str, object] | None = None,
) -> int:
    """Create or replace ``target`` (a table name, or a parquet folder) and return its new rows.

    Rows are counted while they are written, not by a second pass, and so is what ``metrics`` aggregates; its
    values go into ``measured``. Both are taken in the tasks that write, each of which counts once however
    often an executor is lost. With ``only_touched_partitions`` other partitions of an existing table stay.

    A partitioned table is rebalanced by its partition columns first: else every task would write
    a small file into every partition. Unlike a repartitioning, this splits a partition that holds
    most of the rows over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    # Names of metrics may be any text, so they go by number.
    names = list(metrics or {})
    numbered = [metrics[name].alias(f"m{at}") for at, name in enumerate(names)]
    counted = df.observe(seen, F.count(F.lit(1)).alias("row_count"), *numbered)
    mode = "dynamic" if only_touched_partitions else "static"
    if as_path:
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(*partition_by).parquet(target)
    elif only_touched_partitions and df.sparkSession.catalog.tableExists(target):
        # Inserting into a table heeds only the session setting, not a write option.
        spark = df.sparkSession
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, mode)
        try:
            counted.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(setting, before)
    else:
        counted.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(target)
    found = seen.get
    if measured is not None:
        measured.update({name: found[f"m{at}"] for at, name in enumerate(names)})
    return found["row_count"]


def split_sink(df: DataFrame, target: str, tag: str, *, partition_by: Sequence[str] = ()) -> dict[bool, int]:
    """Replace the parquet folder ``target``, split by the boolean column ``tag``, and return the rows of each side.

    Both sides are written and counted in one pass; ``split_side`` reads one of them.
    """
    sides: dict[str, int] = {}
    rejected = {"true": F.count_if(tag)}
    total = replace_sink(df, target, as_path=True, partition_by=(tag, *partition_by), metrics=rejected, measured=sides)
    return {True: sides["true"], False: total - sides["true"]}


def split_side(spark: SparkSession, schema: StructType, target: str, tag: str, side: bool) -> DataFrame:
    """One side of what ``split_sink`` wrote; only its files are opened."""
    return spark.read.schema(schema).parquet(target).where(F.col(tag) == side).drop(tag)


def stored_days(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of each ``snapshot_date`` folder below ``path``, by their names: no file is opened."""
    try:
        # Any column will do: the names of the files are all that is asked for.
        files = spark.read.schema("snapshot_date string").parquet(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    days: dict[str, list[str]] = {}
    for file in files:
        if found := re.search(r"/snapshot_date=([^/]+)/", file):
            days.setdefault(unquote(found[1]), []).append(file)
    return days


#: Below a table that is replaced by days: its rows, a folder a version and day, and what says which of them count.
_ROWS, _LISTS = "_rows", "_lists"


def replace_days(df: DataFrame, path: str, days: Iterable[str], **options) -> int:
    """Replace the given days of a table by ``snapshot_date``, all at once; a day without rows is emptied.

    Rows go into folders of their own. Then a new list of days, which names each day's folder, is put in place
    by one rename: until then, or if anything fails before, ``read_days`` gives the old state. Rows of other days are not
    written, other stored days stay. What no list but the last two names is removed. One writer at a time.
    Returns the rows written; ``options`` are those of ``replace_sink``.
    """
    spark, days = df.sparkSession, sorted(set(days))
    number, before = _last_list(spark, path)
    version = f"v={uuid.uuid4().hex}"
    target = f"{path}/{_ROWS}/{version}"
    chosen = df.where(F.col("snapshot_date").isin(*days))
    written = replace_sink(chosen, target, as_path=True, partition_by=("snapshot_date",), **options)
    found = set(child_names(spark, target, "snapshot_date="))
    kept = {day: place for day, place in before.items() if day not in days}
    _put_list(spark, path, number + 1, kept | {day: f"{_ROWS}/{version}" for day in days if day in found})
    _remove_unlisted(spark, path)
    return written


def read_days(spark: SparkSession, path: str, schema: StructType, days: Iterable[str] | None = None) -> DataFrame:
    """A table that ``replace_days`` keeps, whole or of some days; only their folders are opened.

    ``schema`` includes ``snapshot_date``.
    """
    _, listed = _last_list(spark, path)
    wanted = set(listed) if days is None else set(days) & set(listed)
    places: dict[str, list[str]] = {}
    for day in sorted(wanted):
        places.setdefault(f"{path}/{listed[day]}".rstrip("/"), []).append(f"snapshot_date={day}")
    parts = [
        spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{name}" for name in names))
        for base, names in places.items()
    ]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def _lists(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in child_names(spark, f"{path}/{_LISTS}", "list-"))


def _list_of(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    row = spark.read.text(f"{path}/{_LISTS}/list-{number:010d}", wholetext=True).first()
    return json.loads(row.value)


def _last_list(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number and content of the list in force; a table written without one has its days right below it."""
    if numbers := _lists(spark, path):
        return numbers[-1], _list_of(spark, path, numbers[-1])
    return 0, dict.fromkeys(child_names(spark, path, "snapshot_date="), "")


def _put_list(spark: SparkSession, path: str, number: int, days: Mapping[str, str]) -> None:
    files, staged = _file_system(spark, f"{path}/{_LISTS}/.next-{uuid.uuid4().hex}")
    _, final = _file_system(spark, f"{path}/{_LISTS}/list-{number:010d}")
    out = files.create(staged, True)
    out.write(bytearray(json.dumps(dict(days), sort_keys=True).encode()))
    out.close()
    if files.exists(final) or not files.rename(staged, final):
        files.delete(staged, False)
        raise RuntimeError(f"another writer has replaced days of {path}")


def _remove_unlisted(spark: SparkSession, path: str) -> None:
    """Remove older lists than the last two, and the folders that only they name."""
    numbers = _lists(spark, path)
    old, last = numbers[:-2], numbers[-2:]
    named = {(place, day) for number in last for day, place in _list_of(spark, path, number).items()}
    for number in old:
        for day, place in _list_of(spark, path, number).items():
            if (place, day) not in named:
                files, folder = _file_system(spark, f"{path}/{place}/snapshot_date={day}")
                files.delete(folder, True)
        files, listed = _file_system(spark, f"{path}/{_LISTS}/list-{number:010d}")
        files.delete(listed, False)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def child_names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names right below ``path``; one listing, nothing deeper is looked at."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [unquote(name.removeprefix(prefix)) for name in names if name.startswith(prefix)]


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file from the driver, whole or not at all; one that is there already is replaced."""
    folder, _, _ = path.rpartition("/")
    files, staged = _file_system(spark, f"{folder}/.next-{uuid.uuid4().hex}")
    _, final = _file_system(spark, path)
    out = files.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(final, False)
    if not files.rename(staged, final):
        raise OSError(f"cannot write {path}")


def replace_snapshots(df: DataFrame, path: str, snapshots: Iterable[str]) -> int:
    """Replace the given snapshots of a table stored by ``snapshot_date`` and ``snapshot_folder``.

    One without rows is removed, others stay and are not listed. Returns the rows written. ``df`` holds rows of
    these snapshots alone, which are few: their names come to the driver.
    """
    chosen = df.where(F.col("snapshot_folder").isin(*snapshots))
    found: dict = {}
    names = F.array_join(F.sort_array(F.collect_set("snapshot_folder")), ",")
    written = replace_sink(
        chosen,
        path,
        as_path=True,
        partition_by=("snapshot_date", "snapshot_folder"),
        only_touched_partitions=True,
        metrics={"names": names},
        measured=found,
    )
    for snapshot in set(snapshots) - set((found["names"] or "").split(",")):
        day = snapshot.removeprefix(SNAPSHOT_PREFIX)[:8]
        remove_folder(df.sparkSession, f"{path}/snapshot_date={day}/snapshot_folder={snapshot}")
    return written
