"""Structured Streaming over a capture folder: store new snapshots, refresh the marts they touch.

The file source hands over each snapshot file once. A micro-batch is stored under its own batch
number, so a batch that is run again after a failure replaces itself. Entities are never
deduplicated: repeated entities are a signal the marts count.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import labels as L
from fleetgauge.operators.assertions import row_metrics
from fleetgauge.plans.checks import CHECKS
from fleetgauge.plans.load import with_date
from fleetgauge.plans.models import Models, store_keys
from fleetgauge.session import together
from fleetgauge.sources.schedule import path_exists
from fleetgauge.sources.snapshots import (
    RAW_SCHEMAS,
    empty_source_schema,
    parse_snapshot_files,
    with_snapshot_date,
)
from fleetgauge.sources.tables import child_names, put_text, remove_folder, replace_sink, replace_snapshots

# Findings read the two marts before them.
STREAMED_MARTS = (
    "fct_feed_quality",
    "fct_on_time_performance",
    "fct_route_realtime_activity",
    "fct_headway",
    "fct_anomaly_findings",
)


# The small table of stored snapshots.
_STATE = "snapshots"
_STATE_SCHEMA = (
    T.StructType()
    .add("snapshot_folder", "string")
    .add("snapshot_timestamp_utc", "timestamp")
    .add("batch_id", "long")
    .add("snapshot_date", "string")
)
_SEEN = "snapshots of the batch"
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Below it, a file a batch: the snapshots whose marts a catch-up has still to refresh, with their capture times.
_PENDING = "pending"
_NOTE = {"snapshot_date": "string", "snapshot_folder": "string", "taken": "string", "batch_id": "bigint"}
# Below it, what the marts of one refresh share; it goes with the refresh.
_KEYS = "keys"
#: Snapshots that a catch-up refreshes at once.
REFRESHED_AT_ONCE = 2_000


def _day(snapshot: str) -> str:
    return snapshot.removeprefix(L.SNAPSHOT_PREFIX)[:8]


def _place(snapshot: str) -> str:
    return f"snapshot_date={_day(snapshot)}/snapshot_folder={snapshot}"


# Both feeds of a snapshot as the capture leaves them.
CAPTURE_PATTERN = f"{L.SNAPSHOT_PREFIX}*/{{{L.VEHICLE_FEED},{L.TRIP_UPDATE_FEED}}}.json"


def snapshot_files(
    spark: SparkSession, root: str, *, pattern: str = CAPTURE_PATTERN, max_files: int = 200
) -> DataFrame:
    """Stream of the snapshot files of both feeds, each as one text."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    files = reader.text(f"{root.rstrip('/')}/{pattern}", wholetext=True)
    return files.select("value", "_metadata")


def stream_records(spark: SparkSession, root: str, feed: str, **options) -> DataFrame:
    """Stream of the raw records of one feed."""
    return parse_snapshot_files(_of_feed(snapshot_files(spark, root, **options), feed), feed)


def _of_feed(files: DataFrame, feed: str) -> DataFrame:
    # .../<feed>.json, or any file of a folder <feed>
    return files.where(F.col("_metadata.file_path").rlike(rf"/{feed}(\.json$|/)"))


def windowed_record_counts(
    records: DataFrame, *, window: str = "10 minutes", lateness: str = "30 minutes"
) -> DataFrame:
    """Records per feed and time window, final once the watermark has passed the window.

    Records that arrive behind the watermark are left out of the counts, not out of the store.
    """
    taken_at = F.col("snapshot_timestamp_utc").cast("timestamp")
    counted = (
        records.withColumn("taken_at", taken_at)
        .withWatermark("taken_at", lateness)
        .groupBy(F.window("taken_at", window).alias("window"), "feed_type")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "feed_type",
        "record_count",
    )


@dataclass
class SnapshotStore:
    """Raw records and marts of the snapshots seen so far, as parquet below ``folder``.

    Everything is partitioned by day and snapshot. Beside it stands a small table, ``snapshots``, of each stored
    snapshot's feeds and capture times, a file a day. It tells a batch which snapshots come before and after
    its own, so neither records nor file names of any others are looked at.
    """

    spark: SparkSession
    folder: str
    schedule: Mapping[str, DataFrame | Callable[[], DataFrame]]
    options: Mapping[str, object] = field(default_factory=dict)
    #: Of the last batch, by feed: rows that violate the declared checks, counted while they were stored.
    violations: dict[str, dict[str, int]] = field(default_factory=dict)

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def records(self, feed: str, snapshots: Iterable[str] | None = None) -> DataFrame:
        """Stored raw records with their ``snapshot_date``, of all snapshots or of some."""
        columns = with_date(RAW_SCHEMAS[feed])
        stored = self._read(feed, columns.add("batch_id", "long"), snapshots)
        if stored is None:
            return with_snapshot_date(empty_source_schema(self.spark, feed))
        return stored.select(*RAW_SCHEMAS[feed].names, "snapshot_date")

    def mart(self, name: str, snapshots: Iterable[str] | None = None) -> DataFrame:
        """A mart as far as it is built, whole or of some snapshots; without any row an empty table."""
        columns = Models({**self.schedule, **{feed: empty_source_schema(self.spark, feed) for feed in RAW_SCHEMAS}}, **self.options)
        fields = [f for f in columns[name].schema.fields if f.name != "snapshot_date"]
        schema = T.StructType(fields).add("snapshot_date", "string")
        stored = self._read(name, schema, snapshots)
        return self.spark.createDataFrame([], schema) if stored is None else stored.select(*schema.names)

    def _read(self, name: str, schema: T.StructType, snapshots: Iterable[str] | None) -> DataFrame | None:
        reader, path = self.spark.read.schema(schema), self._path(name)
        if snapshots is not None:
            # Naming the folders spares the listing of all others.
            paths = [f"{path}/{place}" for place in sorted(map(_place, snapshots))]
            paths = [place for place in paths if path_exists(self.spark, place)]
            return reader.option("basePath", path).parquet(*paths) if paths else None
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _known(self, days: Iterable[str]) -> set[tuple]:
        """(day, snapshot, capture time or None, batch) of the stored snapshots of some days."""
        path = self._path(_STATE)
        paths = [f"{path}/snapshot_date={day}" for day in sorted(days)]
        paths = [place for place in paths if path_exists(self.spark, place)]
        if not paths:
            return set()
        rows = self.spark.read.schema(_STATE_SCHEMA).option("basePath", path).parquet(*paths).collect()
        return {(row.snapshot_date, row.snapshot_folder, row.snapshot_timestamp_utc, row.batch_id) for row in rows}

    def add(self, files: DataFrame, batch_id: int, *, refresh: bool = True) -> None:
        """Store one batch of snapshot files and refresh the marts of the snapshots it touches.

        Without ``refresh`` these are noted beside the records, for ``refresh_pending``.
        """
        # Each feed's tasks are few and short, and a capture as a rule leaves files of one feed at a time.
        stored = together(self.spark, *(partial(self._store, files, feed, batch_id) for feed in RAW_SCHEMAS))
        added = set().union(*stored)
        if added and refresh:
            self._remember(added)
            self.refresh({snapshot for _, snapshot, _, _ in added})
        elif added:
            notes = [json.dumps(dict(zip(_NOTE, row, strict=True))) for row in sorted(added)]
            put_text(self.spark, f"{self._path(_PENDING)}/batch-{batch_id}", "\n".join(notes))

    def _store(self, files: DataFrame, feed: str, batch_id: int) -> set[tuple]:
        """Store one feed of a batch; returns (day, snapshot, capture time as text, batch) of what it holds."""
        records = with_snapshot_date(parse_snapshot_files(_of_feed(files, feed), feed))
        # As text, which generated code does not contain: a number in it would have every batch compile its code again.
        numbered = records.withColumn("batch_id", F.lit(str(batch_id)))
        # A batch has a bounded number of files, and so of snapshots, each with few capture times.
        seen = F.collect_set(F.concat_ws("|", "snapshot_date", "snapshot_folder", "snapshot_timestamp_utc"))
        checks = row_metrics(CHECKS[feed])
        found: dict = {}
        replace_sink(
            numbered,
            self._path(feed),
            as_path=True,
            partition_by=("snapshot_date", "snapshot_folder", "batch_id"),
            only_touched_partitions=True,
            metrics={**checks, _SEEN: F.array_join(F.sort_array(seen), ",")},
            measured=found,
        )
        snapshots = found.pop(_SEEN)
        self.violations[feed] = found
        return {(*(text + "|").split("|")[:3], batch_id) for text in (snapshots or "").split(",") if text}

    def _remember(self, added: Iterable[tuple]) -> None:
        """Add the snapshots of batches to the small table; a batch that runs again replaces its rows."""
        days, batches = {day for day, _, _, _ in added}, {batch for _, _, _, batch in added}
        kept = [row for row in self._known(days) if row[3] not in batches]
        new = self.spark.createDataFrame(
            [(snapshot, time or None, batch, day) for day, snapshot, time, batch in sorted(added)],
            "snapshot_folder string, taken string, batch_id bigint, snapshot_date string",
        ).withColumn("snapshot_timestamp_utc", F.col("taken").try_cast("timestamp"))
        new = new.select(*_STATE_SCHEMA.names)
        old = self.spark.createDataFrame([(folder, time, batch, day) for day, folder, time, batch in kept], _STATE_SCHEMA)
        rows = old.union(new).coalesce(1)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("snapshot_date").parquet(self._path(_STATE))

    def _noted(self) -> tuple[list[str], set[tuple]]:
        """The files of the notes, and their rows as ``_remember`` takes them."""
        path = self._path(_PENDING)
        notes = [f"{path}/batch-{batch}" for batch in child_names(self.spark, path, "batch-")]
        if not notes:
            return [], set()
        schema = ", ".join(f"{name} {kind}" for name, kind in _NOTE.items())
        return notes, {tuple(row) for row in self.spark.read.schema(schema).json(notes).collect()}

    def refresh(self, snapshots: Iterable[str]) -> None:
        """Rebuild the marts of ``snapshots`` and of the stored snapshot after each.

        A snapshot's gap ends at the one before it, so one that arrives late changes its successor. The times of
        those before come from the small table; only the records of the rebuilt ones are read.
        """
        touched = set(snapshots)
        # Those that a catch-up has stored are in the order of times, also while their own marts are to come.
        _, noted = self._noted()
        if noted:
            self._remember(noted)
        days = sorted(child_names(self.spark, self._path(_STATE), "snapshot_date="))
        place = {day: at for at, day in enumerate(days)}
        near = {days[at] for day in map(_day, touched) for at in range(place[day] - 1, place[day] + 2) if 0 <= at < len(days)}
        times = {(time, snapshot) for _, snapshot, time, _ in self._known(near)}
        in_order = sorted(times, key=lambda row: (row[0] is None, row[0] or datetime.min, row[1]))
        after = {late[1] for early, late in zip(in_order, in_order[1:], strict=False) if early[1] in touched}
        rebuilt = touched | after

        others = [(snapshot, time) for time, snapshot in in_order if snapshot not in rebuilt]
        known = self.spark.createDataFrame(others, "snapshot_folder string, snapshot_timestamp_utc timestamp")
        raw = {feed: self.records(feed, rebuilt) for feed in RAW_SCHEMAS}
        models = Models({**self.schedule, **raw}, **self.options, known_snapshots=known)

        def rebuild(*names: str) -> None:
            for name in names:
                rows = with_snapshot_date(models[name])
                replace_snapshots(rows, self._path(name), rebuilt)
                models.stored[name] = self.mart(name, rebuilt)

        def rebuild_quality() -> None:
            # The findings read the keys too: both marts share one pass over the feeds.
            store_keys(models, keys)
            rebuild("fct_feed_quality")

        keys = self._path(_KEYS)
        on_time = partial(rebuild, "fct_on_time_performance")
        together(self.spark, on_time, rebuild_quality, partial(rebuild, "fct_route_realtime_activity", "fct_headway"))
        rebuild("fct_anomaly_findings")
        remove_folder(self.spark, keys)

    def refresh_pending(self) -> None:
        """Refresh the marts of all snapshots that were stored without it, in order of time.

        Their notes go when the marts stand, so what a failure leaves undone is done by the next call.
        """
        notes, rows = self._noted()
        touched = sorted({snapshot for _, snapshot, _, _ in rows})
        for start in range(0, len(touched), REFRESHED_AT_ONCE):
            self.refresh(touched[start : start + REFRESHED_AT_ONCE])
        for note in notes:
            remove_folder(self.spark, note)

    def catch_up(self, root: str, checkpoint: str, **options) -> None:
        """Store what has piled up in a capture folder, batch by batch, then refresh the marts of it once.

        A refresh looks up the whole schedule and rebuilds each touched snapshot, which as a rule has files in several
        batches of a backlog: one a batch would take the time of batches times schedule. ``options`` are those of ``follow``.
        """
        # By default a batch starts a task for each of its files to list it; one a core does.
        before, cores = self.spark.conf.get(_LISTING_TASKS), self.spark.sparkContext.defaultParallelism
        self.spark.conf.set(_LISTING_TASKS, min(int(before), cores))
        try:
            self.follow(root, checkpoint, refresh=False, availableNow=True, **options).awaitTermination()
        finally:
            self.spark.conf.set(_LISTING_TASKS, before)
        self.refresh_pending()

    def follow(
        self,
        root: str,
        checkpoint: str,
        *,
        pattern: str = CAPTURE_PATTERN,
        max_files: int = 200,
        refresh: bool = True,
        **trigger,
    ) -> StreamingQuery:
        """Start following a capture folder; ``trigger`` as for a stream writer, ``refresh`` as for ``add``."""
        files = snapshot_files(self.spark, root, pattern=pattern, max_files=max_files)
        return (
            files.writeStream.foreachBatch(lambda files, batch_id: self.add(files, batch_id, refresh=refresh))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
