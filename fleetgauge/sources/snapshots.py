"""Realtime snapshots: folders ``snapshot_YYYYmmdd_HHMMSS`` with one JSON array per feed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.functions import number_from_json
from fleetgauge.labels import SNAPSHOT_PREFIX, TRIP_UPDATE_FEED, VEHICLE_FEED
from fleetgauge.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS

RAW_SCHEMAS = {VEHICLE_FEED: RAW_VEHICLE_POSITIONS, TRIP_UPDATE_FEED: RAW_TRIP_UPDATES}

# Folder of the file: .../snapshot_x/<file>, or .../snapshot_folder=snapshot_x/<file>.
_FOLDER_IN_PATH = r"[/=](snapshot_[^/=]+)/[^/=]+$"


def snapshot_lineage(path: Column) -> Column:
    """Snapshot folder name out of a file path."""
    return F.regexp_extract(path, _FOLDER_IN_PATH, 1)


def snapshot_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the snapshots from ``start`` to ``end``, both included and both optional.

    Folder names sort like their times. On a table partitioned by ``snapshot_date`` the same
    bounds also select partitions, so files outside the range are never opened.
    """
    for bound, name in ((start, "start"), (end, "end")):
        if bound is None:
            continue
        folder = F.col("snapshot_folder")
        df = df.where(folder >= bound if name == "start" else folder <= bound)
        day = bound.removeprefix(SNAPSHOT_PREFIX)[:8]
        if "snapshot_date" in df.columns and len(day) == 8 and day.isdigit():
            date = F.col("snapshot_date")
            df = df.where(date >= day if name == "start" else date <= day)
    return df


def _read_files(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.text(location, wholetext=True)


def parse_snapshot_files(files: DataFrame, feed: str) -> DataFrame:
    """Records of snapshot files given as whole texts (batch or stream).

    A file is one poll of one feed, so it fits a row. One pass checks the shape, parses and
    explodes. Fields are read as text and cast leniently: one odd value costs that value,
    not the record. A file that is no JSON array fails the query.
    """
    schema = RAW_SCHEMAS[feed]
    text_fields = [f.name for f in schema.fields if f.name != "snapshot_folder"]
    as_text = T.ArrayType(T.StructType([T.StructField(name, T.StringType()) for name in text_fields]))
    path = F.col("_metadata.file_path")
    content = F.when(F.ltrim("value", F.lit(" \t\r\n")).startswith("["), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("Expected a list of records in "), path))
    )
    records = files.select(
        snapshot_lineage(path).alias("snapshot_folder"),
        F.explode(F.from_json(content, as_text, {"mode": "FAILFAST"})).alias("record"),
    )

    def typed(field: T.StructField) -> Column:
        text = F.col("record")[field.name]
        if isinstance(field.dataType, T.LongType):
            return number_from_json(text, "bigint").alias(field.name)
        return text.try_cast(field.dataType).alias(field.name)

    return records.select(
        *[typed(f) for f in schema.fields if f.name != "snapshot_folder"], "snapshot_folder"
    )


def empty_source_schema(spark: SparkSession, feed: str) -> DataFrame:
    """Typed table without rows, for a capture folder without snapshots."""
    return spark.createDataFrame([], RAW_SCHEMAS[feed])


def scan_snapshots(
    spark: SparkSession,
    root: str,
    feed: str,
    *,
    start: str | None = None,
    end: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Records of one feed over all snapshot folders under ``root``; none gives a typed empty table.

    Snapshots without a file of this feed add nothing. The range is applied to file paths
    before any file is parsed.
    """
    location = f"{root.rstrip('/')}/{pattern or f'{SNAPSHOT_PREFIX}*/{feed}.json'}"
    try:
        files = _read_files(spark, location)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty_source_schema(spark, feed)
        raise
    folder = snapshot_lineage(F.col("_metadata.file_path"))
    if start is not None:
        files = files.where(folder >= start)
    if end is not None:
        files = files.where(folder <= end)
    return parse_snapshot_files(files, feed)


def nested_to_json(df: DataFrame, name: str = "stop_time_updates") -> DataFrame:
    """Native stop update array as compact JSON text; an absent list stays NULL."""
    return df.withColumn(name, F.to_json(name, {"ignoreNullFields": "false"}))


def with_snapshot_date(df: DataFrame) -> DataFrame:
    """Add ``snapshot_date`` (yyyyMMdd text), the partition column of stored snapshots.

    One partition per day keeps the file count in proportion to the data; one per snapshot
    would make hundreds of tiny directories a day.
    """
    return df.withColumn("snapshot_date", F.substring("snapshot_folder", len(SNAPSHOT_PREFIX) + 1, 8))


#: Consecutive rows that are dealt to snapshots together when files are written.
RUN_ROWS = 1 << 16


def _even_slices(array: Column, most: int) -> Column:
    """An array that is not empty cut into the fewest slices of at most ``most`` elements, of nearly equal size."""
    size = F.size(array)
    number = F.ceil(size / F.lit(most)).cast("int")
    begin = lambda at: F.floor(at.cast("bigint") * size / number).cast("int")
    slices = F.transform(F.sequence(F.lit(0), number - 1), lambda at: F.slice(array, begin(at) + 1, begin(at + 1) - begin(at)))
    return slices


def write_snapshot_arrays(df: DataFrame, path: str, *, max_records: int = 1000) -> None:
    """Write records as JSON array files below ``path``, one folder per snapshot.

    Rows are grouped by snapshot and by runs of at most ``RUN_ROWS`` rows of one input partition, so no
    group grows with the data. A group is cut evenly into files of at most ``max_records``, so a large snapshot becomes
    many files, none of them small for the other snapshots in its run.
    """
    run = F.floor(F.monotonically_increasing_id() / F.lit(RUN_ROWS))
    fields = [name for name in df.columns if name != "snapshot_folder"]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    arrays = (
        df.select("snapshot_folder", run.alias("run"), record.alias("record"))
        .groupBy("snapshot_folder", "run")
        .agg(F.collect_list("record").alias("records"))
        .select("snapshot_folder", F.explode(_even_slices(F.col("records"), max_records)).alias("records"))
        .select(
            "snapshot_folder",
            F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")).alias("value"),
        )
    )
    # A file is read whole in any case, so it may as well be compressed.
    writer = arrays.write.options(maxRecordsPerFile=1, compression="gzip").partitionBy("snapshot_folder")
    writer.mode("overwrite").text(path)
