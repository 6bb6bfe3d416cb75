"""Schedule files: one CSV table per file and feed, every column text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.labels import OPTIONAL_TABLES, REQUIRED_TABLES, SCHEDULE_FEEDS, SINGLE_FEED
from fleetgauge.schemas import SCHEDULE_COLUMNS
from fleetgauge.sources.quoted_csv import has_quoted_breaks, scan_quoted_csv


def scan_static_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One schedule table as text columns; blank cells stay ``''``.

    Column names come from the header line, so a file's extra or reordered columns are read
    by name. All files in ``paths`` must share that header; one that does not fails the scan, and
    ``union_feeds_by_name`` over scans of their own reads such files. Quoted cells may hold line breaks. Files of
    stop times are large and stay splittable: they are looked through for such breaks first, and with
    them are read by ``scan_quoted_csv``. There a row with too few or too many cells fails the scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    splittable = all(path.rstrip("/").endswith("/stop_times.txt") for path in paths)
    if splittable and has_quoted_breaks(spark, paths):
        return scan_quoted_csv(spark, paths)
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
    reader = reader.option("enforceSchema", False).option("multiLine", not splittable)
    return reader.option("mode", "FAILFAST" if splittable else "PERMISSIVE").csv(paths).na.fill("")


def tag_source_feed(df: DataFrame, feed: str | Column) -> DataFrame:
    return df.withColumn("source_feed", F.lit(feed) if isinstance(feed, str) else feed)


def union_feeds_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack one table over feeds; a column some feed lacks is NULL for its rows."""
    if not frames:
        raise ValueError("no feed has this table")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; a file system that cannot be reached raises."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def feeds_beside(spark: SparkSession, above: str) -> list[str]:
    """Names of the folders below ``above`` that have an ``extracted`` folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{above}/*/extracted")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().getParent().getName() for status in found or [])


def resolve_feed_layout(
    spark: SparkSession, root: str, *, feeds: Sequence[str] = SCHEDULE_FEEDS
) -> dict[str, str]:
    """Feed name -> folder. Per-feed folders win over the one flat folder; neither gives {}.

    ``root`` is either the folder above the feeds or the flat ``extracted`` folder itself. A feed folder
    that ``feeds`` does not list is an error, so that no feed is left out unseen.
    """
    root = root.rstrip("/")
    parent, _, last = root.rpartition("/")
    above = parent if last == "extracted" else root
    present = feeds_beside(spark, above)
    unlisted = sorted(set(present) - set(feeds))
    if unlisted:
        raise ValueError(f"feed folders that are not listed below {above}: {', '.join(unlisted)}")
    found = {feed: f"{above}/{feed}/extracted" for feed in feeds if feed in present}
    if found:
        return found
    return {SINGLE_FEED: root} if path_exists(spark, root) else {}


def list_schedule_files(spark: SparkSession, layout: Mapping[str, str]) -> DataFrame:
    """(source_feed, table_name, path) of every schedule table present."""
    rows = [
        (feed, table, f"{folder}/{table}.txt")
        for feed, folder in layout.items()
        for table in REQUIRED_TABLES + OPTIONAL_TABLES
        if path_exists(spark, f"{folder}/{table}.txt")
    ]
    return spark.createDataFrame(rows, "source_feed string, table_name string, path string")


def missing_required_tables(
    present: DataFrame, feeds: Sequence[str], required: Sequence[str] = REQUIRED_TABLES
) -> DataFrame:
    """(source_feed, table_name) pairs that a feed must have and lacks."""
    wanted = present.sparkSession.createDataFrame(
        [(feed, table) for feed in feeds for table in required],
        "source_feed string, table_name string",
    )
    return wanted.join(present, ["source_feed", "table_name"], "left_anti")


def check_required_tables(spark: SparkSession, layout: Mapping[str, str]) -> None:
    """Raise if a feed lacks a required file, naming the feed and the files."""
    for feed, folder in layout.items():
        missing = [t for t in REQUIRED_TABLES if not path_exists(spark, f"{folder}/{t}.txt")]
        if missing:
            files = ", ".join(f"{table}.txt" for table in missing)
            raise FileNotFoundError(f"schedule of feed {feed!r} lacks {files} below {folder}")


def load_schedule(
    spark: SparkSession, root: str, *, feeds: Sequence[str] = SCHEDULE_FEEDS
) -> dict[str, DataFrame]:
    """All schedule tables under ``root``, tagged with their feed; absent optional ones are left out.

    Feeds are stacked by name. The number of feeds is fixed and small; each scan is distributed.
    """
    layout = resolve_feed_layout(spark, root, feeds=feeds)
    check_required_tables(spark, layout)
    tables: dict[str, DataFrame] = {}
    for table in REQUIRED_TABLES + OPTIONAL_TABLES:
        frames = [
            tag_source_feed(scan_static_csv(spark, f"{folder}/{table}.txt"), feed)
            for feed, folder in layout.items()
            if table in REQUIRED_TABLES or path_exists(spark, f"{folder}/{table}.txt")
        ]
        if frames:
            tables[table] = with_schedule_columns(union_feeds_by_name(frames), table)
    return tables


def with_schedule_columns(df: DataFrame, table: str) -> DataFrame:
    """Add the columns staging reads and no feed has, as NULL text."""
    absent = [name for name in SCHEDULE_COLUMNS[table] if name not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(name) for name in absent])


def feed_from_path(path: Column, table: str) -> Column:
    """Feed name out of ``.../<feed>/extracted/<table>.txt`` paths read in one scan."""
    return F.regexp_extract(path, rf"/([^/]+)/extracted/{re.escape(table)}\.txt", 1)


def empty_schedule_table(spark: SparkSession, table: str) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in (*SCHEDULE_COLUMNS[table], "source_feed")]
    return spark.createDataFrame([], T.StructType(fields))
