"""Large CSV files whose quoted cells may hold line breaks, read by many tasks.

A splittable scan cuts a file at line ends, and a line end inside quotes ends no record. Whether one does is
a matter of parity: an odd number of quotes before it means that a cell is open. Every split counts
its quotes by itself; running sums over the splits, one row each, tell how a split begins, and
running sums within a split do the rest. Only lines of records that go on are then gathered, by record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["file", "block"]


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Physical lines with their split and their order in it; ``odd`` is 1 if the number of quotes is odd."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
        (quotes % 2).alias("odd"),
    )


def _quotes_of_splits(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_SPLIT).agg(F.sum("odd").alias("odd_lines"))


def has_quoted_breaks(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether a quoted cell holds a line break. A file whose quotes do not pair up raises.

    Looks at quotes alone, a pass of its own; one row a file with such cells is gathered.
    """
    files = _quotes_of_splits(_lines(spark, paths)).groupBy("file").agg(F.sum("odd_lines").alias("odd_lines"))
    found = files.where("odd_lines > 0").agg(
        F.count(F.lit(1)).alias("files"), F.min(F.when(F.col("odd_lines") % 2 == 1, F.col("file"))).alias("unpaired")
    ).first()
    if found.unpaired is not None:
        raise ValueError(f"a quoted cell does not end in {found.unpaired}")
    return found.files > 0


def _splits(lines: DataFrame) -> DataFrame:
    """A row a split: a number for it and for its file, the odd lines of the file before it, and where its own are."""
    odd_place = F.when(F.col("odd") == 1, F.col("place"))
    counted = lines.groupBy(*_SPLIT).agg(
        F.sum("odd").alias("odd_lines"),
        F.min("place").alias("first_place"),
        F.min(odd_place).alias("first_odd"),
        F.max(odd_place).alias("last_odd"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("odd_lines").over(before), F.lit(0))
    numbered = counted.withColumn("earlier", earlier).withColumn("split", F.monotonically_increasing_id())
    return numbered.withColumn("file_number", F.min("split").over(Window.partitionBy("file")))


def _records(spark: SparkSession, paths: Sequence[str], *kept: str) -> DataFrame:
    """(record) for ``quoted_records``, with the columns ``kept`` of the splits.

    Lines meet the few splits without a shuffle and leave their paths there, so that what is dealt and sorted is
    little more than their text. It is dealt by split once, and records are put together there. Only the lines of a
    record that goes over the end of a split are gathered by file; between the last odd line of a split and the first
    of the next, they are known without an order.
    """
    lines = _lines(spark, paths)
    splits = F.broadcast(_splits(lines))
    begins_open, ends_open = F.col("earlier") % 2 == 1, (F.col("earlier") + F.col("odd_lines")) % 2 == 1
    head = begins_open & (F.col("first_odd").isNull() | (F.col("place") <= F.col("first_odd")))
    tail = ends_open & F.coalesce(F.col("place") >= F.col("last_odd"), F.lit(False))
    is_header = (F.col("block") == 0) & (F.col("place") == F.col("first_place"))
    placed = lines.join(splits, _SPLIT)

    # A record over splits is known by the number of odd lines up to its first one.
    goes_on = F.when(head, F.col("earlier")).otherwise(F.col("earlier") + F.col("odd_lines"))
    over = placed.where((head | tail) & ~is_header).select("file_number", "split", "block", "place", "value", goes_on.alias("goes_on"), *kept)
    text = F.array_join(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).getField("value"), "\n")
    over = over.groupBy("file_number", "goes_on", *kept).agg(text.alias("record"))

    # All others begin and end in one split, whose first one begins outside of quotes.
    dealt = placed.where(~(head | tail)).select("split", "place", (F.col("odd") + F.when(is_header, 2).otherwise(0)).alias("marks"), "value", *kept)
    within = Window.partitionBy("split").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = F.col("marks") % 2
    inside = dealt.withColumn("so_far", F.sum(odd).over(within) - odd).where("marks < 2")
    is_open, blank = F.col("so_far") % 2 == 1, F.trim(F.rtrim("value", F.lit("\r"))) == ""
    number = F.when(is_open, F.col("so_far")).when(odd == 1, F.col("so_far") + 1).otherwise(-1 - F.col("place"))
    whole = (
        inside.where(is_open | ~blank)
        .groupBy("split", number.alias("number"), *kept)
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("place", "value"))).getField("value"), "\n").alias("record"))
    )
    return whole.select(*kept, "record").union(over.select(*kept, "record"))


def quoted_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, record): the records of CSV files without their header, line breaks within cells kept.

    The quotes of every file pair up, see ``has_quoted_breaks``. Blank lines between records are no records.
    """
    return _records(spark, paths, "file")


def scan_quoted_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Text columns of CSV files that share a header line, whose quoted cells may hold line breaks.

    A row with too few or too many cells fails the scan, and so does a file with another header.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
    names = reader.option("enforceSchema", False).csv(list(paths)).columns
    firsts = _first_lines(spark, paths)
    others = firsts.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if len(others) > 1:
        raise ValueError(f"{others[1].file} has another header than {others[0].file}")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    record = F.rtrim("record", F.lit("\r"))
    parsed = F.from_csv(record, schema, {"escape": '"', "mode": "FAILFAST"})
    return _records(spark, paths).select(parsed.alias("cells")).select("cells.*").na.fill("")


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, header), a row a file."""
    first = _lines(spark, paths).where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return first.withColumn("header", F.rtrim(F.ltrim("header", F.lit("\ufeff")), F.lit("\r")))
