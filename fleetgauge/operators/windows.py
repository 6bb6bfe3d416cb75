"""Ordered operators that stay distributed when a group, or the whole table, is one sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows without a time come last, after every dated bucket.
_NO_TIME = 1 << 40
# No bucket of a timestamp, nor that of the rows without one.
_FIRST_ROWS = 1 << 41
# Seconds that a timestamp can hold have 14 digits, and so their squares fit with any count.
_WIDE = "decimal(38,0)"


def _square(seconds: Column) -> Column:
    return (seconds.cast("decimal(19,0)") * seconds.cast("decimal(19,0)")).cast(_WIDE)


def previous_time(
    df: DataFrame, time: str, alias: str, *, tie_break: str, bucket_seconds: int = 86_400
) -> DataFrame:
    """Time of the preceding row in (time, tie_break) order over the whole table, NULLs last.

    A window without partitions would put the table into one task. Here each time bucket is
    ordered by itself; only the first rows of the buckets, one a bucket, are then ordered together, each
    with the end of its bucket. ``df`` is read once.
    """
    # Before 1970 buckets are negative and still in order.
    bucket = F.coalesce(F.floor(F.unix_seconds(time) / bucket_seconds), F.lit(_NO_TIME))
    whole = Window.partitionBy("time_bucket")
    inside = whole.orderBy(F.col(time).asc_nulls_last(), F.col(tie_break).asc_nulls_last())
    # First rows share a partition; every other row stays with its bucket.
    lead = F.when(F.col("is_first"), F.lit(_FIRST_ROWS)).otherwise(F.col("time_bucket"))
    carried = F.lag("bucket_end").over(Window.partitionBy(lead).orderBy("time_bucket"))
    return (
        df.withColumn("time_bucket", bucket)
        .withColumns(
            {
                "within": F.lag(time).over(inside),
                "is_first": F.row_number().over(inside) == 1,
                "bucket_end": F.max(time).over(whole),
            }
        )
        .withColumn("carried", carried)
        .withColumn(alias, F.when(F.col("is_first"), F.col("carried")).otherwise(F.col("within")))
        .drop("time_bucket", "within", "is_first", "bucket_end", "carried")
    )


def occurrence_number(df: DataFrame, key: str, alias: str, *, groups: int = 64) -> DataFrame:
    """Number the rows of each ``key`` from 1, in an order that depends on the rows alone.

    A window over the key would hold a key with most rows in one task. Here a key's rows are dealt into ``groups``
    by their content and numbered there; the groups' sizes, one row each, are summed up in order and
    added. Equal rows are interchangeable; a NULL key is a key.
    """
    content = F.xxhash64(*df.columns)
    own = [key, "row_group"]
    inside = Window.partitionBy(*own).orderBy("row_content")
    grouped = df.withColumn("row_content", content).withColumn("row_group", F.pmod("row_content", F.lit(groups)))
    grouped = grouped.withColumns(
        {"within": F.row_number().over(inside), "group_rows": F.count(F.lit(1)).over(Window.partitionBy(*own))}
    )
    # The first rows of a key's groups share a partition; every other row stays with its group.
    lead = F.when(F.col("within") == 1, F.lit(-1)).otherwise(F.col("row_group"))
    earlier = Window.partitionBy(key, lead).orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    summed = grouped.withColumn("earlier_rows", F.when(F.col("within") == 1, F.coalesce(F.sum("group_rows").over(earlier), F.lit(0))))
    number = F.col("within") + F.max("earlier_rows").over(Window.partitionBy(*own))
    return summed.withColumn(alias, number).select(*df.columns, alias)


def gap_statistics(df: DataFrame, keys: list[str], time: str, *, bucket_seconds: int = 3_600) -> DataFrame:
    """Gaps between successive whole-second times of each group, as exact seconds.

    Columns: first_second, last_second, gap_count, min_gap, max_gap, gap_square_sum. Rows without
    a time are ignored.

    A window over the group would hold all its rows in one task, and a group may be a third of
    the table. Only the set of seconds matters for the gaps (equal times give gaps of zero,
    which the count of rows tells), and an hour has 3,600 of them: partial aggregation reduces any
    number of rows to one bounded set per group and hour. The hours of a group are then joined
    end to start; there are as many as its times span.
    """
    second = F.unix_seconds(time)
    hour = F.floor(second / bucket_seconds)
    within_hour = (second - hour * bucket_seconds).cast("int")
    hours = df.where(F.col(time).isNotNull()).groupBy(*keys, hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("times"),
        F.sort_array(F.collect_set(within_hour)).alias("seconds"),
    )
    size = F.size("seconds")
    steps = F.when(
        size > 1,
        F.zip_with(
            F.slice("seconds", F.lit(2), size - 1),
            F.slice("seconds", F.lit(1), size - 1),
            lambda later, earlier: (later - earlier).cast("bigint"),
        ),
    )
    start = F.col("hour") * bucket_seconds
    summed = hours.withColumn("steps", steps).select(
        *keys,
        "times",
        "hour",
        (start + F.array_min("seconds")).alias("first_second"),
        (start + F.array_max("seconds")).alias("last_second"),
        (F.col("times") > size).alias("has_ties"),
        F.array_min("steps").alias("min_step"),
        F.array_max("steps").alias("max_step"),
        F.coalesce(
            F.aggregate("steps", F.lit(0).cast("bigint"), lambda total, step: total + step * step),
            F.lit(0).cast("bigint"),
        ).alias("step_squares"),
    )
    in_order = Window.partitionBy(*keys).orderBy("hour")
    bridge: Column = F.col("first_second") - F.lag("last_second").over(in_order)
    tie = F.when(F.col("has_ties"), F.lit(0).cast("bigint"))
    return (
        summed.withColumn("bridge", bridge)
        .groupBy(*keys)
        .agg(
            F.min("first_second").alias("first_second"),
            F.max("last_second").alias("last_second"),
            (F.sum("times") - 1).alias("gap_count"),
            F.min(F.least(F.col("min_step"), F.col("bridge"), tie)).alias("min_gap"),
            F.max(F.greatest(F.col("max_step"), F.col("bridge"), tie)).alias("max_gap"),
            # One timestamp in another unit makes a gap of millennia, whose square passes 64 bits.
            F.sum(F.col("step_squares").cast(_WIDE) + F.coalesce(_square(F.col("bridge")), F.lit(0).cast(_WIDE))).alias(
                "gap_square_sum"
            ),
        )
    )
