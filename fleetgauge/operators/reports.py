"""Report queries over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import labels as L

def _rows() -> Column:
    return F.count(F.lit(1))


def _top(df: DataFrame, rows: int, *order: Column, ties: tuple[str, ...]) -> DataFrame:
    """First ``rows`` rows; ``ties`` complete the order so that equal rows come out the same."""
    return df.orderBy(*order, *[F.col(name).asc_nulls_last() for name in ties]).limit(rows)


def _most_frequent(df: DataFrame, keys: list[str], alias: str) -> DataFrame:
    counted = df.groupBy(*keys).agg(_rows().alias(alias))
    return counted.orderBy(F.col(alias).desc(), *[F.col(key).asc_nulls_last() for key in keys])


def kpi_snapshots(feed_quality: DataFrame) -> DataFrame:
    return feed_quality.agg(_rows().alias("snapshot_count"))


def kpi_findings(findings: DataFrame) -> DataFrame:
    return findings.agg(_rows().alias("finding_count"))


def kpi_priority_findings(findings: DataFrame) -> DataFrame:
    urgent = F.col("anomaly_severity").isin("critical", "high")
    return findings.agg(F.count_if(urgent).alias("priority_finding_count"))


def kpi_avg_plausible_delay(on_time_performance: DataFrame) -> DataFrame:
    plausible = on_time_performance.where(F.col("delay_sanity_status") == L.PLAUSIBLE)
    return plausible.agg(F.avg("estimated_delay_minutes").alias("avg_plausible_delay_minutes"))


def kpi_match_rate(on_time_performance: DataFrame) -> DataFrame:
    matched = F.count_if(F.col("schedule_match_status") == L.MATCHED).cast("double")
    return on_time_performance.agg(F.try_divide(matched, _rows()).alias("match_rate"))


def findings_by_type(findings: DataFrame) -> DataFrame:
    return _most_frequent(findings, ["anomaly_type"], "finding_count")


def feed_status_counts(feed_quality: DataFrame) -> DataFrame:
    return _most_frequent(feed_quality, ["feed_quality_status"], "snapshot_count")


def feed_quality_trend(feed_quality: DataFrame) -> DataFrame:
    return feed_quality.select(
        "snapshot_timestamp_utc",
        "snapshot_folder",
        "feed_quality_status",
        "null_gps_rate",
        "duplicate_trip_update_rate",
        "unmatched_realtime_trip_rate",
        "vehicle_record_count",
        "trip_update_record_count",
    ).orderBy(F.col("snapshot_timestamp_utc").asc_nulls_last(), "snapshot_folder")


def feed_quality_avg_rates(feed_quality: DataFrame) -> DataFrame:
    rates = ("null_gps_rate", "duplicate_trip_update_rate", "unmatched_realtime_trip_rate")
    return feed_quality.agg(*[F.avg(rate).alias(f"avg_{rate}") for rate in rates])


def findings_by_type_severity(findings: DataFrame) -> DataFrame:
    return _most_frequent(findings, ["anomaly_type", "anomaly_severity"], "finding_count")


def detector_benchmark(metrics: DataFrame) -> DataFrame:
    overall_first = F.when(F.col("metric_scope") == "overall", 0).otherwise(1)
    return metrics.orderBy(overall_first, "anomaly_type").select(
        "anomaly_type",
        "true_positive",
        "false_positive",
        "false_negative",
        "true_negative",
        "precision",
        "recall",
        "f1_score",
    )


def top_findings(findings: DataFrame, rows: int = 50) -> DataFrame:
    shown = findings.select(
        "anomaly_type",
        "anomaly_severity",
        "anomaly_score",
        "snapshot_folder",
        "route_id",
        "trip_id",
        "entity_id",
        "detector_rule_id",
        "anomaly_reason",
    )
    return _top(
        shown,
        rows,
        F.col("anomaly_score").desc(),
        F.col("anomaly_severity").asc(),
        F.col("anomaly_type").asc(),
        ties=("snapshot_folder", "route_id", "trip_id", "entity_id", "anomaly_reason"),
    )


def route_status_counts(route_activity: DataFrame) -> DataFrame:
    return _most_frequent(route_activity, ["route_activity_status"], "route_snapshot_count")


def top_routes(route_activity: DataFrame, rows: int = 25) -> DataFrame:
    by_route = route_activity.groupBy("route_id").agg(
        F.sum("total_realtime_records").alias("total_realtime_records"),
        F.sum("vehicle_position_count").alias("vehicle_positions"),
        F.sum("trip_update_count").alias("trip_updates"),
        F.max("distinct_vehicle_count").alias("peak_distinct_vehicles"),
    )
    return _top(by_route, rows, F.col("total_realtime_records").desc(), ties=("route_id",))


def on_time_rate(on_time_performance: DataFrame) -> DataFrame:
    on_time = F.count_if("on_time_flag").cast("double")
    return on_time_performance.agg(F.try_divide(on_time, F.count("on_time_flag")).alias("on_time_rate"))


def extreme_delay_count(on_time_performance: DataFrame) -> DataFrame:
    extreme = F.col("delay_sanity_status").isin(L.EXTREME_EARLY, L.EXTREME_LATE)
    return on_time_performance.agg(F.count_if(extreme).alias("extreme_delay_count"))


def delay_band_counts(on_time_performance: DataFrame) -> DataFrame:
    return _most_frequent(on_time_performance, ["delay_band"], "trip_snapshot_count")


def top_delayed_routes(on_time_performance: DataFrame, rows: int = 25, min_trips: int = 5) -> DataFrame:
    by_route = (
        on_time_performance.where(F.col("delay_sanity_status") == L.PLAUSIBLE)
        .groupBy("route_id")
        .agg(
            _rows().alias("trip_snapshot_count"),
            F.avg("estimated_delay_minutes").alias("avg_estimated_delay_minutes"),
            F.max("estimated_delay_minutes").alias("max_estimated_delay_minutes"),
        )
        .where(F.col("trip_snapshot_count") >= min_trips)
    )
    return _top(by_route, rows, F.col("avg_estimated_delay_minutes").desc(), ties=("route_id",))


def headway_status_counts(headway: DataFrame) -> DataFrame:
    return _most_frequent(headway, ["headway_reliability_status"], "route_snapshot_count")


def kpi_avg_spacing(headway: DataFrame) -> DataFrame:
    """The mean over routes and snapshots, from an exact sum of millionths: the order of rows must not show."""
    spacing = F.col("avg_vehicle_spacing_minutes")
    mean = F.try_divide(F.sum(spacing.cast("decimal(28,6)")).cast("double"), F.count(spacing))
    return headway.agg(mean.alias("avg_vehicle_spacing_minutes"))


def top_variable_routes(headway: DataFrame, rows: int = 25) -> DataFrame:
    shown = headway.where(F.col("headway_variance_minutes").isNotNull()).select(
        "route_id",
        "snapshot_folder",
        "distinct_vehicle_count",
        "avg_vehicle_spacing_minutes",
        "headway_variance_minutes",
        "headway_reliability_status",
    )
    return _top(
        shown, rows, F.col("headway_variance_minutes").desc(), ties=("route_id", "snapshot_folder")
    )


def snapshot_range_report(feed_quality: DataFrame) -> DataFrame:
    return feed_quality.agg(
        F.min("snapshot_timestamp_utc").alias("first_snapshot"),
        F.max("snapshot_timestamp_utc").alias("latest_snapshot"),
    )
