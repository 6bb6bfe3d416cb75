"""Findings: rules as data, evaluated over each input in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.functions import finding_id
from fleetgauge.operators.windows import occurrence_number
from fleetgauge.schemas import FINDING_COLUMNS

_TEXT_COLUMNS = ("route_id", "trip_id", "entity_id", "vehicle_id")


@dataclass(frozen=True)
class Rule:
    """When a row is a finding, what identifies it, and how bad it is."""

    rule_id: str
    when: Column
    key: tuple[str, ...]
    severity: Column
    score: Column
    reason: Column | None = None
    carries: Mapping[str, str] = field(default_factory=dict)

    def finding(self) -> Column:
        grain, anomaly_type, source_model, reason = L.FINDING_RULES[self.rule_id]
        values = {
            "anomaly_id": finding_id(self.rule_id, *self.key),
            "anomaly_grain": F.lit(grain),
            "snapshot_folder": F.col("snapshot_folder"),
            "snapshot_timestamp_utc": self._carried("snapshot_timestamp_utc", "timestamp"),
            **{name: self._carried(name, "string") for name in _TEXT_COLUMNS},
            "anomaly_type": F.lit(anomaly_type),
            "anomaly_severity": self.severity,
            "anomaly_score": self.score.cast("double"),
            "anomaly_reason": F.lit(reason) if self.reason is None else self.reason,
            "detector_rule_id": F.lit(self.rule_id),
            "source_model": F.lit(source_model),
        }
        return F.struct(*[values[name].alias(name) for name in FINDING_COLUMNS])

    def _carried(self, name: str, type_name: str) -> Column:
        source = self.carries.get(name)
        return F.lit(None).cast(type_name) if source is None else F.col(source)


def evaluate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A finding per row and matching rule, from a single scan of ``df``."""
    some_rule = reduce(or_, [rule.when for rule in rules])
    findings = F.array(*[F.when(rule.when, rule.finding()) for rule in rules])
    return (
        df.where(some_rule)
        .select(F.explode(findings).alias("finding"))
        .where(F.col("finding").isNotNull())
        .select("finding.*")
    )


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


_VEHICLE_KEY = ("snapshot_folder", "entity_id")
_VEHICLE_CARRIES = _same("snapshot_timestamp_utc", *_TEXT_COLUMNS)


def is_stale(minutes: int = L.STALE_MINUTES) -> Column:
    limit = F.col("snapshot_timestamp_utc") - F.make_dt_interval(mins=F.lit(minutes))
    return F.col("vehicle_timestamp_utc") < limit


def is_speeding(max_speed: float = L.MAX_SPEED) -> Column:
    return F.col("speed") > max_speed


def is_off_area(
    latitudes: tuple[float, float] = L.LATITUDE_RANGE, longitudes: tuple[float, float] = L.LONGITUDE_RANGE
) -> Column:
    return ~F.col("latitude").between(*latitudes) | ~F.col("longitude").between(*longitudes)


def rule_stale_vehicle_timestamp(minutes: int = L.STALE_MINUTES) -> Rule:
    return Rule(
        "rule_stale_vehicle_timestamp",
        is_stale(minutes),
        _VEHICLE_KEY,
        F.lit("high"),
        F.lit(0.85),
        carries=_VEHICLE_CARRIES,
    )


def rule_missing_gps_coordinate() -> Rule:
    return Rule(
        "rule_missing_gps_coordinate",
        F.col("latitude").isNull() | F.col("longitude").isNull(),
        _VEHICLE_KEY,
        F.lit("medium"),
        F.lit(0.70),
        carries=_VEHICLE_CARRIES,
    )


def rule_implausible_gps_or_speed(
    max_speed: float = L.MAX_SPEED,
    latitudes: tuple[float, float] = L.LATITUDE_RANGE,
    longitudes: tuple[float, float] = L.LONGITUDE_RANGE,
) -> Rule:
    rule_id = "rule_implausible_gps_or_speed"
    speeding = is_speeding(max_speed)
    return Rule(
        rule_id,
        speeding | is_off_area(latitudes, longitudes),
        _VEHICLE_KEY,
        F.lit("critical"),
        F.lit(0.95),
        F.when(speeding, L.SPEED_REASON).otherwise(L.FINDING_RULES[rule_id][3]),
        _VEHICLE_CARRIES,
    )


def rule_duplicate_trip_update_entity() -> Rule:
    """Over ``quality_duplicate_entities`` of the trip updates; worse with every further copy."""
    copies = F.col("duplicate_record_count").cast("double")
    return Rule(
        "rule_duplicate_trip_update_entity",
        F.col("duplicate_record_count") > 1,
        ("snapshot_folder", "entity_id"),
        F.lit("medium"),
        F.least(F.lit(1.0), F.lit(0.60) + F.lit(0.05) * (copies - 2)),
        carries={
            "snapshot_timestamp_utc": "first_snapshot_timestamp_utc",
            "entity_id": "entity_id",
        },
    )


def rule_unmatched_schedule_reference() -> Rule:
    """Over ``quality_realtime_trip_referential_integrity``."""
    return Rule(
        "rule_unmatched_schedule_reference",
        F.col("quality_issue") == L.MISSING_FROM_TRIPS,
        ("snapshot_folder", "realtime_source", "trip_id"),
        F.lit("high"),
        F.lit(0.90),
        carries=_same("trip_id"),
    )


def rule_extreme_delay(severe_minutes: float = L.SEVERE_DELAY_MINUTES) -> Rule:
    """Over ``fct_on_time_performance``."""
    return Rule(
        "rule_extreme_delay",
        F.col("delay_sanity_status").isin(L.EXTREME_EARLY, L.EXTREME_LATE),
        ("snapshot_folder", "trip_id"),
        F.lit("critical"),
        F.when(F.col("delay_minutes_abs") >= severe_minutes, 1.0).otherwise(0.90),
        carries=_same("snapshot_timestamp_utc", "route_id", "trip_id", "vehicle_id"),
    )


def rule_feed_quality_warning() -> Rule:
    """Over ``fct_feed_quality``."""
    status = F.col("feed_quality_status")
    return Rule(
        "rule_feed_quality_warning",
        status.isin(L.WARNING, L.CRITICAL),
        ("snapshot_folder",),
        F.when(status == L.CRITICAL, "critical").otherwise("medium"),
        F.when(status == L.CRITICAL, 1.0).otherwise(0.65),
        carries=_same("snapshot_timestamp_utc"),
    )


def rule_feed_freshness() -> Rule:
    """Over ``fct_feed_quality``."""
    return Rule(
        "rule_feed_freshness",
        F.col("freshness_status") == L.LATE,
        ("snapshot_folder",),
        F.lit("high"),
        F.lit(0.80),
        carries=_same("snapshot_timestamp_utc"),
    )


def fct_anomaly_findings(
    vehicles: DataFrame,
    duplicate_trip_updates: DataFrame,
    unmatched_trips: DataFrame,
    on_time_performance: DataFrame,
    feed_quality: DataFrame,
    *,
    stale_minutes: int = L.STALE_MINUTES,
    max_speed: float = L.MAX_SPEED,
    latitudes: tuple[float, float] = L.LATITUDE_RANGE,
    longitudes: tuple[float, float] = L.LONGITUDE_RANGE,
    severe_minutes: float = L.SEVERE_DELAY_MINUTES,
) -> DataFrame:
    """All findings of the eight rules in one schema; each input is read once.

    Repeated entities and unmatched trips may come as one and the same table, see ``quality.key_issues``.
    """
    duplicate, unmatched = rule_duplicate_trip_update_entity(), rule_unmatched_schedule_reference()
    if duplicate_trip_updates is unmatched_trips:
        on_keys = [evaluate_rules(duplicate_trip_updates, [duplicate, unmatched])]
    else:
        on_keys = [evaluate_rules(duplicate_trip_updates, [duplicate]), evaluate_rules(unmatched_trips, [unmatched])]
    parts = [
        evaluate_rules(
            vehicles,
            [
                rule_stale_vehicle_timestamp(stale_minutes),
                rule_missing_gps_coordinate(),
                rule_implausible_gps_or_speed(max_speed, latitudes, longitudes),
            ],
        ),
        *on_keys,
        evaluate_rules(on_time_performance, [rule_extreme_delay(severe_minutes)]),
        evaluate_rules(feed_quality, [rule_feed_quality_warning(), rule_feed_freshness()]),
    ]
    return reduce(DataFrame.unionByName, parts)


def with_unique_ids(findings: DataFrame) -> DataFrame:
    """Findings whose ids occur once: from the second one of an id on, its number is added.

    An id names the rule and the reported thing, which a snapshot may report more than once. A NULL id stays NULL.
    """
    numbered = occurrence_number(findings, "anomaly_id", "occurrence")
    further = F.concat("anomaly_id", F.lit("#"), F.col("occurrence").cast("string"))
    unique = F.when(F.col("occurrence") > 1, further).otherwise(F.col("anomaly_id"))
    return numbered.withColumn("anomaly_id", unique).drop("occurrence")
