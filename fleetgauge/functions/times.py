"""Clock and service-day arithmetic on whole epoch seconds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.labels import SERVICE_DAY_OFFSET_SECONDS

_DAY = 86_400


def with_clock_seconds(df: DataFrame, clocks: Mapping[str, str]) -> DataFrame:
    """Add, per clock text column, its seconds after midnight under the given name.

    ``HH:MM:SS`` may pass 24 hours; other shapes give NULL. Text is split once per row: the
    steps are separate projections because one expression would repeat the split for every part.
    """
    parts = {alias: f"{alias}__parts" for alias in clocks.values()}
    split = df.withColumns({parts[alias]: F.split(F.col(text), ":") for text, alias in clocks.items()})
    numbers = {
        alias: [F.get(parts[alias], part).try_cast("bigint") for part in range(3)] for alias in parts
    }
    stepped = split.withColumns(
        {f"{alias}__{part}": column for alias, columns in numbers.items() for part, column in enumerate(columns)}
    )

    def total(alias: str) -> Column:
        hour, minute, second = (F.col(f"{alias}__{part}") for part in range(3))
        readable = minute.between(0, 59) & second.between(0, 59)
        return F.when(readable, (hour * 3600 + minute * 60 + second).try_cast("int"))

    helpers = [*parts.values(), *[f"{alias}__{part}" for alias in parts for part in range(3)]]
    return stepped.withColumns({alias: total(alias) for alias in parts}).drop(*helpers)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Difference of the two whole-second instants, so 00.9 to 01.1 counts as one second."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def late_by_seconds(
    actual: Column,
    scheduled: Column,
    *,
    day_offset_seconds: int = SERVICE_DAY_OFFSET_SECONDS,
    service_day: str = "calendar",
) -> Column:
    """Seconds by which ``actual`` is later than ``scheduled`` seconds into its service day.

    ``calendar`` takes the local day the actual time falls in. ``nearest`` also looks at the day
    before and after and keeps the smallest deviation, which dates a 25:10:00 trip correctly.
    """
    into_day = F.pmod(F.unix_seconds(actual) - day_offset_seconds, F.lit(_DAY))
    late = into_day - scheduled
    if service_day == "calendar":
        return late
    if service_day != "nearest":
        raise ValueError(f"unknown service_day {service_day!r}")
    candidates = (late, late - _DAY, late + _DAY)
    nearest = F.array_min(F.array(*[F.struct(F.abs(c).alias("off"), c.alias("late")) for c in candidates]))
    return F.when(late.isNotNull(), nearest["late"])


def snapshot_folder_name(timestamp: Column) -> Column:
    return F.date_format(timestamp, "'snapshot_'yyyyMMdd_HHmmss")
