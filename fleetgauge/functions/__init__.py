"""Column expressions shared by the operators; all are Spark built-ins underneath."""

from fleetgauge.functions.casts import lenient_double, lenient_int, lenient_long, number_from_json
from fleetgauge.functions.findings import finding_id, ratio_or_zero
from fleetgauge.functions.times import (
    late_by_seconds,
    seconds_between,
    snapshot_folder_name,
    with_clock_seconds,
)

__all__ = [
    "finding_id",
    "late_by_seconds",
    "lenient_double",
    "lenient_int",
    "lenient_long",
    "number_from_json",
    "ratio_or_zero",
    "seconds_between",
    "snapshot_folder_name",
    "with_clock_seconds",
]
