"""Identifiers and rates used by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finding_id(rule_id: str, *key: Column | str) -> Column:
    """Stable id of a finding; NULL as soon as one key part is NULL."""
    parts = [F.lit(rule_id)]
    for part in key:
        parts += [F.lit("|"), F.col(part) if isinstance(part, str) else part]
    return F.md5(F.concat(*parts))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )
