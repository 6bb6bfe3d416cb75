"""Data assertions: each gives the violating rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import labels as L


def assert_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def assert_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def assert_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def assert_unique_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a NULL part is a value like any other."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def assert_match_rate(trip_matches: DataFrame, minimum: float = L.MIN_MATCH_RATE) -> DataFrame:
    """One row if too few trip updates match the schedule, or if there are none."""
    total, matched = F.col("total_rows"), F.col("matched_rows")
    rate = F.when(total == 0, F.lit(0.0)).otherwise(matched.cast("double") / total.cast("double"))
    return (
        trip_matches.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("schedule_match_status") == L.MATCHED).alias("matched_rows"),
        )
        .select("*", rate.alias("match_rate"), F.lit(float(minimum)).alias("minimum_match_rate"))
        .where((total == 0) | (F.col("match_rate") < minimum))
    )


def assert_score_range(findings: DataFrame, low: float = 0.0, high: float = 1.0) -> DataFrame:
    score = F.col("anomaly_score")
    return findings.where((score < low) | (score > high)).select("anomaly_id", "anomaly_score")


def assert_label_coverage(
    evaluation: DataFrame, labels: Sequence[str] = tuple(L.EVALUATION_CASES)
) -> DataFrame:
    """Expected labels that no record carries."""
    label = "synthetic_anomaly_type"
    expected = evaluation.sparkSession.createDataFrame([(name,) for name in labels], f"{label} string")
    return expected.join(evaluation.select(label).distinct(), label, "left_anti").select(
        label, F.lit(0).cast("bigint").alias("row_count")
    )


def assert_recall(metrics: DataFrame, minimum: float = L.MIN_RECALL) -> DataFrame:
    recall = F.col("recall")
    overall = (F.col("metric_scope") == "overall") & (F.col("anomaly_type") == "all_anomalies")
    return metrics.where(overall & (recall.isNull() | (recall < minimum))).select(
        "metric_scope", "anomaly_type", "recall"
    )


def source_freshness(
    df: DataFrame,
    as_of: Column | datetime,
    *,
    loaded_at: str = "snapshot_timestamp_utc",
    warn_minutes: float = 10,
    error_minutes: float = 60,
) -> DataFrame:
    """Age of the newest row at ``as_of``, as pass, warn or error; an empty table is an error."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    age = (F.unix_micros(moment) - F.unix_micros("max_loaded_at")) / F.lit(60e6)
    status = (
        F.when(F.col("age_minutes").isNull() | (F.col("age_minutes") > error_minutes), "error")
        .when(F.col("age_minutes") > warn_minutes, "warn")
        .otherwise("pass")
    )
    return (
        df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at"))
        .withColumn("age_minutes", age)
        .withColumn("freshness_state", status)
    )


@dataclass(frozen=True)
class Check:
    """A declared assertion on one column (or key) of a model."""

    kind: str
    columns: tuple[str, ...]
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}({', '.join(self.columns)})"


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", (column,)) for column in columns]


def unique(*columns: str) -> list[Check]:
    return [Check("unique", (column,)) for column in columns]


def unique_key(*columns: str) -> list[Check]:
    return [Check("unique_key", columns)]


def accepted(column: str, *values: str) -> list[Check]:
    return [Check("accepted_values", (column,), values)]


def row_condition(check: Check) -> Column:
    """True for a violating row, for the kinds of checks that look at one row at a time."""
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        return column.isNull()
    return ~column.isin(*check.values)


ROW_WISE = ("not_null", "accepted_values")


def row_metrics(checks: Iterable[Check]) -> dict[str, Column]:
    """By name, the number of violating rows as an aggregate, for the checks that look at one row at a time."""
    return {check.name: F.count_if(row_condition(check)) for check in checks if check.kind in ROW_WISE}


def violations(df: DataFrame, check: Check) -> DataFrame:
    """The violating rows or keys of one check."""
    if check.kind == "not_null":
        return assert_not_null(df, check.columns[0])
    if check.kind == "accepted_values":
        return assert_accepted_values(df, check.columns[0], check.values)
    if check.kind == "unique":
        return assert_unique(df, check.columns[0])
    return assert_unique_key(df, check.columns)


def _inlined(counts: Mapping[str, Column]) -> Column:
    """A row (check_name, violation_count) for each of the counts."""
    pairs = [F.struct(F.lit(name).alias("check_name"), n.alias("violation_count")) for name, n in counts.items()]
    return F.inline(F.array(*pairs))


def check_table(
    df: DataFrame, model: str, checks: Iterable[Check], measured: Mapping[str, int] | None = None
) -> DataFrame:
    """(model, check_name, violation_count) of every check on a table.

    All checks that look at one row at a time share one pass and count violating rows; a
    uniqueness check groups its key and counts repeated keys. Counts in ``measured``, taken while the table was
    written, spare that pass.
    """
    checks = list(checks)
    row_wise = row_metrics(checks)
    keyed = [c for c in checks if c.kind not in ROW_WISE]
    results = []
    if row_wise and measured is not None:
        # Rows of one task: a local list would be dealt over all cores, table by table.
        known = {name: F.lit(measured[name]).cast("bigint") for name in row_wise}
        results.append(df.sparkSession.range(0, 1, 1, 1).select(_inlined(known)))
    elif row_wise:
        counts = df.agg(*[metric.alias(name) for name, metric in row_wise.items()])
        results.append(counts.select(_inlined({name: F.col(f"`{name}`") for name in row_wise})))
    results += [
        violations(df, c).agg(F.count(F.lit(1)).alias("violation_count")).select(
            F.lit(c.name).alias("check_name"), "violation_count"
        )
        for c in keyed
    ]
    return reduce(DataFrame.unionByName, results).select(
        F.lit(model).alias("model"), "check_name", "violation_count"
    )
