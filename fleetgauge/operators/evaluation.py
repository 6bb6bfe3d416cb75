"""Detector benchmark: labelled sample with injected faults, first-match detector, metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.operators.anomaly import is_off_area, is_speeding, is_stale
from fleetgauge.schemas import EVALUATION


def _first_rows(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """The first ``rows`` rows in ``order``, numbered from 1.

    The limit becomes a top-n per task; only ``rows`` rows per task reach the ordering, and the
    numbering sees ``rows`` rows in total. Further columns break ties so that reruns agree.
    """
    ties = [name for name, kind in df.dtypes if name not in order and not kind.startswith("array")]
    keys = [F.col(name).asc_nulls_last() for name in order + ties]
    top = df.orderBy(*keys).limit(rows)
    return top.withColumn("sample_number", F.row_number().over(Window.orderBy(*keys)))


#: Groups of each case that its first rows are taken of before they are merged.
_GROUPS = 32


def _first_rows_by_case(df: DataFrame, order: list[str], cases: dict[str, Column], rows: int) -> DataFrame:
    """The first ``rows`` rows in ``order`` of each case, numbered from 1, all cases from one pass over ``df``.

    ``cases`` says by label which rows a case may take; a row may serve several. The limit is taken in every
    task, then in groups of each case, and then of the case, so that no task sees more than ``rows`` rows
    of each task or group. Numbers and ties are those of ``_first_rows``.
    """
    ties = [name for name, kind in df.dtypes if name not in order and not kind.startswith("array")]
    keys = [F.col(name).asc_nulls_last() for name in order + ties]
    labels = F.array(*[F.when(holds, F.lit(label)) for label, holds in cases.items()])
    found = df.select("*", F.explode(labels).alias("case")).where(F.col("case").isNotNull())
    found = found.withColumn("case_group", F.pmod(F.xxhash64(*order), F.lit(_GROUPS)))
    for groups in (["case", "case_group"], ["case"]):
        number = F.row_number().over(Window.partitionBy(*groups).orderBy(*keys))
        found = found.withColumn("sample_number", number).where(F.col("sample_number") <= rows)
    return found.drop("case_group")


def _case(df: DataFrame, label: str, **changes: Column) -> list[Column]:
    """The evaluation columns of a case: from ``changes``, else from ``df``, else NULL."""
    prefix, source_model, record_type, severity, reason = L.EVALUATION_CASES[label]
    fixed = {
        "evaluation_record_id": F.concat(F.lit(prefix), F.col("sample_number").cast("string")),
        "source_model": F.lit(source_model),
        "evaluation_record_type": F.lit(record_type),
        "is_synthetic_anomaly": F.lit(label != "normal"),
        "synthetic_anomaly_type": F.lit(label),
        "anomaly_severity": F.lit(severity),
        "anomaly_reason": F.lit(reason),
        **changes,
    }

    def value(name: str) -> Column:
        if name in fixed:
            return fixed[name]
        return F.col(name) if name in df.columns else F.lit(None)

    return [value(f.name).cast(f.dataType).alias(f.name) for f in EVALUATION.fields]


def _labelled(df: DataFrame, label: str, **changes: Column) -> DataFrame:
    return df.select(*_case(df, label, **changes))


def _without_delay() -> dict[str, Column]:
    return {
        "delay_sanity_status": F.lit(L.DELAY_UNAVAILABLE),
        "delay_band": F.lit(L.BAND_UNAVAILABLE),
    }


_TRIP_FIELDS = [
    "snapshot_folder",
    "snapshot_timestamp_utc",
    "trip_id",
    "route_id",
    "vehicle_id",
    "schedule_match_status",
    "estimated_delay_minutes",
    "delay_sanity_status",
    "delay_band",
    "on_time_flag",
]
_VEHICLE_FIELDS = [
    "snapshot_folder",
    "snapshot_timestamp_utc",
    "entity_id",
    "trip_id",
    "route_id",
    "vehicle_id",
    "latitude",
    "longitude",
    "speed",
    "vehicle_timestamp_utc",
]
_UPDATE_FIELDS = [
    "snapshot_folder",
    "snapshot_timestamp_utc",
    "entity_id",
    "trip_id",
    "route_id",
    "vehicle_id",
    "trip_update_timestamp_utc",
]
_TRIP_ORDER = ["snapshot_folder", "route_id", "trip_id"]
_VEHICLE_ORDER = ["snapshot_folder", "route_id", "vehicle_id", "entity_id"]
_UPDATE_ORDER = ["snapshot_folder", "route_id", "trip_id", "entity_id"]


def _plausible(on_time_performance: DataFrame, rows: int) -> DataFrame:
    plausible = on_time_performance.where(F.col("delay_sanity_status") == L.PLAUSIBLE)
    return _first_rows(plausible.select(*_TRIP_FIELDS), _TRIP_ORDER, rows)


def _extreme_delay(minutes: float) -> dict[str, Column]:
    return {
        "estimated_delay_minutes": F.col("estimated_delay_minutes") + minutes,
        "delay_sanity_status": F.lit(L.EXTREME_LATE),
        "delay_band": F.lit(L.DELAY_BANDS[-1]),
        "on_time_flag": F.lit(False),
    }


def sample_normal(on_time_performance: DataFrame, rows: int = L.NORMAL_SAMPLE_ROWS) -> DataFrame:
    return _labelled(_plausible(on_time_performance, rows), "normal")


def _stale(hours: int) -> dict[str, Column]:
    earlier = F.col("vehicle_timestamp_utc") - F.make_dt_interval(hours=F.lit(hours))
    return {"vehicle_timestamp_utc": earlier, **_without_delay()}


def _moved(degrees: float, speed: float) -> dict[str, Column]:
    return {
        "latitude": F.col("latitude") + degrees,
        "longitude": F.col("longitude") - degrees,
        "speed": F.lit(speed),
        **_without_delay(),
    }


def _is_timed() -> Column:
    return F.col("vehicle_timestamp_utc").isNotNull()


def _is_located() -> Column:
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def inject_stale_timestamp(vehicles: DataFrame, rows: int = L.INJECTED_ROWS, hours: int = 2) -> DataFrame:
    timed = vehicles.where(_is_timed()).select(*_VEHICLE_FIELDS)
    return _labelled(_first_rows(timed, _VEHICLE_ORDER, rows), "stale_vehicle_position_timestamp", **_stale(hours))


def inject_gps_jump(
    vehicles: DataFrame, rows: int = L.INJECTED_ROWS, degrees: float = 1.0, speed: float = 250.0
) -> DataFrame:
    located = vehicles.where(_is_located()).select(*_VEHICLE_FIELDS)
    return _labelled(
        _first_rows(located, _VEHICLE_ORDER, rows), "gps_jump_or_implausible_speed", **_moved(degrees, speed)
    )


def _vehicle_faults(vehicles: DataFrame, rows: int, hours: int = 2, degrees: float = 1.0, speed: float = 250.0) -> DataFrame:
    """``inject_stale_timestamp`` and ``inject_gps_jump`` from one pass over the vehicles."""
    stale, moved = "stale_vehicle_position_timestamp", "gps_jump_or_implausible_speed"
    cases = {stale: _is_timed(), moved: _is_located()}
    first = _first_rows_by_case(vehicles.select(*_VEHICLE_FIELDS), _VEHICLE_ORDER, cases, rows)
    record = F.when(F.col("case") == stale, F.struct(*_case(first, stale, **_stale(hours)))).otherwise(
        F.struct(*_case(first, moved, **_moved(degrees, speed)))
    )
    return first.select(record.alias("record")).select("record.*")


def _repeated() -> dict[str, Column]:
    return {"schedule_match_status": F.lit(L.MATCHED), **_without_delay()}


def _unmatched() -> dict[str, Column]:
    return {
        "trip_id": F.concat("trip_id", F.lit(L.UNMATCHED_TRIP_SUFFIX)),
        "schedule_match_status": F.lit(L.UNMATCHED),
        **_without_delay(),
    }


def inject_duplicate_label(trip_updates: DataFrame, rows: int = L.INJECTED_ROWS) -> DataFrame:
    first = _first_rows(trip_updates.select(*_UPDATE_FIELDS), _UPDATE_ORDER, rows)
    return _labelled(first, "duplicate_trip_update_entity", **_repeated())


def inject_unmatched_reference(
    trip_updates: DataFrame, trips: DataFrame, rows: int = L.INJECTED_ROWS
) -> DataFrame:
    """From the first trip-schedule pairs, with the trip id changed beyond recognition.

    Every trip update appears at least once among the pairs and the order looks at trip updates
    only, so the first pairs come from the first trip updates: the sample is cut before the
    schedule is looked up, and again after, in case a trip id is scheduled twice.
    """
    first = _first_rows(trip_updates.select(*_UPDATE_FIELDS), _UPDATE_ORDER, rows).drop("sample_number")
    pairs = first.join(trips.select("trip_id"), "trip_id", "left")
    return _labelled(_first_rows(pairs, _UPDATE_ORDER, rows), "missing_or_unmatched_schedule_reference", **_unmatched())


def _trip_update_faults(trip_updates: DataFrame, trips: DataFrame, rows: int) -> DataFrame:
    """``inject_duplicate_label`` and ``inject_unmatched_reference`` from one pass over the trip updates.

    Both start from the same first rows. Of these, some may meet several scheduled trips: the first fault
    takes each once, the second the first pairs.
    """
    repeated, unmatched = "duplicate_trip_update_entity", "missing_or_unmatched_schedule_reference"
    updates = trip_updates.select(*_UPDATE_FIELDS)
    first = _first_rows_by_case(updates, _UPDATE_ORDER, {repeated: F.lit(True)}, rows)
    first = first.withColumnRenamed("sample_number", "own_number")
    pairs = first.join(trips.select("trip_id"), "trip_id", "left")
    pair_number = F.row_number().over(Window.partitionBy("case").orderBy("own_number"))
    copy_number = F.row_number().over(Window.partitionBy("case", "own_number").orderBy("own_number"))
    pairs = pairs.withColumns({"pair_number": pair_number, "copy_number": copy_number})
    as_first = pairs.withColumn("sample_number", F.col("own_number"))
    pair_id = F.concat(F.lit(L.EVALUATION_CASES[unmatched][0]), F.col("pair_number").cast("string"))
    records = F.array(
        F.when(F.col("copy_number") == 1, F.struct(*_case(as_first, repeated, **_repeated()))),
        F.when(
            F.col("pair_number") <= rows,
            F.struct(*_case(as_first, unmatched, evaluation_record_id=pair_id, **_unmatched())),
        ),
    )
    return as_first.select(F.explode(records).alias("record")).where(F.col("record").isNotNull()).select("record.*")


def inject_extreme_delay(
    on_time_performance: DataFrame, rows: int = L.INJECTED_ROWS, minutes: float = 90.0
) -> DataFrame:
    first = _plausible(on_time_performance, rows)
    return _labelled(first, "late_or_extreme_delay_outlier", **_extreme_delay(minutes))


def _normal_and_extreme_delay(
    on_time_performance: DataFrame, normal_rows: int, injected_rows: int, minutes: float = 90.0
) -> DataFrame:
    """``sample_normal`` and ``inject_extreme_delay`` from one pass over the mart.

    Both take the first plausible trips in the same order.
    """
    first = _plausible(on_time_performance, max(normal_rows, injected_rows))
    number = F.col("sample_number")
    extreme = _case(first, "late_or_extreme_delay_outlier", **_extreme_delay(minutes))
    records = F.array(
        F.when(number <= normal_rows, F.struct(*_case(first, "normal"))),
        F.when(number <= injected_rows, F.struct(*extreme)),
    )
    exploded = first.select(F.explode(records).alias("record"))
    return exploded.where(F.col("record").isNotNull()).select("record.*")


def synthetic_anomaly_evaluation(
    on_time_performance: DataFrame,
    vehicles: DataFrame,
    trip_updates: DataFrame,
    trips: DataFrame,
    *,
    normal_rows: int = L.NORMAL_SAMPLE_ROWS,
    injected_rows: int = L.INJECTED_ROWS,
) -> DataFrame:
    """The normal sample and the five injected faults, each input read once."""
    parts = [
        _normal_and_extreme_delay(on_time_performance, normal_rows, injected_rows),
        _vehicle_faults(vehicles, injected_rows),
        _trip_update_faults(trip_updates, trips, injected_rows),
    ]
    return reduce(DataFrame.unionByName, parts)


def rule_based_anomaly_detection(
    evaluation: DataFrame,
    *,
    stale_minutes: int = L.STALE_MINUTES,
    max_speed: float = L.MAX_SPEED,
    plausible: tuple[float, float] = L.PLAUSIBLE_DELAY_RANGE,
) -> DataFrame:
    """Predicted label, severity, rule and reason of each record; the first matching case wins."""
    minutes = F.col("estimated_delay_minutes")
    record_type = F.col("evaluation_record_type")
    vehicle = record_type == "vehicle_position"
    cases = {
        "stale": is_stale(stale_minutes),
        "speed": vehicle & is_speeding(max_speed),
        "position": vehicle & is_off_area(),
        "trip_update": record_type == "trip_update",
        "unmatched": F.col("schedule_match_status") == L.UNMATCHED,
        "delay": F.col("delay_sanity_status").isin(L.EXTREME_EARLY, L.EXTREME_LATE)
        | (minutes < plausible[0])
        | (minutes > plausible[1]),
    }

    def outcome(name: str) -> Column:
        label, severity, rule_id, reason = L.DETECTIONS[name]
        return F.struct(
            F.lit(name != "nothing").alias("predicted_is_anomaly"),
            F.lit(label).alias("predicted_anomaly_type"),
            F.lit(severity).alias("predicted_severity"),
            F.lit(rule_id).alias("detector_rule_id"),
            F.lit(reason).alias("detection_reason"),
        )

    ladder = reduce(
        lambda chain, name: chain.when(cases[name], outcome(name)),
        list(cases)[1:],
        F.when(cases["stale"], outcome("stale")),
    ).otherwise(outcome("nothing"))
    return evaluation.withColumn("prediction", ladder).select(*evaluation.columns, "prediction.*")


def anomaly_detection_metrics(predictions: DataFrame) -> DataFrame:
    """Confusion counts, precision, recall and F1: overall, and per label against the rest.

    Records are first counted per (flag, label) pair of truth and prediction. Each of the few
    pairs then counts for the overall row and for the labels it names; the pairs that do not name
    a label are its true negatives.
    """
    truth, guess = F.col("is_synthetic_anomaly"), F.col("predicted_is_anomaly")
    actual, predicted = F.col("synthetic_anomaly_type"), F.col("predicted_anomaly_type")
    pairs = predictions.groupBy(truth, guess, actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    # No record at all still has an overall row, with a recall that is NULL and so fails its check.
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in pairs.dtypes if name != "n"]
    pairs = pairs.unionByName(
        predictions.sparkSession.range(1).select(*nothing, F.lit(0).cast("bigint").alias("n"))
    )
    n, label = F.col("n"), F.col("anomaly_type")
    overall = F.col("metric_scope") == "overall"

    def row(scope: str, name: Column) -> Column:
        return F.struct(F.lit(scope).alias("metric_scope"), name.alias("anomaly_type"))

    counted_for = F.array_distinct(
        F.array(
            row("overall", F.lit("all_anomalies")),
            row("by_anomaly_type", actual),
            row("by_anomaly_type", predicted),
        )
    )

    def total(in_overall: Column, in_label: Column) -> Column:
        counts = F.when(overall, in_overall).otherwise(in_label)
        return F.coalesce(F.sum(F.when(counts, n)), F.lit(0)).cast("bigint")

    is_actual, is_predicted = actual == label, predicted == label
    both_named = actual.isNotNull() & predicted.isNotNull()
    tp, fp, fn = (F.col(name) for name in ("true_positive", "false_positive", "false_negative"))

    def of_overall(name: str) -> Column:
        # Over the handful of result rows, not over records.
        return F.max(F.when(overall, F.col(name))).over(Window.partitionBy())

    return (
        pairs.select("*", F.explode(counted_for).alias("counted_for"))
        .select("*", "counted_for.*")
        .groupBy("metric_scope", "anomaly_type")
        .agg(
            total(truth & guess, is_actual & is_predicted).alias("true_positive"),
            total(~truth & guess, ~is_actual & is_predicted).alias("false_positive"),
            total(truth & ~guess, is_actual & ~is_predicted).alias("false_negative"),
            total(~truth & ~guess, F.lit(False)).alias("clear"),
            total(F.lit(True), F.lit(False)).alias("records"),
            total(both_named, F.lit(False)).alias("compared"),
            F.max(overall | F.coalesce(truth & is_actual & (n > 0), F.lit(False))).alias("injected"),
        )
        .withColumns(
            {
                "total_records": of_overall("records"),
                "true_negative": F.when(overall, F.col("clear")).otherwise(
                    of_overall("compared") - tp - fp - fn
                ),
            }
        )
        .where("injected")
        .select(
            "metric_scope",
            "anomaly_type",
            tp,
            fp,
            fn,
            "true_negative",
            "total_records",
            (tp + fn).alias("actual_positive_count"),
            (tp + fp).alias("predicted_positive_count"),
            F.when(tp + fp > 0, tp.cast("double") / (tp + fp)).alias("precision"),
            F.when(tp + fn > 0, tp.cast("double") / (tp + fn)).alias("recall"),
            F.when(tp == 0, F.lit(0.0))
            .otherwise(tp.cast("double") * 2 / (tp * 2 + fp + fn).cast("double"))
            .alias("f1_score"),
        )
    )
