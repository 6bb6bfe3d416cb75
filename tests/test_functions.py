import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions import (
    finding_id,
    late_by_seconds,
    lenient_double,
    lenient_int,
    number_from_json,
    ratio_or_zero,
    seconds_between,
    snapshot_folder_name,
    with_clock_seconds,
)


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("7:05:00", 25500),
        ("25:10:00", 90600),
        ("00:00:00", 0),
        ("12:60:00", None),
        ("12:00:60", None),
        ("12:00", None),
        ("", None),
        ("abc", None),
        ("-1:00:00", -3600),
        ("99999999999:00:00", None),
        ("1:2:3:4", 3723),
        (None, None),
    ],
)
def test_clock(rows, text, expected):
    df = with_clock_seconds(rows("t string", (text,)), {"t": "s"})
    assert df.columns == ["t", "s"]
    assert df.first()["s"] == expected
    assert df.schema["s"].dataType.simpleString() == "int"


def test_lenient_int_of_text(rows):
    texts = ["5", " 5 ", "+7", "1.5", "2.5", "-2.5", "1e3", "", "x", "5d", "3000000000", None]
    df = rows("t string", *[(t,) for t in texts])
    assert column(df, lenient_int(df, "t")) == [5, 5, 7, 2, 3, -3, 1000, None, None, None, None, None]


def test_lenient_int_of_double_rounds_half_to_even(rows):
    df = rows("t double", (2.5,), (3.5,), (1e12,))
    assert column(df, lenient_int(df, "t")) == [2, 4, None]


def test_lenient_double(rows):
    df = rows("t string", ("40.5",), ("-73",), ("1e2",), ("5f",), ("",), ("n/a",), (None,))
    assert column(df, lenient_double(df, "t")) == [40.5, -73.0, 100.0, None, None, None, None]


def test_number_from_json(rows):
    df = rows("t string", ("1788393000",), ("1.788393E9",), ("2.5",), ("3.5",), ("abc",), ("",), (None,))
    expected = [1788393000, 1788393000, 2, 4, None, None, None]
    assert column(df, number_from_json(F.col("t"), "bigint")) == expected


def test_seconds_between_counts_whole_seconds(rows):
    df = rows(
        "a timestamp, b timestamp", (datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000))
    )
    assert column(df, seconds_between(F.col("a"), F.col("b"))) == [1]


def test_service_day(rows):
    # Local midnight is 04:00 UTC.
    df = rows(
        "t timestamp, s int",
        (datetime(2024, 1, 2, 4, 0), 0),
        (datetime(2024, 1, 2, 3, 59, 59), 86_400),
        (datetime(2024, 1, 2, 5, 12), 90_600),
        (datetime(2024, 1, 2, 5, 12), None),
        (None, 90_600),
    )
    late = late_by_seconds(F.col("t"), F.col("s"))
    assert column(df, late) == [0, -1, 4320 - 90_600, None, None]
    nearest = late_by_seconds(F.col("t"), F.col("s"), service_day="nearest")
    assert column(df, nearest) == [0, -1, 120, None, None]
    with pytest.raises(ValueError):
        late_by_seconds(F.col("t"), F.col("s"), service_day="other")


def test_finding_id_is_null_for_a_null_key(rows):
    df = rows("a string, b string", ("x", "y"), ("x", None))
    first, second = column(df, finding_id("rule", "a", "b"))
    assert first == hashlib.md5(b"rule|x|y").hexdigest()
    assert second is None


def test_ratio_or_zero(rows):
    df = rows("a int, b int", (1, 4), (3, 0))
    assert column(df, ratio_or_zero(F.col("a"), F.col("b"))) == [0.25, 0.0]


def test_snapshot_folder_name(rows):
    df = rows("t timestamp", (datetime(2025, 2, 3, 4, 5, 6),))
    assert column(df, snapshot_folder_name(F.col("t"))) == ["snapshot_20250203_040506"]
