"""Days of a stored table are replaced all at once."""

from pathlib import Path

import pytest
from pyspark.sql import types as T

from fleetgauge.sources import tables
from fleetgauge.sources.tables import read_days, replace_days, replace_sink

SCHEMA = T.StructType().add("name", "string").add("snapshot_date", "string")


@pytest.fixture
def days(spark):
    return lambda *pairs: spark.createDataFrame([(name, day) for day, name in pairs], SCHEMA)


def content(spark, path, only=None):
    return sorted((r.snapshot_date, r.name) for r in read_days(spark, path, SCHEMA, only).collect())


def test_days_are_replaced_emptied_and_kept(spark, days, tmp_path):
    path = str(tmp_path / "t")
    assert content(spark, path) == []
    assert replace_days(days(("1", "a"), ("2", "b"), ("3", "c"), ("9", "not asked for")), path, "123") == 3
    assert replace_days(days(("2", "B")), path, ["2", "3"]) == 1
    assert content(spark, path) == [("1", "a"), ("2", "B")]
    assert content(spark, path, ["2", "5"]) == [("2", "B")]
    opened = read_days(spark, path, SCHEMA, ["2"]).inputFiles()
    assert opened and all("snapshot_date=2" in file for file in opened)


@pytest.mark.parametrize("step", ["replace_sink", "child_names", "_put_list"])
def test_a_failure_before_the_switch_leaves_the_old_state(spark, days, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    replace_days(days(("1", "a"), ("2", "b")), path, "12")
    reader = read_days(spark, path, SCHEMA)

    def fail(*_, **__):
        raise OSError("lost")

    real = getattr(tables, step)
    monkeypatch.setattr(tables, step, lambda *a, **b: fail() if step != "child_names" or "_rows" in a[1] else real(*a, **b))
    with pytest.raises(OSError, match="lost"):
        replace_days(days(("1", "A")), path, "12")
    monkeypatch.undo()
    assert content(spark, path) == [("1", "a"), ("2", "b")] == sorted((r.snapshot_date, r.name) for r in reader.collect())
    assert replace_days(days(("1", "A")), path, "12") == 1
    # Whoever had opened the table before the switch still reads what it opened.
    assert reader.count() == 2 and content(spark, path) == [("1", "A")]


def test_old_versions_go(spark, days, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        replace_days(days(("1", f"a{n}"), ("2", "b")), path, "1" if n else "12")
    assert content(spark, path) == [("1", "a4"), ("2", "b")]
    left = [p for p in Path(path).rglob("*.parquet")]
    assert len(left) == 3 and len(list(Path(path, "_lists").glob("list-*"))) == 2


def test_a_table_written_whole_is_taken_over(spark, days, tmp_path):
    path = str(tmp_path / "t")
    replace_sink(days(("1", "a"), ("2", "b")), path, as_path=True, partition_by=("snapshot_date",))
    assert content(spark, path) == [("1", "a"), ("2", "b")]
    replace_days(days(("2", "B"), ("3", "c")), path, "23")
    assert content(spark, path) == [("1", "a"), ("2", "B"), ("3", "c")]
    replace_sink(days(("7", "z")), path, as_path=True, partition_by=("snapshot_date",))
    assert content(spark, path) == [("7", "z")]


def test_a_second_writer_is_refused(spark, days, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_days(days(("1", "a")), path, "1")
    monkeypatch.setattr(tables, "_last_list", lambda *_: (0, {}))
    with pytest.raises(RuntimeError, match="another writer"):
        replace_days(days(("1", "b")), path, "1")
    monkeypatch.undo()
    assert content(spark, path) == [("1", "a")]
