"""CSV files with line breaks in quoted cells, cut into splits at any byte."""

import csv
import io
import random
import re

import pytest

from fleetgauge.sources.quoted_csv import has_quoted_breaks, quoted_records, scan_quoted_csv
from fleetgauge.sources.schedule import scan_static_csv

CELLS = ("", "plain", 'a "quoted" word', "one\ntwo", "\n\n", "x,y", '"', '""\n"', "two\r\nlines", " pad ", "Straße\n日本")


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, rows, end="\n"):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["trip_id", "stop_headsign", "stop_id"])
    for row in rows:
        writer.writerow(row)
    path.write_bytes(text.getvalue().encode())
    return str(path)


def some_rows(seed, n):
    random.seed(seed)
    return [(f"t{i}", random.choice(CELLS), random.choice(CELLS)) for i in range(n)]


@pytest.mark.parametrize("size", [64, 101, 1_000, 1 << 20])
def test_any_split_gives_the_same_records(spark, tmp_path, small_splits, size):
    rows = some_rows(size, 200)
    paths = []
    for name, part in (("a", rows[:120]), ("b", rows[120:])):
        (tmp_path / name).mkdir()
        paths.append(write(tmp_path / name / "stop_times.txt", part))
    small_splits(size)
    assert has_quoted_breaks(spark, paths)
    found = scan_static_csv(spark, paths)
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    if size == 64:
        splits = quoted_records(spark, paths)._jdf.queryExecution().sparkPlan().toString()
        assert splits.count("FileScan text") >= 2
        assert spark.read.text(paths).rdd.getNumPartitions() > 50


def test_windows_line_ends(spark, tmp_path):
    rows = [row for row in some_rows(3, 60) if "\r" not in "".join(row)]
    path = write(tmp_path / "stop_times.txt", rows, "\r\n")
    assert sorted(map(tuple, scan_quoted_csv(spark, [path]).collect())) == sorted(rows)


def test_files_without_breaks_are_scanned_as_they_are(spark, tmp_path):
    path = write(tmp_path / "stop_times.txt", [("1", 'a "b"', "x,y"), ("2", "", "z")])
    assert not has_quoted_breaks(spark, [path])
    plan = scan_static_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "Exchange" not in plan
    assert sorted(map(tuple, scan_static_csv(spark, path).collect())) == [("1", 'a "b"', "x,y"), ("2", "", "z")]


def test_blank_lines_and_a_mark_at_the_start(spark, tmp_path):
    path = tmp_path / "stop_times.txt"
    path.write_bytes('﻿trip_id,stop_headsign\n\n1,"a\n\nb"\n   \n\n2,c\n'.encode())
    found = scan_static_csv(spark, str(path))
    assert found.columns == ["trip_id", "stop_headsign"]
    assert sorted(map(tuple, found.collect())) == [("1", "a\n\nb"), ("2", "c")]


def test_header_text_within_the_data_is_a_row(spark, tmp_path):
    path = write(tmp_path / "stop_times.txt", [("trip_id", "stop_headsign", "stop_id"), ("1", "a\nb", "c")])
    assert scan_static_csv(spark, path).count() == 2


def test_what_cannot_be_read_is_refused(spark, tmp_path):
    open_cell = tmp_path / "stop_times.txt"
    open_cell.write_text('trip_id,stop_id\n1,"a\n2,b\n', encoding="utf-8")
    with pytest.raises(ValueError, match="does not end.*stop_times"):
        scan_static_csv(spark, str(open_cell))
    (tmp_path / "long").mkdir()
    too_many = tmp_path / "long" / "stop_times.txt"
    too_many.write_text('trip_id,stop_id\n1,"a\nb",c\n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        scan_static_csv(spark, str(too_many)).collect()
    paths = []
    for name, header in (("c", "trip_id,stop_id"), ("d", "stop_id,trip_id")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "stop_times.txt").write_text(f'{header}\n1,"x\ny"\n', encoding="utf-8")
        paths.append(str(tmp_path / name / "stop_times.txt"))
    with pytest.raises(ValueError, match="another header"):
        scan_static_csv(spark, paths)


def test_empty_file_and_header_alone(spark, tmp_path):
    path = tmp_path / "stop_times.txt"
    path.write_text("trip_id,stop_id\n", encoding="utf-8")
    assert scan_static_csv(spark, str(path)).columns == ["trip_id", "stop_id"]
    assert scan_quoted_csv(spark, [str(path)]).isEmpty()


def test_lines_are_dealt_by_split_and_only_open_records_gathered(spark, tmp_path, small_splits):
    path = write(tmp_path / "stop_times.txt", some_rows(5, 400))
    small_splits(500)
    plan = quoted_records(spark, [path])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and not re.search("Python|Pandas|Arrow", plan)


def test_a_record_over_many_splits_and_lines_dealt_without_their_paths(spark, tmp_path, small_splits):
    rows = [("1", "a\n" * 400, "b"), ("2", "c", "d"), ("3", "\n", "e"), ("4", "plain", "f" * 300), ("5", "\n" * 90, "g")]
    paths = []
    for name, part in (("a", rows), ("b", rows[::-1])):
        (tmp_path / name).mkdir()
        paths.append(write(tmp_path / name / "stop_times.txt", part))
    small_splits(64)
    assert sorted(map(tuple, scan_quoted_csv(spark, paths).collect())) == sorted(rows * 2)
    by_file = {}
    for row in quoted_records(spark, paths).collect():
        by_file.setdefault(row.file[-17:], []).append(next(csv.reader(io.StringIO(row.record, newline="")))[0])
    assert {name: sorted(ids) for name, ids in by_file.items()} == {f"/{x}/stop_times.txt": list("12345") for x in "ab"}
    plan = scan_quoted_csv(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(split#", plan)
    assert not re.search(r"Exchange hashpartitioning\(file#\w+, goes_on#", plan)
