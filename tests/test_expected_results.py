"""Every query against its SQL on the smallest test tables, and the shape of the plans."""

from pathlib import Path

import pytest

from fleetgauge.plans.catalog import CATALOG
from oracle.compare import connect, difference
from oracle.statements import statements

FOLDER = "/root/testdata/sf0.001"
SQL = statements()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, duck, name):
    assert difference(CATALOG[name](spark, FOLDER), duck, SQL[name]) == ""


def test_every_statement_belongs_to_a_query():
    assert set(SQL) == set(CATALOG)


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# These write files while the query is put together, or list fixed labels or feeds.
EAGER = {"materialize_layers", "check_suite", "replace_sink", "snapshot_range", "streamed_feed_quality", "streamed_findings", "marts_by_day",
         "load_raw", "checks_while_writing"}


@pytest.mark.parametrize("name", sorted(set(CATALOG) - EAGER))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = physical_plan(CATALOG[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "PythonUDF"):
        assert operator not in plan, operator


# One task orders: a result of few rows, a day-grain table, or nothing at all.
@pytest.mark.parametrize(
    "name",
    [
        "realtime_stop_time_updates",
        "scheduled_stop_times_normalized",
        "stop_time_schedule_vs_actual",
        "trip_schedule_vs_actual",
        "quality_duplicate_vehicle_entities",
        "quality_realtime_trip_referential_integrity",
        "fct_route_realtime_activity",
        "fct_on_time_performance",
        "fct_headway",
    ],
)
def test_fact_tables_are_never_gathered(spark, name):
    assert "SinglePartition" not in physical_plan(CATALOG[name](spark, FOLDER))


def test_scans_read_only_what_a_query_needs(spark):
    plan = physical_plan(CATALOG["quality_duplicate_vehicle_entities"](spark, FOLDER))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan
    plan = physical_plan(CATALOG["assert_match_rate"](spark, FOLDER))
    assert "value" not in plan and "o_orderstatus" not in plan


def scans(df, table):
    """Scans of a table in the plan that was run, each reused exchange counted once."""
    df.collect()
    return physical_plan(df).partition("== Initial Plan ==")[0].count(f"/{table}.parquet")


# Both feeds come from events; the marts on stops read events and lineitem once more.
@pytest.mark.parametrize(
    ("name", "most"),
    [
        ("quality_snapshot_freshness", 2),
        ("feed_quality_summary", 2),
        ("fct_feed_quality", 2),
        ("fct_anomaly_findings", 5),
        ("synthetic_anomaly_evaluation", 4),
    ],
)
def test_inputs_are_read_once(spark, name, most):
    assert 0 < scans(CATALOG[name](spark, FOLDER), "events") <= most
