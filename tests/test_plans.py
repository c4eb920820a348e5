"""What the plans look like: pushed filters, pruned columns, no cross join, no Python."""

import contextlib
import io
import re

import pytest

from checks.jobs import QUERIES
from checks.views import view
from concord.plans import trips

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_worker(spark, name):
    """One query is about the predicate over Arrow arrays, which has one step for all its fields."""
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        if (name, bad) == ("identifier_matcher_arrow", "ArrowEvalPython"):
            assert len(re.findall(r"^\(\d+\) ArrowEvalPython", text, re.M)) == 1
        else:
            assert bad not in text


def _tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ("supplier_dim", "alias_table", "prior_period", "name_standardised", "catalog_keep_none", "first_orders"))
def test_whole_rows_are_not_aggregated(spark, name):
    assert "SortAggregate" not in _tree(QUERIES[name](spark, SF))


def test_a_task_sends_one_row_of_a_key(spark):
    tree = _tree(QUERIES["supplier_dim"](spark, SF))
    assert tree.index("Final") < tree.index("Exchange") < tree.index("Partial") and "WindowGroupLimit" in tree


@pytest.mark.parametrize("name", ("fk_from_tables", "lineage_from_tables"))
def test_bucketed_tables_are_joined_in_place(shuffled, name):
    """Nothing below the innermost join is exchanged."""
    lines = _tree(QUERIES[name](shuffled, SF)).splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    join = max((i for i, x in enumerate(lines) if "SortMergeJoin" in x), key=lambda i: depth[i])
    below = next((i for i in range(join + 1, len(lines)) if depth[i] <= depth[join]), len(lines))
    assert not any("Exchange" in x for x in lines[join:below])


def test_day_window_reaches_the_scan(spark):
    raw = spark.read.parquet(f"{SF}/events.parquet")
    named = raw.selectExpr(
        "event_id AS trip_id", "user_id AS taxi_id", "ts AS trip_start_timestamp", "ts AS trip_end_timestamp",
        "event_id AS trip_seconds", "value AS trip_miles", "value AS fare", "value AS tips", "value AS tolls",
        "value AS extras", "event_type AS payment_type", "event_type AS company",
        "user_id AS pickup_community_area", "user_id AS dropoff_community_area",
    )
    text = plan(trips.daily_metrics(trips.clean_trips(named)))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(ts,2024-01-01" in pushed and "LessThan(ts,2024-02-01" in pushed
    assert "GreaterThanOrEqual(value,0.0)" in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "props" not in schema and "event_type" not in schema


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_window_over_one_partition(spark, name):
    """A window is never fed by a shuffle into a single partition."""
    lines = [x for x in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()]
    for i, line in enumerate(lines):
        if re.search(r"[ +:-]Window \[", line):
            assert not any("SinglePartition" in x for x in lines[i : i + 4]), line


def test_marts_are_written_by_day(spark, tmp_path):
    tables = trips.write_marts(view(spark, SF, "v_trips"), str(tmp_path))
    days = {p.name for p in (tmp_path / "trips_clean").glob("trip_date=*")}
    assert len(days) == tables["daily_metrics"].count() > 20
    assert tables["trips_clean"].count() == 754
    busiest = [r["trip_count"] for r in tables["zone_performance"].collect()]
    assert sum(busiest) > 0
    none = trips.clean_trips(view(spark, SF, "v_trips"), "2030-01-01", "2030-01-31")
    assert none.isEmpty() and trips.daily_metrics(none).isEmpty()
