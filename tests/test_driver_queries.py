"""Registered queries against their SQL twins on the smallest tables, and the entry points.

The driver compares all of them; here are those that cross most modules.
"""

import pytest

import __spark_entry__ as entry_points
from .compare import connect, difference
from .conftest import DATA

SOME = ["hot_path_all", "hot_path_longest_overlapping", "hot_path_counts", "detail_sample", "early_variant",
        "chain_summary", "late_drop_arrival", "shed_policies", "clean_numeric", "compare_counts", "poll_news",
        "trip_flags", "month_folders", "stream_hot_paths"]


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", SOME)
def test_query(spark, con, name):
    assert difference(spark, con, DATA, entry_points.queries()[name], entry_points.oracle_sql()[name]) is None


def test_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 212


def test_one_shuffle(spark, events):
    """Matching costs one shuffle of the trips; the late drop and the match share it. Listing all chains reads
    the trips twice, and the pairs and the places they start at meet by (bike, place): four shuffles at most."""
    from pedalpath import hot_paths
    from pedalpath.plans.driver_trips import event_trips
    from pedalpath.session import written
    trips = written(event_trips(events, True), "trips")
    for mode, shuffles in (("longest", 1), ("all", 4)):
        df = hot_paths(trips, mode)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        found = final.count("Exchange hashpartitioning") - final.count("ReusedExchange")
        assert found == shuffles or mode == "all" and found <= shuffles
        assert "Exchange SinglePartition" not in final and "BatchEvalPython" not in final
