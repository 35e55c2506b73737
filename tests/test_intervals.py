import pytest
from pyspark.sql import functions as F

from conftest import day
from hvault.operators.intervals import REFERENCE, STRICT, close_on_next, merge_intervals
from hvault.plans.mart import as_of


def _merge(spark, rows, mode):
    df = spark.createDataFrame([("k", day(s), day(e)) for s, e in rows], "k string, create_dttm timestamp_ntz, delete_dttm timestamp_ntz")
    out = merge_intervals(df, "k", mode=mode).orderBy("create_dttm").collect()
    inv = lambda t: None if t is None else (t - day(0)).days
    return [(inv(r.create_dttm), inv(r.delete_dttm)) for r in out]


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_touching_intervals_merge(spark, mode):
    assert _merge(spark, [(1, 3), (3, 5)], mode) == [(1, 5)]


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_gap_keeps_both(spark, mode):
    assert _merge(spark, [(1, 3), (4, 5)], mode) == [(1, 3), (4, 5)]


def test_contained_interval_reference_compares_with_previous_row_only(spark):
    assert _merge(spark, [(1, 10), (2, 3), (5, 6)], REFERENCE) == [(1, 10), (5, 6)]


def test_contained_interval_strict_uses_running_max(spark):
    assert _merge(spark, [(1, 10), (2, 3), (5, 6)], STRICT) == [(1, 10)]


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_open_end_and_null_start(spark, mode):
    assert _merge(spark, [(1, None), (2, 3), (None, 9)], mode) == [(1, None)]


def test_close_on_next_and_as_of(spark):
    states = spark.createDataFrame(
        [("u", 1, "a", day(1)), ("u", 2, "b", day(5)), ("v", 3, "c", day(2))],
        "k string, id int, state string, effective_from_dttm timestamp_ntz",
    )
    closed = close_on_next(states, "k", tie_break=("id",))
    rows = {r.id: r.effective_to_dttm for r in closed.collect()}
    assert rows[1] == day(5) and rows[2].year == 2999 and rows[3].year == 2999
    probes = spark.createDataFrame([("u", 10, day(0)), ("u", 11, day(3)), ("u", 12, day(5)), ("v", 13, day(9)), ("w", 14, day(9))], "k string, pid int, at timestamp_ntz")
    got = {r.pid: r.state for r in as_of(probes, closed, "k", "at", order=("id",), carry=("state",)).collect()}
    assert got == {10: None, 11: "a", 12: "b", 13: "c", 14: None}
