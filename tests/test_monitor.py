"""Stability, triggers, new categories and rule changes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadwright.operators import monitor as mn
from leadwright.operators import woe as wo

BINS = wo.bins_from_breaks({"x": [2, 4], "g": ["a", "b"]})


def test_psi_of_itself_is_zero(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c"), (9, None)], "x int, g string")
    assert all(abs(r.psi) < 1e-12 and not r.shifted for r in mn.psi(df, df, BINS).collect())


def test_psi_sees_a_shift_and_a_new_value(spark):
    old = spark.createDataFrame([(1, "a")] * 9 + [(3, "b")], "x int, g string")
    new = spark.createDataFrame([(1, "a")] + [(3, "z")] * 9, "x int, g string")
    rows = {r.variable: r for r in mn.psi(old, new, BINS).collect()}
    assert rows["x"].psi == pytest.approx(2 * 0.8 * 2.1972245773362196) and rows["x"].shifted
    assert rows["g"].n_bins == 3 and rows["g"].shifted


def test_trigger_needs_two_consecutive_weeks(spark):
    def week(n):
        return dt.date(2024, 1, 1) + dt.timedelta(weeks=n)
    weeks = spark.createDataFrame(
        [(week(0), 0.7, 0.2), (week(1), 0.7, 0.4), (week(2), 0.6, 0.4), (week(3), 0.7, 0.1), (week(5), 0.6, 0.1), (week(6), None, None)],
        "week date, auc double, ks double")
    got = {r.week: r.trigger for r in mn.retrain_trigger(weeks).collect()}
    assert got == {week(0): False, week(1): False, week(2): False, week(3): True, week(5): False, week(6): False}


def test_new_categories(spark):
    df = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "g string")
    rows = mn.new_categories(df, {"g": ["a", "b"]}).collect()
    assert [(r.category, r.n, r.share) for r in rows] == [("z", 2, 0.5)]
    assert mn.new_categories(df, {"g": ["a", "b"]}, min_share=0.6).count() == 0


def test_points_diff(spark):
    schema = "variable string, bin string, points int"
    old = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("basepoints", None, 300)], schema)
    new = spark.createDataFrame([("x", "a", 5), ("x", "c", 7), ("basepoints", None, 310)], schema)
    got = {(r.variable, r.bin): (r.old_points, r.new_points, r.change) for r in mn.points_diff(old, new).collect()}
    assert got == {("x", "a"): (1, 5, 4), ("x", "b"): (2, None, -2), ("x", "c"): (None, 7, 7), ("basepoints", None): (300, 310, 10)}
