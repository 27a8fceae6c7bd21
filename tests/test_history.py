"""The version valid on a day, against all pairs."""

import datetime
import random

import pytest

from conftest import plan_text
from leadwright.operators.history import interval_index, valid_and_last, valid_version_join, version_on

D, T = datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1)
HISTORY = "user long, seen timestamp_ntz, start date, end date, n int, row string"
LEADS = "lead long, user long, at timestamp_ntz, start int"


def day(n):
    return None if n is None else D + datetime.timedelta(days=n)


def moment(hours):
    return None if hours is None else T + datetime.timedelta(hours=hours)


def brute(leads, history, included):
    out = []
    for lead, user, hours, _ in leads:
        valid = last = None
        if user is not None and hours is not None:
            on = hours // 24
            able = [h for h in history if h[0] == user and h[2] is not None and h[2] <= on and (h[3] is None or on <= h[3] - (not included))]
            valid = max(able, key=lambda h: (h[2], h[1] is not None, h[1] or 0, h[4]), default=None)
            before = [h for h in history if h[0] == user and h[1] is not None and h[1] < hours]
            last = max(before, key=lambda h: (h[1], h[4]), default=None)
        out.append((lead, user, moment(hours), *([valid[4], valid[5]] if valid else [None, None]), *([last[4], last[5]] if last else [None, None])))
    return sorted(out, key=str)


def frames(spark, leads, history):
    return (spark.createDataFrame([(a, b, moment(c), d) for a, b, c, d in leads], LEADS),
            spark.createDataFrame([(u, moment(s), day(a), day(b), n, r) for u, s, a, b, n, r in history], HISTORY))


@pytest.mark.parametrize("included", [True, False])
def test_overlapping_open_and_hot(spark, included):
    rng = random.Random(4)
    user = lambda: rng.choice([1] * 8 + [2, 3, 4, None])  # noqa: E731  two thirds of the rows are of one user
    history = [(user(), rng.choice([None, rng.randrange(0, 1500)]), s := rng.choice([None, rng.randrange(0, 60), -800]),
                None if rng.random() < 0.15 else (s or 0) + rng.choice([-1, 0, 0, 1, 3, 30, 900]), i, f"r{i}") for i in range(300)]
    leads = [(i, user(), rng.choice([None, rng.randrange(-48, 1700)]), 5) for i in range(200)]
    given, rows = frames(spark, leads, history)
    got = valid_and_last(given, rows, "user", "at", "seen", "start", "end", ["n", "row"], ["n"], included)
    assert got.columns == [*given.columns, "valid_n", "valid_row", "last_n", "last_row"]
    found = [(r["lead"], r["user"], r["at"], r["valid_n"], r["valid_row"], r["last_n"], r["last_row"]) for r in got.collect()]
    assert sorted(found, key=str) == brute(leads, history, included)


def test_index_is_small_and_no_pairs_are_made(spark):
    history = [(1, 5, 0, None, i, "x") for i in range(5000)]  # one user, every version open
    given, rows = frames(spark, [(i, 1, 24 * (i % 50), 0) for i in range(3000)], history)
    index = interval_index(rows, "user", "start", "end", ["start"], ["n"])
    assert index.count() <= 2 * 17
    found = valid_version_join(given, rows, "user", "at", "start", "end", ["n"])
    assert found.where("valid_n = 4999").count() == 3000
    assert "CartesianProduct" not in plan_text(found) and "NestedLoop" not in plan_text(found)


def test_empty_sides(spark):
    given, rows = frames(spark, [(1, 1, 5, 0)], [(1, 3, 0, 9, 1, "x")])
    assert [r["valid_n"] for r in valid_version_join(given, rows.limit(0), "user", "at", "start", "end", ["n"]).collect()] == [None]
    assert valid_version_join(given.limit(0), rows, "user", "at", "start", "end", ["n"]).count() == 0


def test_days_outside_the_tree(spark):
    far = datetime.date(2500, 1, 1)
    given = spark.createDataFrame([(1, 1, datetime.datetime(1960, 5, 5), 0), (2, 1, datetime.datetime(2149, 6, 5), 0)], LEADS)
    rows = spark.createDataFrame([(1, None, datetime.date(1900, 1, 1), far, 7, "x")], HISTORY)
    assert {r["lead"]: r["valid_n"] for r in valid_version_join(given, rows, "user", "at", "start", "end", ["n"]).collect()} == {1: None, 2: 7}


def test_no_side_of_the_node_lookup_is_broadcast(spark, tmp_path):
    """A day is 17 rows in the lookup; an estimate that takes it for one row must not send them through the driver."""
    leads, history = frames(spark, [(i, i % 5, i * 7, 0) for i in range(60)], [(i % 5, i, i // 24, None, i, "r") for i in range(60)])
    leads.write.parquet(str(tmp_path / "leads")), history.write.parquet(str(tmp_path / "history"))
    leads, history = spark.read.parquet(str(tmp_path / "leads")), spark.read.parquet(str(tmp_path / "history"))
    index = interval_index(history, "user", "start", "end", ["start", "n"], ["n"])
    assert "Broadcast" not in plan_text(version_on(leads, "user", "at", index))
