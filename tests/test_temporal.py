"""Point-in-time operators against brute force, with a hot key and a hot instant."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from leadwright.operators import temporal as tp

T0 = dt.datetime(2024, 1, 1)
SCHEMA_P = "k bigint, at timestamp_ntz"
SCHEMA_E = "k bigint, ts timestamp_ntz, v bigint"


def data(seed, n=400):
    """A third of all rows belongs to key 0, many of them copies at one instant."""
    rnd = random.Random(seed)

    def key():
        return 0 if rnd.random() < 0.4 else rnd.choice([1, 2, 3, None])

    def moment(k):
        if k == 0 and rnd.random() < 0.5:
            return T0 + dt.timedelta(hours=50)
        return T0 + dt.timedelta(hours=rnd.randrange(100))

    probes = [(k, moment(k)) for k in (key() for _ in range(n // 4))]
    events = [(k, moment(k), rnd.randrange(20)) for k in (key() for _ in range(n))]
    return probes, events + [(0, T0 + dt.timedelta(hours=50), 7)] * 50


def brute(probes, events, strict):
    out = {}
    for k, at in set(probes):
        if k is None:
            continue
        seen = [(ts, v) for ek, ts, v in events if ek == k and (ts < at if strict else ts <= at)]
        week = [e for e in seen if e[0] < at - dt.timedelta(hours=24)]
        out[k, at] = (
            max(seen)[1] if seen else None, sum(v for _, v in seen) if seen else None,
            min((t for t, _ in seen), default=None), max((t for t, _ in seen), default=None), len(week),
        )
    return out


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_point_in_time_matches_brute_force(spark, seed, strict):
    probes, events = data(seed)
    p, e = spark.createDataFrame(probes, SCHEMA_P), spark.createDataFrame(events, SCHEMA_E)
    measures = {
        "last": ("last", F.struct("v")), "total": ("sum", F.col("v")), "n": ("sum", F.lit(1)),
        "first_ts": ("min", F.col("ts")), "last_ts": ("max", F.col("ts")),
    }
    found = tp.point_in_time(
        p, "k", "at", [tp.Source(e, "ts", measures)], strict,
        earlier={"day": lambda at: at - F.expr("INTERVAL 24 HOURS")},
    ).collect()
    want = brute(probes, events, strict)
    assert len(found) == len(want)
    for r in found:
        last, total, first_ts, last_ts, n_day = want[r["k"], r["at"]]
        assert (r["last"]["v"] if r["last"] else None, r["total"], r["first_ts"], r["last_ts"]) == (last, total, first_ts, last_ts)
        # the earlier moment is always exclusive of later events; at the very moment strictness decides
        if strict:
            assert (r["n_day"] or 0) == n_day


def test_two_sources_share_one_timeline(spark):
    probes = spark.createDataFrame([(1, T0 + dt.timedelta(hours=5))], SCHEMA_P)
    a = spark.createDataFrame([(1, T0 + dt.timedelta(hours=h), h) for h in range(10)], SCHEMA_E)
    b = spark.createDataFrame([(1, T0 + dt.timedelta(hours=1), 3), (2, T0, 9)], SCHEMA_E)
    row = tp.point_in_time(probes, "k", "at", [
        tp.Source(a, "ts", {"na": ("sum", F.lit(1))}), tp.Source(b, "ts", {"vb": ("last", F.col("v"))})]).first()
    assert (row["na"], row["vb"]) == (5, 3)


def test_only_the_strictly_earlier_row_counts(spark):
    at = T0 + dt.timedelta(hours=1)
    leads = spark.createDataFrame([(1, at)], SCHEMA_P)
    history = spark.createDataFrame([(1, at, 5), (1, at - dt.timedelta(microseconds=1), 4)], SCHEMA_E)
    assert [r.v for r in tp.asof_join(leads, history, "k", "at", "ts", ["v"]).collect()] == [4]
    assert [r.v for r in tp.asof_join(leads, history, "k", "at", "ts", ["v"], strict=False).collect()] == [5]


def test_asof_keeps_every_lead(spark):
    at = T0 + dt.timedelta(hours=1)
    leads = spark.createDataFrame([(1, at), (1, at), (2, at), (None, at), (3, None)], SCHEMA_P)
    history = spark.createDataFrame([(1, T0, 5)], SCHEMA_E)
    rows = tp.asof_join(leads, history, "k", "at", "ts", ["v"]).collect()
    assert sorted((r.k or 0, r.v or 0) for r in rows) == [(0, 0), (1, 5), (1, 5), (2, 0), (3, 0)]


def test_ties_go_to_the_tie_columns(spark):
    leads = spark.createDataFrame([(1, T0 + dt.timedelta(hours=1))], SCHEMA_P)
    history = spark.createDataFrame([(1, T0, 1, 9), (1, T0, 8, 2)], SCHEMA_E + ", valid_to int")
    assert tp.asof_join(leads, history, "k", "at", "ts", ["v"], tie=["valid_to"]).first().v == 1


def test_last_measures_come_from_one_row(spark):
    """Ties: both measures of a source from its greatest row, also where an earlier day or a NULL is in play."""
    at = T0 + dt.timedelta(days=5)
    probes = spark.createDataFrame([(1, at), (2, at)], SCHEMA_P)
    events = spark.createDataFrame(
        [(1, T0, 5, 1), (1, T0, 3, 9), (2, T0, 5, 1), (2, T0 + dt.timedelta(days=2), 2, None), (2, T0 + dt.timedelta(days=3), None, None)],
        "k bigint, ts timestamp_ntz, a int, b int")
    got = tp.point_in_time(probes, "k", "at", [tp.Source(events, "ts", {"a": ("last", F.col("a")), "b": ("last", F.col("b"))})])
    assert {(r.k, r.a, r.b) for r in got.collect()} == {(1, 5, 1), (2, 2, None)}


def test_only_events_of_asked_keys_and_times_are_read(spark, tmp_path):
    events = spark.range(10_000).select(
        (F.col("id") % 1000).alias("k"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id % 500))").alias("ts"), F.col("id").alias("v"))
    events.write.parquet(str(tmp_path / "events"))
    probes = spark.createDataFrame([(7, T0 + dt.timedelta(hours=100))], SCHEMA_P)
    got = tp.point_in_time(probes, "k", "at", [tp.Source(spark.read.parquet(str(tmp_path / "events")), "ts", {"n": ("sum", F.lit(1))})],
                           until="2024-01-05 04:00:00")
    plan = plan_text(got)
    assert "LeftSemi" in plan and "LessThan(ts,2024-01-05T04:00" in plan
    want = [sum(1 for i in range(7, 10_000, 1000) if i % 500 < 100)]
    assert [r.n for r in got.collect()] == want
    # Without a bound the last moment is looked up when the result is asked for, and not before.
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    open_end = tp.point_in_time(probes, "k", "at", [
        tp.Source(spark.read.schema("k bigint, ts timestamp_ntz, v bigint").parquet(str(tmp_path / "events")), "ts", {"n": ("sum", F.lit(1))})])
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert [r.n for r in open_end.collect()] == want and "Subquery" in plan_text(open_end)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("hot_rows", [0, 2, 10])
def test_hot_days_are_cut(spark, seed, hot_rows):
    """Days with more instants than the limit are cut into minutes; the results stay."""
    probes, events = data(seed)
    spread = [(k, at + dt.timedelta(seconds=37 * i), v) for i, (k, at, v) in enumerate(events)]
    p, e = spark.createDataFrame(probes, SCHEMA_P), spark.createDataFrame(spread, SCHEMA_E)
    found = tp.point_in_time(p, "k", "at", [tp.Source(e, "ts", {"last": ("last", F.struct("v")), "total": ("sum", F.col("v")), "n": ("sum", F.lit(1)),
                                                                "last_ts": ("max", F.col("ts"))})], hot_rows=hot_rows).collect()
    want = brute(probes, spread, True)
    got = {(r["k"], r["at"]): (r["total"], r["last_ts"], r["last"]["v"] if r["last"] else None) for r in found}
    assert got == {key: (total, last_ts, last) for key, (last, total, _, last_ts, _) in want.items()}


def test_one_user_and_one_day_of_many_instants_is_spread(spark):
    """A bot with all events on one day: its rows stand in many window partitions, and the plan shuffles the events once."""
    events = spark.range(200_000).select(F.lit(1).cast("bigint").alias("k"), F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.4)").alias("ts"), F.col("id").alias("v"))
    probes = spark.createDataFrame([(1, T0 + dt.timedelta(hours=h)) for h in range(1, 24)], SCHEMA_P)
    got = tp.point_in_time(probes, "k", "at", [tp.Source(events, "ts", {"n": ("sum", F.lit(1))})], until="2024-01-02 00:00:00", hot_rows=10_000)
    assert {r["at"].hour: r["n"] for r in got.collect()} == {h: min(h * 9000, 200_000) for h in range(1, 24)}
    plan = plan_text(got)
    assert "_slice" in plan and "ReusedExchange" in plan
    rows = events.withColumn("_ts", F.col("ts")).withColumn("_k", F.col("k"))
    sliced = tp._sliced(rows, rows.groupBy("_k", "_ts").agg(F.sum("v").alias("v")), ["v"], 10_000)
    sizes = sliced.groupBy("_k", "_day", "_slice").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] <= 150 and sizes[1] == 1334


def test_times_of_another_type_are_cast(spark):
    probes = spark.createDataFrame([(1, T0 + dt.timedelta(hours=1))], SCHEMA_P)
    events = spark.createDataFrame([(1, "2024-01-01 00:30:00"), (1, "2024-01-01 01:30:00")], "k bigint, t string").select(
        "k", F.col("t").cast("timestamp").alias("ts"))
    assert tp.point_in_time(probes, "k", "at", [tp.Source(events, "ts", {"n": ("sum", F.lit(1))})]).first().n == 1


def test_labels_have_a_lower_bound(spark):
    leads = spark.createDataFrame([(1, dt.date(2024, 1, 10)), (2, dt.date(2024, 1, 10))], "task_id bigint, alloc_date date")
    orders = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 9), "a", 1.0), (1, dt.datetime(2024, 1, 17), "b", 2.0), (1, dt.datetime(2024, 1, 17), "b", 2.0),
         (1, dt.datetime(2024, 1, 24), "c", 4.0), (1, dt.datetime(2024, 1, 25), "d", 8.0), (2, dt.datetime(2024, 1, 9), "e", 1.0)],
        "task_id bigint, policy_time timestamp_ntz, policy_no string, origin double")
    args = ("task_id", "alloc_date", "policy_time", "policy_no", "origin", [7, 14])
    row = {r.task_id: r for r in tp.conversion_labels(leads, orders, *args).collect()}
    assert (row[1].t7_policy_cnt, row[1].t7_origin, row[1].t14_policy_cnt, row[1].t14_origin) == (1, 4.0, 2, 8.0)
    assert (row[2].t14_policy_flag, row[2].t14_policy_cnt, row[2].t14_origin) == (0, 0, None)
    loose = {r.task_id: r for r in tp.conversion_labels(leads, orders, *args, lower=None).collect()}
    assert (loose[1].t14_policy_cnt, loose[2].t14_policy_flag) == (3, 1)


def test_first_and_latest_by_key(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, t int, v string")
    assert {(r.k, r.v) for r in tp.first_by(rows, "k", ["t"], ["v"]).collect()} == {("a", "y"), ("b", "z")}
    assert {(r.k, r.v) for r in tp.latest_by(rows, "k", ["t"], ["v"]).collect()} == {("a", "x"), ("b", "z")}


def test_keys_with_few_rows_stay_whole(spark):
    """A key is one window partition over all its days; only a key with very many rows is cut."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 10 + 1).cast("bigint").alias("_k"), F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(id % 20), 0, 0, id)").alias("_ts"))
    placed = tp._sliced(rows, rows, [], 10_000).select("_k", "_day", "_slice").distinct().groupBy("_k").count().collect()
    assert {r["_k"]: r["count"] for r in placed} == {0: 20, **{k: 1 for k in range(1, 11)}}
