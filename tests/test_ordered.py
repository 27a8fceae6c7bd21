"""Positions and running sums against plain Python."""

import random
from collections import defaultdict

from conftest import plan_text
from pyspark.sql import functions as F

from leadwright.operators import ordered as od


def rows(seed=0, n=3000):
    rnd = random.Random(seed)
    return [(("hot" if rnd.random() < 0.4 else rnd.choice("abc")), rnd.randrange(50), i, rnd.randrange(5)) for i in range(n)]


def test_positions_are_one_to_n(spark):
    data = rows()
    df = spark.createDataFrame(data, "g string, s int, id int, v int").repartition(7)
    got = {r.id: r.position for r in od.with_position(df, [F.col("s").desc(), "id"]).collect()}
    want = {r[2]: i + 1 for i, r in enumerate(sorted(data, key=lambda r: (-r[1], r[2])))}
    assert got == want


def test_running_sums_in_groups(spark):
    data = rows(1)
    df = spark.createDataFrame(data, "g string, s int, id int, v int").repartition(7)
    got = {r.id: (r.cum_v, r.total_v) for r in od.running_sums(df, ["g"], ["s", "id"], {"v": "v"}).collect()}
    totals, cum, want = defaultdict(int), defaultdict(int), {}
    for g, *_, v in data:
        totals[g] += v
    for g, s, i, v in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        cum[g] += v
        want[i] = (cum[g], totals[g])
    assert got == want


def test_running_sums_without_groups(spark):
    data = rows(2, 500)
    df = spark.createDataFrame(data, "g string, s int, id int, v int")
    got = {r.id: r.cum_v for r in od.running_sums(df, [], ["id"], {"v": "v"}).collect()}
    cum = 0
    for _, _, i, v in data:
        cum += v
        assert got[i] == cum


def test_row_numbers_per_key(spark):
    data = rows(3)
    df = spark.createDataFrame(data, "g string, s int, id int, v int").repartition(5)
    got = {r.id: r.n for r in od.number_rows_by(df, "g", ["s", "id"], "n").collect()}
    seen = defaultdict(int)
    for g, _, i, _ in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        seen[g] += 1
        assert got[i] == seen[g]


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 1, 1, 0), (None, 2, 2, 0), ("a", 1, 3, 0), (None, 3, 4, 0)], "g string, s int, id int, v int")
    assert {(r.id, r.n) for r in od.number_rows_by(df, "g", ["s", "id"], "n").collect()} == {(1, 1), (2, 2), (3, 1), (4, 3)}


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, s int, id int, v int")
    assert od.with_position(df, ["s"]).count() == 0
    assert od.running_sums(df, ["g"], ["s"], {"v": "v"}).count() == 0


def test_rows_are_spread_over_slices(spark):
    df = spark.range(20000).select(F.lit("one").alias("g"), F.col("id"))
    sliced = od._sorted_slices(df, ["g", "id"])
    assert sliced.select("_slice").distinct().count() > 1  # one key, several tasks


def test_window_over_rows_is_partitioned(spark):
    df = spark.createDataFrame(rows(4, 200), "g string, s int, id int, v int")
    text = plan_text(od.with_position(df, ["s", "id"]))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert all("_n" in line for line in windows)  # only the slice sizes go through a window
