"""The kept state equals a full recount, whatever the order and repetition of its updates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leadwright.operators import monitor as mn
from leadwright.operators import woe as wo
from leadwright.operators.monitor_state import MonitorState

BINS = wo.bins_from_breaks({"s": [20, 40], "g": ["a", "b"]})


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(30)), rng.choice([None, *range(0, 60, 3)]), rng.choice(["a", "b", "c", None]),
             rng.choice([0, 0, 1, None])) for _ in range(900)]
    return spark.createDataFrame([*data, (None, 5, "a", 1)], "day date, s int, g string, y int")


def test_updates_equal_a_recount(spark, rows, tmp_path):
    state = MonitorState(str(tmp_path / "state"), BINS)
    day = F.col("day")
    state.freeze(rows.where(day < "2024-01-10"))
    third = rows.where(day > "2024-01-20")
    for part in (third, rows.where(day <= "2024-01-10"), rows.where(day.between("2024-01-11", "2024-01-20")), third, third):
        state.update(part, "day", "s", "y")
    keys = lambda df: sorted((r["week"], r["n"], r["positives"], round(r["auc"], 12), round(r["ks"], 12)) for r in df.collect())
    assert keys(state.weekly_performance(spark)) == keys(mn.weekly_performance(rows, "s", "y", "day"))
    got = {r["variable"]: (round(r["psi"], 12), r["n_bins"], r["shifted"]) for r in state.stability(spark, F.col("dt") >= "2024-01-15").collect()}
    want = mn.psi(rows.where(day < "2024-01-10"), rows.where(day >= "2024-01-15"), BINS)
    assert got == {r["variable"]: (round(r["psi"], 12), r["n_bins"], r["shifted"]) for r in want.collect()}


def test_matured_labels_replace_their_day_alone(spark, rows, tmp_path):
    state = MonitorState(str(tmp_path / "state"), BINS)
    state.update(rows, "day", "s", "y")
    count = lambda: {r["dt"]: r["pos"] for r in spark.read.parquet(str(tmp_path / "state/scores")).groupBy("dt").agg(F.sum("pos").alias("pos")).collect()}
    before, one = count(), dt.date(2024, 1, 5)
    state.update(rows.where(F.col("day") == "2024-01-05").withColumn("y", F.lit(1)), "day", "s", "y")
    after = count()
    assert {d: n for d, n in after.items() if d != one} == {d: n for d, n in before.items() if d != one}
    assert after[one] == rows.where((F.col("day") == "2024-01-05") & F.col("s").isNotNull()).count() > before[one]
