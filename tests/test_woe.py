"""Bins, WOE and IV."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators import woe as wo


@pytest.fixture(scope="module")
def sample(spark):
    rnd = np.random.default_rng(5)
    n = 4000
    x = rnd.normal(size=n).round(2)
    g = rnd.choice(["a", "b", "c", "d"], n)
    y = (rnd.random(n) < 1 / (1 + np.exp(-(x - 2 + (g == "a"))))).astype(int)
    pdf = pd.DataFrame({"x": x, "flat": rnd.integers(0, 3, n), "g": g, "y": y})
    pdf.loc[::10, "x"] = np.nan
    pdf.loc[::17, "g"] = None
    df = spark.createDataFrame(pdf)
    return df.withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x"))).cache(), pdf


def test_labels_and_edges():
    bins = wo.bins_from_breaks({"x": ["missing", 18, 24], "g": ["a", "b"]})
    assert [b.label for b in bins] == ["missing", "[-inf,18)", "[18,24)", "[24,inf)", "missing", "a", "b"]


def test_bins_part_the_rows(spark, sample):
    df, pdf = sample
    counts = wo.bin_counts(df, wo.bins_from_breaks({"x": [-1, 0, 1], "g": ["a", "b", "c", "d"]}), "y").toPandas()
    assert counts.groupby("variable").n.sum().to_dict() == {"x": len(pdf), "g": len(pdf)}
    assert (counts.pos + counts.neg == counts.n).all()
    assert counts[(counts.variable == "x") & (counts.bin == "missing")].n.item() == pdf.x.isna().sum()


def test_woe_and_iv(spark, sample):
    df, pdf = sample
    table = wo.woe_table(wo.bin_counts(df, wo.bins_from_breaks({"x": [0]}), "y"))
    rows = {r.bin: r for r in table.collect()}
    low = pdf[pdf.x < 0]
    want = math.log((low.y.sum() / pdf.y.sum()) / ((1 - low.y).sum() / (1 - pdf.y).sum()))
    assert rows["[-inf,0)"].woe == pytest.approx(want)
    iv = wo.information_value(table).first()
    assert iv.iv == pytest.approx(sum(r.bin_iv for r in rows.values())) and iv.iv > 0


def test_empty_cells_stay_finite(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (9, 1), (9, 0)], "x int, y int")
    rows = wo.woe_table(wo.bin_counts(df, wo.bins_from_breaks({"x": [5]}), "y")).collect()
    assert all(math.isfinite(r.woe) for r in rows)
    first = next(r for r in rows if r.bin == "[-inf,5)")
    assert first.woe == pytest.approx(math.log((0.9 / 1.9) / (2 / 3)))


def test_apply_is_a_projection(spark, sample):
    df, _ = sample
    bins = wo.woe_table(wo.bin_counts(df, wo.bins_from_breaks({"x": [0], "g": ["a", "b"]}), "y"))
    out = wo.apply_woe(df, bins, ["y"])
    text = plan_text(out)
    assert "Exchange" not in text and "Join" not in text
    assert out.where(F.col("g_woe").isNull()).count() == 0
    woe = {(r.variable, r.bin): r.woe for r in bins.collect()}
    pairs = df.select("g", wo.pick([wo.Bin("g", 1, "a", "category", categories=("a",))], [1], 0).alias("is_a")).first()
    assert pairs is not None and ("g", "a") in woe


def test_auto_bins_invariants(spark, sample):
    df, pdf = sample
    bins = wo.auto_bins(df, "y", ["x", "flat", "g"], max_bins=6, min_share=0.05).toPandas()
    for variable, part in bins.groupby("variable"):
        assert part.n.sum() == len(pdf)
        regular = part[part.kind != "missing"].sort_values("bin_id")
        assert len(regular) <= 6
        assert (regular.n >= 0.05 * regular.n.sum() - 1e-9).all()
        assert np.isfinite(part.woe).all()
    x = bins[(bins.variable == "x") & (bins.kind == "interval")].sort_values("bin_id")
    assert len(x) >= 3 and x.hi.iloc[:-1].tolist() == x.lo.iloc[1:].tolist()
    assert x.woe.is_monotonic_increasing  # the sample is made that way
    for _, r in x.iterrows():
        inside = pdf.x.notna() & (pdf.x >= (-np.inf if np.isnan(r.lo) else r.lo)) & (pdf.x < (np.inf if np.isnan(r.hi) else r.hi))
        assert inside.sum() == r.n
    assert set(sum((list(c) for c in bins[bins.kind == "category"].categories), [])) == {"a", "b", "c", "d"}


def test_fit_bins_mixes_manual_and_automatic(spark, sample):
    df, pdf = sample
    bins = wo.fit_bins(df, "y", {"x": [0, 1]}, skip=["flat"]).toPandas()
    assert set(bins.variable) == {"x", "g"}
    assert bins[bins.variable == "x"].n.sum() == len(pdf)


def test_monotonicity(spark, sample):
    df, _ = sample
    table = wo.woe_table(wo.bin_counts(df, wo.bins_from_breaks({"x": [-1, 0, 1]}), "y"))
    row = wo.monotonicity(table).first()
    assert (row.n_bins, row.turns, row.monotone) == (4, 0, True)


def test_many_categories_are_binned(spark):
    """5,000 categories: none is dropped, and bins follow the rate."""
    df = spark.range(20_000).select(
        F.concat(F.lit("c"), F.col("id") % 5000).alias("c"), F.when((F.col("id") % 5000 < 2500) & (F.col("id") % 3 > 0), 1).otherwise(0).alias("y"))
    bins = wo.auto_bins(df, "y", ["c"]).collect()
    members = [c for b in bins for c in b.categories]
    assert len(members) == len(set(members)) == 5000 and sum(b.n for b in bins) == 20_000
    rates = [b.pos / b.n for b in sorted(bins, key=lambda b: b.bin_id)]
    assert rates == sorted(rates) and rates[0] == 0 and rates[-1] > 0.5


def test_break_list_covers_the_named_variables():
    assert len(fx.BREAKS) == 27
    assert {b.variable for b in wo.bins_from_breaks(fx.BREAKS)} == set(fx.BREAKS)


def test_split_search_runs_without_the_package(tmp_path):
    """Python workers need not find this package: the function travels by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f").write_bytes(cloudpickle.dumps(wo.best_splits))
    code = ("import pickle, numpy as np; f = pickle.load(open('f', 'rb')); "
            "print(f(np.array([50., 50.]), np.array([5., 40.]), 4, 0.05, 0.1))")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "[1]"


def test_wide_variable_is_binned_by_cells(spark, monkeypatch):
    """More categories than a bin may name: bins are runs of cells, and applying them joins the table of categories."""
    monkeypatch.setattr(wo, "MAX_LISTED", 100)
    df = spark.range(20_000).select(
        F.when(F.col("id") % 97 > 0, F.concat(F.lit("c"), F.col("id") % 5000)).alias("c"),
        F.when((F.col("id") % 5000 < 2500) & (F.col("id") % 3 > 0), 1).otherwise(0).alias("y"))
    members = wo.categories_by_rate(df, "y", ["c"])
    assert members.count() == 5000 and members.select("cell").distinct().count() == 50
    bins = wo.auto_bins(df, "y", ["c"], members=members)
    rows = sorted(bins.collect(), key=lambda b: b.bin_id)
    assert wo.in_cells(bins) == ["c"] and all(b.categories is None for b in rows) and sum(b.n for b in rows) == 20_000
    coded = wo.with_cells(df, members, ["c"])
    for b in rows[1:]:
        part = coded.where((F.col("c") >= b.lo) & (F.col("c") < b.hi)).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).first()
        assert (part.n, part.pos) == (b.n, b.pos)
    with pytest.raises(ValueError, match="cells"):
        wo.apply_woe(df, bins, ["y"])
    other = df.unionByName(spark.createDataFrame([("never seen", 0)], "c string, y int"))
    woe = {round(r.woe, 9): r.n for r in rows}
    got = {round(r["c_woe"], 9): r["count"] for r in wo.apply_woe(other, bins, ["y"], members).groupBy("c_woe").count().collect()}
    assert got == woe | {0.0: 1 + woe.get(0.0, 0)}


def test_many_names_never_meet_in_one_row(spark, monkeypatch):
    monkeypatch.setattr(wo, "MAX_LISTED", 100)
    df = spark.range(50_000).select(F.col("id").cast("string").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    bins = wo.auto_bins(df, "y", ["c"])
    assert max(len(str(r)) for r in bins.collect()) < 500  # no list of names, whatever the number of categories
    assert sum(r.n for r in bins.collect()) == 50_000


def isotonic(n, pos, sign):
    """Least squares under the order, by trying every way to cut the bins into runs."""
    best = None
    for cuts in range(2 ** (len(n) - 1)):
        runs, first = [], 0
        for i in range(len(n)):
            if i == len(n) - 1 or cuts >> i & 1:
                runs.append((first, i, sum(pos[first:i + 1]) / sum(n[first:i + 1])))
                first = i + 1
        if all(sign * (b[2] - a[2]) > 0 for a, b in zip(runs, runs[1:])):
            error = sum(n[i] * (pos[i] / n[i] - mean) ** 2 for a, b, mean in runs for i in range(a, b + 1))
            if best is None or error < best[0] - 1e-12:
                best = (error, runs)
    return best


def test_monotone_bins_are_the_least_squares_fit(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for v in range(30):
        k = int(rng.integers(1, 8))
        n = rng.integers(1, 9, k).tolist()
        pos = [int(rng.integers(0, x + 1)) for x in n]
        rows += [(f"v{v}", i + 1, f"[{i},{i + 1})", "interval", float(i), float(i + 1), None, n[i], pos[i]) for i in range(k)]
        rows.append((f"v{v}", 0, "missing", "missing", None, None, None, 3, 1))
        up, down = isotonic(n, pos, 1), isotonic(n, pos, -1)
        want[f"v{v}"] = [(a, b + 1) for a, b, _ in (up if round(up[0], 9) <= round(down[0], 9) else down)[1]]
    bins = wo.woe_table(spark.createDataFrame(rows, wo.BIN_FIELDS + ", n long, pos long").withColumn("neg", F.col("n") - F.col("pos")))
    found = wo.monotone_bins(bins)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r.bin_id):
        if r.kind == "interval":
            got.setdefault(r.variable, []).append((int(r.lo), int(r.hi)))
    assert got == want
    assert found.agg(F.sum("n")).first()[0] == bins.agg(F.sum("n")).first()[0]
    assert wo.monotonicity(found, F.col("pos") / F.col("n")).where("NOT monotone").count() == 0


def test_bins_are_counted_by_number(spark, sample):
    """No text is made per row and variable: the counts group two numbers."""
    df = spark.createDataFrame([(1.0, "a", 1), (5.0, "b", 0), (None, None, 1), (7.0, "c", None)], "x double, t string, y int")
    counts = wo.bin_counts(df, wo.bins_from_breaks({"x": [3], "t": ["a", "b"]}), "y")
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "Aggregate [_v" in plan
    assert sorted((r.variable, r.bin_id, r.n, r.pos) for r in counts.collect()) == [
        ("t", 0, 1, 1), ("t", 1, 1, 1), ("t", 2, 1, 0), ("x", 0, 1, 1), ("x", 1, 1, 1), ("x", 2, 1, 0)]
