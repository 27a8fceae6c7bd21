"""ROC, AUC, KS and deciles against pandas and Spark ML."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from leadwright.operators import evaluate as ev


def sample(n=3000, digits=3, seed=0):
    rnd = np.random.default_rng(seed)
    score = rnd.random(n).round(digits)
    y = (rnd.random(n) < score / 2).astype(int)
    return pd.DataFrame({"score": score, "y": y})


def by_pandas(pdf):
    known = pdf.dropna()
    _, edges = pd.qcut(known.score, 10, retbins=True, duplicates="drop")
    edges[0] -= 1e-5
    edges[-1] += 1e-5
    cut = pd.cut(known.score, edges, labels=False)
    rows = known.groupby(cut).y.agg(["sum", "count"]).sort_index(ascending=False)
    rows["recall"] = rows["sum"].cumsum() / rows["sum"].sum()
    return rows


@pytest.mark.parametrize("digits", [6, 1])
def test_deciles_equal_pandas(spark, digits):
    pdf = sample(digits=digits)
    want = by_pandas(pdf)
    got = ev.decile_table(spark.createDataFrame(pdf), "score", "y").toPandas()
    assert got.Ones.tolist() == want["sum"].tolist()
    assert got.Population.tolist() == want["count"].tolist()
    assert np.allclose(got.CumulativeRecallRate, want.recall)
    assert got.CumulativeRecallRate.iloc[-1] == pytest.approx(1.0)


def test_few_scores_drop_edges_and_label_the_lowest_bin_nine(spark):
    pdf = pd.DataFrame({"score": [0.1] * 50 + [0.2] * 30 + [0.9] * 20, "y": [0, 1] * 50})
    got = ev.decile_table(spark.createDataFrame(pdf), "score", "y").toPandas()
    assert got.Population.sum() == 100 and len(got) < 10
    assert got.Decile.iloc[-1].startswith("9.[")


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (None, 1), (0.3, None)], "score double, y int")
    assert ev.decile_table(df, "score", "y").agg(F.sum("Population")).first()[0] == 2


def test_approximate_deciles_are_close(spark):
    pdf = sample(digits=6)
    df = spark.createDataFrame(pdf)
    exact, approx = ev.decile_table(df, "score", "y").toPandas(), ev.decile_table_approx(df, "score", "y").toPandas()
    assert approx.Population.sum() == len(pdf)
    assert (exact.Population - approx.Population).abs().max() <= 0.01 * len(pdf)


def test_auc_equals_spark_ml_and_ks_is_bounded(spark):
    pdf = sample(digits=2)
    df = spark.createDataFrame(pdf)
    row = ev.auc_ks(df, "score", "y").first()
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0).evaluate(df)
    assert row.auc == pytest.approx(ml) and 0 < row.ks < 1


def test_roc_ends_at_one_one(spark):
    points = ev.roc_curve(spark.createDataFrame(sample(500)), "score", "y").toPandas()
    assert (points.fpr.max(), points.tpr.max()) == (1.0, 1.0)
    assert points[points.threshold.isna()][["fpr", "tpr"]].to_numpy().tolist() == [[0.0, 0.0]]


def test_groups_are_independent(spark):
    parts = {w: sample(700, 2, seed) for w, seed in (("a", 1), ("b", 2))}
    df = spark.createDataFrame(pd.concat([p.assign(w=w) for w, p in parts.items()]))
    got = {r.w: (r.auc, r.ks) for r in ev.auc_ks(df, "score", "y", ["w"]).collect()}
    for w, p in parts.items():
        alone = ev.auc_ks(spark.createDataFrame(p), "score", "y").first()
        assert got[w] == (pytest.approx(alone.auc), pytest.approx(alone.ks))


def test_one_class_gives_no_figures(spark):
    row = ev.auc_ks(spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, y int"), "score", "y").first()
    assert row.auc is None and row.ks is None


def test_merged_sketches_keep_to_their_bound(spark):
    """One sketch a day, merged for any window; the error of every edge is measured against the rows."""
    rnd = np.random.default_rng(4)
    pdf = pd.DataFrame({"day": rnd.integers(0, 20, 60_000), "score": rnd.choice([0.5, *rnd.random(5_000)], 60_000), "y": 1})
    df = spark.createDataFrame(pdf).repartition(7)
    shares = [i / 10 for i in range(1, 10)]
    kept = ev.score_sketches(df, "score", "y", ["day"]).cache()
    assert kept.count() == 20
    for window in (F.lit(True), F.col("day") < 7):
        rows = ev.edge_errors(df.where(window), "score", "y", kept.where(window), shares).collect()
        scores = pdf.score[pdf.day < 7] if len(rows) and rows[0]["n"] < 60_000 else pdf.score
        assert len(rows) == 9 and all(r["within"] and r["n"] == len(scores) for r in rows)
        for r in rows:
            assert r["low"] == pytest.approx((scores < r["edge"]).mean()) and r["high"] == pytest.approx((scores <= r["edge"]).mean())
            assert r["error"] == pytest.approx(max(0, r["low"] - r["share"], r["share"] - r["high"]))


def test_sketches_leave_out_nulls_and_stay_lazy(spark):
    df = spark.createDataFrame([(0.1, 0), (None, 1), (0.3, None), (0.2, 1)], "score double, y int")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    edges = ev.sketch_edges(ev.score_sketches(df, "score", "y"), [0.0, 1.0])
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert (edges.first()["n"], edges.first()["edges"]) == (2, [0.1, 0.2])
