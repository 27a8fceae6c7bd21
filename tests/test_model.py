"""Splits, the L1 fit and the training run."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators import model as md
from leadwright.operators import scorecard as sc
from leadwright.plans import registry as rg
from leadwright.plans.training import train_scorecard


@pytest.fixture(scope="module")
def sample(spark):
    rnd = np.random.default_rng(11)
    n = 2000
    X = rnd.normal(size=(n, 4))
    y = (rnd.random(n) < 1 / (1 + np.exp(-(0.8 * X[:, 0] - 0.6 * X[:, 1] - 1)))).astype(int)
    pdf = pd.DataFrame(X, columns=list("abcd")).assign(y=y, id=range(n))
    return spark.createDataFrame(pdf).cache(), pdf


@pytest.mark.parametrize("C", [0.1, 0.01])
def test_l1_optimality(spark, sample, C):
    """Subgradient conditions of mean(loss) + lambda * |beta| at the solution."""
    df, pdf = sample
    _, coefs = md.fit_l1(df, list("abcd"), "y", C)
    beta = {r.feature: r.coefficient for r in coefs.collect()}
    b = np.array([beta[f] for f in "abcd"])
    X, y = pdf[list("abcd")].to_numpy(), pdf.y.to_numpy()
    residual = 1 / (1 + np.exp(-(beta[md.INTERCEPT] + X @ b))) - y
    gradient, lam = X.T @ residual / len(y), 1 / (C * len(y))
    assert abs(residual.mean()) < 1e-4
    for g, v in zip(gradient, b):
        if v == 0:
            assert abs(g) <= lam + 1e-4
        else:
            assert g == pytest.approx(-lam * np.sign(v), abs=1e-4)


def test_strong_penalty_selects(spark, sample):
    df, _ = sample
    _, coefs = md.fit_l1(df, list("abcd"), "y", 0.01)
    assert set(md.select_nonzero(coefs)) == {"a", "b"}


def test_probability_column_equals_the_model(spark, sample):
    df, pdf = sample
    model, coefs = md.fit_l1(df, list("abcd"), "y", 0.1)
    column = md.probability({r.feature: r.coefficient for r in coefs.collect()})
    got = df.withColumn("p", column).orderBy("id").toPandas().p.to_numpy()
    b = np.array(model.coefficients)
    assert np.allclose(got, 1 / (1 + np.exp(-(model.intercept + pdf[list("abcd")].to_numpy() @ b))))


def test_split_is_exact_per_class_and_repeatable(spark, sample):
    df, pdf = sample
    first = md.split_stratified(df, ["id"], "y").toPandas()
    again = md.split_stratified(df.repartition(5), ["id"], "y").toPandas()
    for label, part in first.groupby("y"):
        assert (part.part == "train").sum() == int(np.floor(0.7 * len(part) + 0.5))
    assert first.set_index("id").part.to_dict() == again.set_index("id").part.to_dict()
    other = md.split_stratified(df, ["id"], "y", seed=1).toPandas()
    assert first.set_index("id").part.to_dict() != other.set_index("id").part.to_dict()


def test_training_run_closes_the_loop(spark, small):
    rows = rg.feature_stage(spark, small)
    trained = train_scorecard(rows, features=fx.SELECTED, C=10.0)
    names = {r.variable for r in trained.rules.select("variable").distinct().collect()}
    assert names == {*fx.SELECTED, sc.BASE}
    n_train, n_test = trained.train_woe.count(), trained.test_woe.count()
    assert n_train + n_test == rows.count()
    scored = sc.score(rows, trained.rules)
    assert scored.where(F.col("total_score").isNull()).count() == 0


def test_out_of_time_training(spark, small):
    rows = rg.feature_stage(spark, small)
    trained = train_scorecard(rows, features=fx.SELECTED, C=10.0, test_from="2024-01-20")
    cut = F.lit("2024-01-20").cast("date")
    assert trained.train_woe.count() == rows.where(F.col("alloc_date") < cut).count()
    assert trained.test_woe.count() == rows.where(F.col("alloc_date") >= cut).count()
    binned = {r.variable for r in trained.bins.select("variable").distinct().collect()}
    assert {"is_add_hz_flag", "follow_tag", "visit_cnt_cf", *fx.BREAKS} - {"alloc_date"} <= binned
    assert not binned & set(fx.NOT_BINNED)
