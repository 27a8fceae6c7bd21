"""Train/test splits and the sparse logistic model."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators.ordered import running_sums
from leadwright.session import materialise

INTERCEPT = "(intercept)"
MAX_CLASSES = 100


def draw(columns: list[str], seed: int) -> Column:
    """Repeatable pseudo-random text per row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def split_stratified(
    df: DataFrame, ids: list[str], target: str, ratio: float = fx.SPLIT_RATIO, seed: int = fx.SPLIT_SEED
) -> DataFrame:
    """Add ``part``: exactly round(ratio * n) rows of each class are 'train', the rest 'test'.

    Only ids, class and draw are sorted; from that, one boundary row per class (two for a binary target)
    becomes a condition on the rows, so the wide rows are never shuffled. ``ids`` must tell the rows apart.
    """
    group = F.coalesce(F.col(target).cast("int"), F.lit(-1))
    narrow = df.select(group.alias("_class"), draw(ids, seed).alias("_draw"), *ids, F.lit(1).alias("_one"))
    numbered = running_sums(narrow, ["_class"], ["_draw", *ids], {"one": "_one"})
    last = numbered.where(F.col("cum_one") == F.round(F.col("total_one") * ratio))
    bounds = last.select("_class", "_draw", *ids).limit(MAX_CLASSES + 1).collect()
    if len(bounds) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes")
    train = F.lit(False)
    place = F.struct(draw(ids, seed).alias("_draw"), *ids)
    for b in bounds:
        bound = F.struct(F.lit(b["_draw"]).alias("_draw"), *[F.lit(b[i]).cast(df.schema[i].dataType).alias(i) for i in ids])
        train = train | ((group == b["_class"]) & (place <= bound))
    return df.withColumn("part", F.when(train, "train").otherwise("test"))


def split_out_of_time(df: DataFrame, day: str, cut: str) -> DataFrame:
    """Add ``part``: rows before the day ``cut`` are 'train', later ones 'test'."""
    return df.withColumn("part", F.when(F.col(day) < F.lit(cut).cast("date"), "train").otherwise("test"))


def patterns(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """The different rows of features and label, each with its number (``weight``): what a fit needs to see. Rows without a label are left out."""
    return df.where(F.col(target).isNotNull()).groupBy(*features, F.col(target).cast("double").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"))


def fit_l1(
    df: DataFrame, features: list[str], target: str, C: float = fx.L1_C, max_iter: int = 1000
) -> tuple[LogisticRegressionModel, DataFrame]:
    """L1 logistic fit minimising C * sum(loss) + |beta|_1, intercept free of penalty. A fit that has not
    converged after ``max_iter`` steps is an error.

    Binned rows repeat, so equal rows are collapsed to weighted patterns, which are written once; every step of the fit reads those.
    Spark ML minimises mean(loss) + regParam * |beta|_1, hence regParam = 1 / (C n).
    """
    seen = materialise(patterns(df, features, target), "patterns")
    n = seen.agg(F.sum("weight")).first()[0]
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(seen).select("features", "label", "weight")
    estimator = LogisticRegression(
        elasticNetParam=1.0, regParam=1.0 / (C * n), standardization=False, maxIter=max_iter, tol=1e-9, weightCol="weight"
    )
    model = estimator.fit(rows)
    if model.summary.totalIterations >= max_iter:
        raise ArithmeticError(f"the fit has not converged after {max_iter} steps")
    pairs = [(INTERCEPT, float(model.intercept)), *zip(features, map(float, model.coefficients))]
    return model, df.sparkSession.createDataFrame(pairs, "feature string, coefficient double")


def l1_optimality(df: DataFrame, coefs: DataFrame, target: str, C: float = fx.L1_C, tolerance: float = 0.01) -> DataFrame:
    """Per coefficient the gradient C * sum((p - y) x) at the fit, and whether it meets the condition of the optimum.

    The gradient of the intercept must be 0, that of a coefficient in the model the opposite of its sign, and that of one left out at most 1 in size, each
    within ``tolerance``. Residuals are summed in one pass over the patterns.
    """
    found = {r["feature"]: r["coefficient"] for r in coefs.collect()}  # one row per feature
    features = [f for f in found if f != INTERCEPT]
    rows = patterns(df, features, target)
    residual = (probability(found) - F.col("label")) * F.col("weight") * C
    sums = rows.agg(F.sum("weight").cast("bigint").alias("n"), F.sum(F.col("weight") * F.col("label")).cast("bigint").alias("positives"),
                    F.sum(residual).alias("_0"), *[F.sum(residual * F.col(f)).alias(f"_{i}") for i, f in enumerate(features, 1)])
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(found[f]).alias("coefficient"), F.col(f"_{i}").alias("gradient"))
                      for i, f in enumerate([INTERCEPT, *features])])
    long = sums.select("n", "positives", F.explode(cells).alias("c")).select("c.*", "n", "positives")
    gradient, beta = F.col("gradient"), F.col("coefficient")
    ok = F.when(F.col("feature") == INTERCEPT, F.abs(gradient) <= tolerance).when(
        beta == 0, F.abs(gradient) <= 1 + tolerance).otherwise(F.abs(gradient + F.signum(beta)) <= tolerance)
    return long.withColumn("optimal", ok)


def select_nonzero(coefs: DataFrame, eps: float = 1e-6) -> list[str]:
    """Features the penalty left in the model; one row per feature, so collecting is bounded."""
    kept = coefs.where((F.col("feature") != INTERCEPT) & (F.abs("coefficient") > eps)).select("feature")
    return sorted(r.feature for r in kept.collect())


def probability(coefs: dict[str, float]) -> Column:
    """Closed-form probability of a fitted model as a column expression."""
    terms = [F.col(f) * F.lit(b) for f, b in coefs.items() if f != INTERCEPT]
    logit = reduce(lambda a, b: a + b, terms, F.lit(coefs.get(INTERCEPT, 0.0)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
