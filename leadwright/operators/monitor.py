"""Monitoring: weekly performance, retraining trigger, population stability, new categories, rule changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators.evaluate import auc_ks
from leadwright.operators.woe import MAX_BINS_TOTAL, Bin, by_variable, pick

# Share put in place of an empty bin, so that the index stays finite.
EMPTY_SHARE = 1e-4


def weekly_performance(scored: DataFrame, score: str, target: str, day: str) -> DataFrame:
    """AUC and KS per calendar week (starting Monday); weeks without both classes have no figures."""
    weeks = scored.withColumn("week", F.date_trunc("week", F.col(day)).cast("date")).where(F.col("week").isNotNull())
    return auc_ks(weeks, score, target, ["week"])


def retrain_trigger(
    weekly: DataFrame, ks_floor: float = fx.KS_FLOOR, auc_floor: float = fx.AUC_FLOOR, weeks: int = fx.WEEKS_BELOW
) -> DataFrame:
    """Add ``below`` and ``trigger``: the last ``weeks`` calendar weeks were all below a floor. One row per week."""
    below = F.coalesce((F.col("ks") < ks_floor) | (F.col("auc") < auc_floor), F.lit(False))
    order = Window.orderBy("week").rowsBetween(-(weeks - 1), 0)  # one row per week
    marked = weekly.withColumn("below", below)
    streak = F.sum(F.col("below").cast("int")).over(order) == weeks
    unbroken = F.datediff("week", F.min("week").over(order)) == 7 * (weeks - 1)
    return marked.withColumn("trigger", streak & unbroken)


def bin_cells(bins: list[Bin]) -> Column:
    """Array of (variable, bin) of a row; -1: in no bin."""
    return F.array(*[
        F.struct(F.lit(v).alias("variable"), pick(bs, [b.bin_id for b in bs], -1).alias("bin"))
        for v, bs in by_variable(bins).items()
    ])


def _shares(counts: DataFrame, name: str) -> DataFrame:
    whole = Window.partitionBy("variable")  # one row per bin
    return counts.select("variable", "bin", (F.col("n") / F.sum("n").over(whole)).alias(name))


def stability(expected: DataFrame, actual: DataFrame, ceiling: float = fx.PSI_CEILING) -> DataFrame:
    """Population stability index per variable from rows per bin (variable, bin, n), and whether it exceeds the ceiling."""
    both = _shares(expected, "_e").join(_shares(actual, "_a"), ["variable", "bin"], "full_outer")
    e, a = (F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(EMPTY_SHARE)) for c in ("_e", "_a"))
    total = both.groupBy("variable").agg(F.sum((a - e) * F.log(a / e)).alias("psi"), F.count(F.lit(1)).alias("n_bins"))
    return total.withColumn("shifted", F.col("psi") > ceiling)


def psi(expected: DataFrame, actual: DataFrame, bins: list[Bin], ceiling: float = fx.PSI_CEILING) -> DataFrame:
    """Population stability index per binned variable, and whether it exceeds the ceiling."""
    def counts(df: DataFrame) -> DataFrame:
        return df.select(F.explode(bin_cells(bins)).alias("c")).groupBy("c.variable", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    return stability(counts(expected), counts(actual), ceiling)


def new_categories(df: DataFrame, known: dict[str, list[str]], min_share: float = 0.0) -> DataFrame:
    """Categories that no bin covers, with their rows and share. Values are counted before anything is compared."""
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("category")) for v in known])
    counts = df.select(F.explode(cells).alias("c")).groupBy("c.variable", "c.category").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("variable").agg(F.sum("n").alias("_all"))
    pairs = [(v, c) for v, cs in known.items() for c in cs]
    if len(pairs) > MAX_BINS_TOTAL:
        raise ValueError(f"more than {MAX_BINS_TOTAL} known categories")
    covered = df.sparkSession.createDataFrame(pairs, "variable string, category string")
    fresh = counts.where(F.col("category").isNotNull()).join(F.broadcast(covered), ["variable", "category"], "left_anti")
    shares = fresh.join(totals, "variable").withColumn("share", F.col("n") / F.col("_all"))
    return shares.where(F.col("share") >= min_share).select("variable", "category", "n", "share")


def points_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new points per rule and their difference; a rule present on one side only has NULL on the other."""
    left = old.select("variable", "bin", F.col("points").alias("old_points"))
    right = new.select("variable", "bin", F.col("points").alias("new_points"))
    same = left["variable"].eqNullSafe(right["variable"]) & left["bin"].eqNullSafe(right["bin"])
    return left.join(right, same, "full_outer").select(
        F.coalesce(left["variable"], right["variable"]).alias("variable"), F.coalesce(left["bin"], right["bin"]).alias("bin"),
        "old_points", "new_points",
        (F.coalesce("new_points", F.lit(0)) - F.coalesce("old_points", F.lit(0))).alias("change"),
    )
