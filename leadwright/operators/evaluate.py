"""ROC, AUC, KS and decile tables.

Everything is read off one frame: rows grouped by score (folded on the map side) with running counts in
score order, computed slice by slice. No single task sees all scores.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadwright.operators.ordered import running_sums
from leadwright.session import materialise


def score_counts(df: DataFrame, score: str, target: str, by: list[str] = ()) -> DataFrame:
    """One row per distinct score with its rows ``n`` and positives ``pos``."""
    return df.where(F.col(score).isNotNull() & F.col(target).isNotNull()).groupBy(*by, score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target)).cast("bigint").alias("pos")
    )


def score_curve(df: DataFrame, score: str, target: str, by: list[str] = (), ascending: bool = False) -> DataFrame:
    """``score_counts`` with running and total counts."""
    return counted_curve(score_counts(df, score, target, by), score, by, ascending)


def counted_curve(groups: DataFrame, score: str, by: list[str] = (), ascending: bool = False) -> DataFrame:
    order = F.col(score).asc() if ascending else F.col(score).desc()
    return running_sums(groups, list(by), [order], {"n": "n", "pos": "pos"})


def _rates(curve: DataFrame) -> DataFrame:
    neg, cum_neg = F.col("n") - F.col("pos"), F.col("cum_n") - F.col("cum_pos")
    total_neg = F.col("total_n") - F.col("total_pos")
    return curve.withColumns({
        "fpr": F.try_divide(cum_neg, total_neg), "tpr": F.try_divide(F.col("cum_pos"), F.col("total_pos")),
        # Area of the trapezoid between the previous and this point of the curve.
        "_area": F.try_divide(neg * (F.col("cum_pos") * 2 - F.col("pos")), total_neg * F.col("total_pos") * 2),
    })


def roc_curve(df: DataFrame, score: str, target: str, by: list[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score, highest first; the start (0, 0) has no threshold."""
    points = _rates(score_curve(df, score, target, by)).select(*by, F.col(score).alias("threshold"), "fpr", "tpr")
    if by:
        start = points.select(*by).distinct()
    else:
        start = df.sparkSession.range(1).select()
    start = start.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.withColumn("threshold", F.col("threshold").cast("double")).unionByName(start)


def auc_ks(df: DataFrame, score: str, target: str, by: list[str] = ()) -> DataFrame:
    """Area under the ROC curve and the greatest |TPR - FPR|, per ``by`` group."""
    return counted_auc_ks(score_counts(df, score, target, by), score, by)


def counted_auc_ks(groups: DataFrame, score: str, by: list[str] = ()) -> DataFrame:
    """The same from rows and positives per score."""
    rates = _rates(counted_curve(groups, score, by))
    return rates.groupBy(*by).agg(
        F.sum("_area").alias("auc"), F.max(F.abs(F.col("tpr") - F.col("fpr"))).alias("ks"),
        F.first("total_n").alias("n"), F.first("total_pos").alias("positives"),
    )


def exact_quantiles(curve: DataFrame, score: str, shares: list[float]) -> list[float]:
    """Linearly interpolated quantiles from an ascending score curve.

    Only the scores that cover the asked positions leave the cluster: at most two per share.
    """
    last = F.col("total_n") - 1
    positions = F.array(*[f(F.lit(q) * last).cast("bigint") for q in shares for f in (F.floor, F.ceil)])
    covers = F.exists(positions, lambda p: (p >= F.col("cum_n") - F.col("n")) & (p < F.col("cum_n")))
    cells = curve.where(covers).select(score, "n", "cum_n", "total_n").collect()
    if not cells:
        return []

    def value(p: int) -> float:
        return next(float(c[score]) for c in cells if c["cum_n"] - c["n"] <= p < c["cum_n"])

    out = []
    for q in shares:
        w = q * (cells[0]["total_n"] - 1)
        low, high = value(math.floor(w)), value(math.ceil(w))
        out.append(low + (high - low) * (w - math.floor(w)))
    return out


def decile_edges(quantiles: list[float], margin: float = 1e-5) -> list[float]:
    """Distinct edges with the two outer ones widened."""
    edges = sorted(set(quantiles))
    if len(edges) == 1:
        edges = edges * 2
    return [edges[0] - margin, *edges[1:-1], edges[-1] + margin]


def decile_labels(edges: list[float], n: int = 10) -> list[str]:
    """Labels from the lowest bin (n-1) upwards; the lowest one shows its closed end."""
    pairs = list(zip(edges, edges[1:]))
    return [f"{n - 1 - i}.{'[' if i == 0 else '('}{lo:.5f},{hi:.5f}]" for i, (lo, hi) in enumerate(pairs)]


def _decile_of(score: str, edges: list[float], labels: list[str]) -> Column:
    chain = F
    for hi, label in zip(edges[1:], labels):
        chain = chain.when(F.col(score) <= hi, F.lit(label))
    return chain.otherwise(F.lit(None))


def _decile_summary(groups: DataFrame, score: str, edges: list[float], n: int) -> DataFrame:
    labels = decile_labels(edges, n)
    summary = groups.withColumn("Decile", _decile_of(score, edges, labels)).groupBy("Decile").agg(
        F.sum("pos").alias("Ones"), F.sum("n").alias("Population")
    )
    rank = F.split("Decile", r"\.")[0].cast("int")
    # At most n rows from here on.
    best_first = Window.orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ones, rows = F.sum("Ones").over(best_first), F.sum("Population").over(best_first)
    total = F.sum("Ones").over(everything)
    return summary.select(
        "Decile", "Ones", "Population",
        F.try_divide("Ones", "Population").alias("ResponseRate"), F.try_divide(ones, rows).alias("CumulativeResponseRate"),
        F.try_divide(F.col("Ones"), total).alias("RecallRate"), F.try_divide(ones, total).alias("CumulativeRecallRate"),
    ).orderBy(rank)


def decile_table(df: DataFrame, score: str, target: str, n: int = 10) -> DataFrame:
    """Decile report with exact quantile edges, best decile first."""
    curve = score_curve(df, score, target, ascending=True)
    edges = decile_edges(exact_quantiles(curve, score, [i / n for i in range(n + 1)]))
    return _decile_summary(curve, score, edges, n)


def decile_table_approx(df: DataFrame, score: str, target: str, n: int = 10, error: float = 1e-3) -> DataFrame:
    """The same report with sketched edges: one pass, no sort. The two outer edges are exact."""
    known = df.where(F.col(score).isNotNull() & F.col(target).isNotNull())
    found = known.select(F.col(score).cast("double").alias(score)).approxQuantile(score, [i / n for i in range(n + 1)], error)
    groups = known.select(score, F.col(target).alias("pos"), F.lit(1).alias("n"))
    return _decile_summary(groups, score, decile_edges(found), n)


# ---------------------------------------------------------------- stored sketches
#: Size of a quantile sketch, and the rank error that merged sketches of this size keep to (three standard bounds).
SKETCH_SIZE, SKETCH_ERROR = 2048, 3 * 2.446 / 2048**0.9433


def score_sketches(df: DataFrame, score: str, target: str, by: list[str] = ()) -> DataFrame:
    """One mergeable quantile sketch per group (a day, say), with its number of rows: a table to keep, a few kilobytes a row."""
    known = df.where(F.col(score).isNotNull() & F.col(target).isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(score).cast("double"), F.lit(SKETCH_SIZE)).alias("sketch"),
                                  F.count(F.lit(1)).alias("n"))


def sketch_edges(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """``edges`` (one per share) and ``n`` of all given sketches together. Lazy: sketches are merged, no row is read again."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
    edges = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in shares])
    return merged.select("n", edges.alias("edges"))


def edge_errors(df: DataFrame, score: str, target: str, sketches: DataFrame, shares: list[float]) -> DataFrame:
    """Per share the sketched edge, the share of rows that truly lie at or below it (at least and at most, for ties), its
    distance from the asked share, and the stated bound."""
    known = df.where(F.col(score).isNotNull() & F.col(target).isNotNull()).select(F.col(score).cast("double").alias("_s"))
    # Merging draws at random, so the edges are worked out once and kept.
    edges = materialise(sketch_edges(sketches, shares), "edges")
    asked = edges.select("n", F.posexplode("edges").alias("_at", "edge")).select("n", "_at", "edge", F.array(*[F.lit(q) for q in shares])[F.col("_at")].alias("share"))
    # One row of edges: every value is compared with them in place, and only counts leave the tasks.
    placed = known.join(F.broadcast(edges.select("edges")))
    sums = [f(F.when(test, 1).otherwise(0)).alias(f"{name}{i}") for i in range(len(shares)) for f, name, test in (
        (F.sum, "below", F.col("_s") < F.col("edges")[i]), (F.sum, "upto", F.col("_s") <= F.col("edges")[i]))]
    counted = placed.agg(*sums).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_at"), F.col(f"below{i}").alias("below"), F.col(f"upto{i}").alias("upto")) for i in range(len(shares))])).alias("c")).select("c.*")
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    error = F.greatest(low - F.col("share"), F.col("share") - high, F.lit(0.0))
    return asked.join(counted, "_at").select("share", "edge", "n", low.alias("low"), high.alias("high"), error.alias("error"),
                                             F.lit(SKETCH_ERROR).alias("bound"), (error <= SKETCH_ERROR).alias("within"))


def top_deciles(deciles: DataFrame, k: int = 3) -> DataFrame:
    """The k best deciles of a report."""
    return deciles.orderBy(F.split("Decile", r"\.")[0].cast("int")).limit(k)
