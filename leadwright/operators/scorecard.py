"""Scorecard rules, their compilation to columns, scoring, ranking and reasons."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators.model import INTERCEPT
from leadwright.operators.ordered import with_position
from leadwright.operators.woe import BIN_FIELDS, MISSING, Bin, by_variable, collect_bins, interval_label, pick

BASE = "basepoints"
RULE_FIELDS = BIN_FIELDS + ", points int"


def rules_from_points(points: dict[str, dict]) -> list[tuple[Bin, int]]:
    """Rules of a plain table ``{variable: {label or (from, to): points}}``."""
    rules = []
    for variable, table in points.items():
        for i, (mark, value) in enumerate(table.items()):
            if mark == MISSING:
                b = Bin(variable, i, MISSING, "missing")
            elif isinstance(mark, tuple):
                lo, hi = (None if x is None else float(x) for x in mark)
                b = Bin(variable, i, interval_label(lo, hi), "interval", lo, hi)
            else:
                b = Bin(variable, i, mark, "category", categories=(mark,))
            rules.append((b, value))
    return rules


def rules_frame(spark: SparkSession, rules: list[tuple[Bin, int]]) -> DataFrame:
    return spark.createDataFrame([(*b.row(), p) for b, p in rules], RULE_FIELDS)


def deployed_rules(spark: SparkSession) -> DataFrame:
    return rules_frame(spark, rules_from_points(fx.DEPLOYED_POINTS))


def scorecard(
    bins: DataFrame,
    coefs: DataFrame,
    points0: float = fx.POINTS0,
    odds0: float = fx.ODDS0,
    pdo: float = fx.PDO,
    direction: int = 1,
) -> DataFrame:
    """Integer points per bin, and one base row.

    With B = pdo / ln 2 a bin gets direction * B * beta * woe and the base points0 + direction * B *
    (beta0 - ln odds0). ``direction=1`` gives likely converters more points, -1 the usual risk sign.
    """
    b = direction * pdo / math.log(2)
    variable = F.regexp_replace("feature", "_woe$", "").alias("variable")
    # One coefficient per feature: bounded by the width of the model.
    betas = F.broadcast(coefs.where(F.col("feature") != INTERCEPT).select(variable, "coefficient"))
    points = F.round(F.lit(b) * F.col("coefficient") * F.col("woe")).cast("int").alias("points")
    rules = bins.join(betas, "variable").select("variable", "bin_id", "bin", "kind", "lo", "hi", "categories", points)
    base = coefs.where(F.col("feature") == INTERCEPT).select(
        F.lit(BASE).alias("variable"), F.lit(0).alias("bin_id"), F.lit(None).cast("string").alias("bin"),
        F.lit("base").alias("kind"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        F.lit(None).cast("array<string>").alias("categories"),
        F.round(F.lit(points0) + F.lit(b) * (F.col("coefficient") - F.lit(math.log(odds0)))).cast("int").alias("points"),
    )
    return rules.unionByName(base)


def compile_rules(rules: DataFrame) -> tuple[dict[str, Column], int]:
    """Rule table to one points column per variable, and the base points. A value outside all rules gets 0."""
    bins, points = collect_bins(rules, "points")
    base = points.get((BASE, 0), 0)
    return {
        v: pick(bs, [points[v, b.bin_id] for b in bs], 0).cast("int")
        for v, bs in by_variable(bins).items() if v != BASE
    }, base


def score(df: DataFrame, rules: DataFrame, base: int | None = None) -> DataFrame:
    """Add ``<variable>_score`` per rule variable and ``total_score``; a projection without any shuffle."""
    parts, own_base = compile_rules(rules)
    base = own_base if base is None else base
    scored = df.withColumns({f"{v}_score": c for v, c in parts.items()})
    total = reduce(lambda a, b: a + b, [F.col(f"{v}_score") for v in parts], F.lit(base))
    return scored.withColumn("total_score", total.cast("int"))


def rule_cells(rules: DataFrame) -> tuple[dict[str, list[float]], DataFrame]:
    """The limits of each variable's intervals, sorted, and the points by cell: variable, cell, text, points.

    Cell ``i`` of a number lies between its limits ``i - 1`` and ``i``; -1 stands for NULL, -2 for a text, which is named. Two rules
    that claim one cell or one text are taken in the order of their bin_id, as ``compile_rules`` tries them. The limits are the one thing collected: two numbers
    per rule, from which each task searches by bisection.
    """
    spans = rules.where(F.col("kind").isin("interval", "cells"))
    ends = F.array_compact(F.array("lo", "hi"))
    found = spans.groupBy("variable").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(ends)))).alias("limits"))
    limits = {r["variable"]: list(r["limits"]) for r in found.collect()}
    low = F.when(F.col("lo").isNull(), 0).otherwise(F.array_position("limits", F.col("lo")))
    high = F.when(F.col("hi").isNull(), F.size("limits")).otherwise(F.array_position("limits", F.col("hi")) - 1)
    of_numbers = spans.join(found, "variable").where(low <= high).select(
        "variable", "bin_id", F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("cell"), F.lit("").alias("text"), "points")
    of_texts = rules.where(F.col("kind") == "category").select("variable", "bin_id", F.lit(-2).alias("cell"), F.explode("categories").alias("text"), "points")
    missing = rules.where(F.col("kind") == "missing").select("variable", "bin_id", F.lit(-1).alias("cell"), F.lit("").alias("text"), "points")
    every = of_numbers.unionByName(of_texts).unionByName(missing)
    return limits, every.groupBy("variable", "cell", "text").agg(F.min_by("points", "bin_id").alias("points"))


def score_by_join(df: DataFrame, rules: DataFrame, ids: list[str], base: int) -> DataFrame:
    """Total score by looking every value up in the rule table, however many rules it has.

    A number finds its cell by bisection in the sorted limits of its variable; variable, cell and text are then joined for
    equality, and Spark chooses between broadcast and shuffle by the size of the table.
    """
    limits, points = rule_cells(rules)
    kinds = {r["variable"]: r["text"] for r in rules.where(F.col("kind") != "base").groupBy("variable").agg(
        F.max(F.col("kind") == "category").alias("text")).collect()}  # one row per variable
    numbers = [v for v, text in kinds.items() if not text]
    cells = df.select(*ids, *[F.coalesce(F.col(v).cast("double"), F.lit(math.nan)).alias(f"_v_{v}") for v in numbers],
                      *[F.col(v).isNull().alias(f"_n_{v}") for v in kinds], *[F.col(v).cast("string").alias(f"_t_{v}") for v in kinds if v not in numbers])
    if numbers:
        # One limit more than the rules have keeps the splits valid where a variable has none; NaN counts as the greatest number.
        splits = [[-math.inf, *(limits.get(v) or [0.0]), math.inf] for v in numbers]
        cells = Bucketizer(splitsArray=splits, inputCols=[f"_v_{v}" for v in numbers], outputCols=[f"_c_{v}" for v in numbers],
                           handleInvalid="keep").transform(cells)
    def cell(v: str) -> Column:
        if v not in numbers:
            return F.when(F.col(f"_n_{v}"), -1).otherwise(-2)
        last = len(limits.get(v, []))
        return F.when(F.col(f"_n_{v}"), -1).otherwise(F.least(F.col(f"_c_{v}").cast("int"), F.lit(last)))

    asked = F.array(*[F.struct(F.lit(v).alias("variable"), cell(v).cast("int").alias("cell"),
                               (F.lit("") if v in numbers else F.coalesce(F.col(f"_t_{v}"), F.lit(""))).alias("text")) for v in kinds])
    long = cells.select(*ids, F.explode(asked).alias("_a")).select(*ids, "_a.*")
    joined = long.join(points, ["variable", "cell", "text"], "left")
    return joined.groupBy(*ids).agg((F.lit(base) + F.coalesce(F.sum("points"), F.lit(0))).cast("int").alias("total_score"))


def rules_sql(rules: DataFrame) -> dict[str, str]:
    """The compiled rules as Spark SQL text, one expression per variable; limits are written in full as doubles."""
    found, points = collect_bins(rules, "points")
    out = {}
    for v, bs in by_variable([b for b in found if b.variable != BASE]).items():
        tests = []
        for b in bs:
            if b.kind == "missing":
                test = f"{v} IS NULL"
            elif b.kind == "category":
                quoted = ", ".join("'" + c.replace("'", "''") + "'" for c in b.categories)
                test = f"{v} IN ({quoted})"
            else:
                ends = [f"{v} >= {float(b.lo)!r}D"] if b.lo is not None else []
                ends += [f"{v} < {float(b.hi)!r}D"] if b.hi is not None else []
                test = " AND ".join(ends) or f"{v} IS NOT NULL"
            tests.append(f"WHEN {test} THEN {points[v, b.bin_id]}")
        out[v] = f"CASE {' '.join(tests)} ELSE 0 END"
    return out


def eligible(df: DataFrame) -> DataFrame:
    """Leads whose user has a tag row: their most visited city has a class, if only 'unknown'."""
    return df.where(F.col("most_visit_city_class").isNotNull())


def rank_leads(scored: DataFrame, by: str = "total_score", recency: str | None = None, ids: list[str] = ("user_id",)) -> DataFrame:
    """Add ``lead_rank`` 1..n: best score first, ties to the most recent visit, then by id."""
    order = [F.col(by).desc()]
    if recency:
        order.append(F.col(recency).desc_nulls_last())
    return with_position(scored, [*order, *[F.col(i).asc_nulls_last() for i in ids]], "lead_rank")


def top_fraction(ranked: DataFrame, share: float = fx.TOP_SHARE, rank: str = "lead_rank") -> DataFrame:
    """The best ``share`` of the leads, rounded up."""
    n = ranked.count()
    return ranked.where(F.col(rank) <= math.ceil(share * n))


def score_reasons(scored: DataFrame, variables: list[str], ids: list[str], k: int = 3) -> DataFrame:
    """The k parts that moved each lead's score most; sorted inside the row, so nothing is shuffled."""
    parts = F.array(*[
        F.struct((-F.abs(f"{v}_score")).alias("weight"), F.lit(v).alias("variable"), F.col(f"{v}_score").alias("points"))
        for v in variables
    ])
    top = F.slice(F.array_sort(parts), 1, k)
    out = scored.select(*ids, "total_score", F.posexplode(top).alias("pos", "part"))
    return out.select(*ids, "total_score", (F.col("pos") + 1).alias("reason"), "part.variable", "part.points")
