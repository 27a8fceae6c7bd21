"""Histories of versions with a validity interval: which version was valid on a day.

The days are filed in a binary tree: level 0 holds single days, a node of level ``i`` spans ``2**i`` of them. An interval is cut into
the few nodes that cover it exactly (two per level at most), and of all versions that cover a node only the best is kept,
so the index has one row per key and node, however many versions overlap. A day looks up the one node per level that
holds it. Versions and days never meet in pairs, open intervals cost no more than short ones, and a key with a third of all rows is spread over its
nodes and days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadwright.functions.columns import as_col, to_day
from leadwright.operators.temporal import asof_join

#: Days from 1970 on that the tree spans: 2**16, to June 2149. Earlier starts and later ends are cut there.
LEVELS = 16


def _number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def _cover(start: Column, end: Column) -> Column:
    """The nodes (level, node) that make up the days from ``start`` to ``end``, the last day not included."""
    def at(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("int")
        low, high = F.ceil(start / size).cast("int"), F.floor(end / size).cast("int")
        inside = low < high
        left = F.when(inside & (low % 2 == 1), F.struct(level.alias("level"), low.alias("node")))
        right = F.when(inside & (high % 2 == 1), F.struct(level.alias("level"), (high - 1).alias("node")))
        return F.array(left, right)

    nodes = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))
    return F.filter(nodes, lambda n: n.isNotNull())


def interval_index(history: DataFrame, key: str, start: str, end: str, best: list[str], columns: list[str], end_included: bool = True) -> DataFrame:
    """``_k``, ``level``, ``node`` and ``_best``: of the versions that cover a whole node the one with the greatest ``best`` columns, then ``columns``.

    A NULL end is open; a version without a start or with an end before it is valid on no day.
    """
    last = F.lit(2**LEVELS)
    low = F.greatest(_number(as_col(start)), F.lit(0))
    high = F.least(F.coalesce(_number(as_col(end)) + (1 if end_included else 0), last), last)
    row = F.struct(*best, *[c for c in columns if c not in best])
    nodes = history.where(F.col(key).isNotNull() & as_col(start).isNotNull()).select(
        F.col(key).alias("_k"), row.alias("_row"), F.explode(_cover(low, high)).alias("_n"))
    return nodes.groupBy("_k", "_n.level", "_n.node").agg(F.max("_row").alias("_best"))


def version_on(moments: DataFrame, key: str, at: str, index: DataFrame) -> DataFrame:
    """Every distinct ``key`` and day of ``at``, with the best version (``_version``) valid on that day; days without one are left out."""
    days = moments.select(F.col(key).alias("_k"), to_day(at).alias("_day")).where(F.col("_k").isNotNull() & F.col("_day").isNotNull()).distinct()
    number = _number(F.col("_day"))
    up = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda i: F.struct(
        i.alias("level"), F.floor(number / F.pow(F.lit(2), i)).cast("int").alias("node")))
    asked = days.where(number.between(0, 2**LEVELS - 1)).select("_k", "_day", F.explode(up).alias("_n")).select("_k", "_day", "_n.level", "_n.node")
    # A moment asks for 17 nodes, which the planner's estimate of an explode does not count: without the hint the larger side may be broadcast.
    return asked.hint("merge").join(index.hint("merge"), ["_k", "level", "node"]).groupBy("_k", "_day").agg(F.max("_best").alias("_version"))


def valid_version_join(
    leads: DataFrame, history: DataFrame, key: str, at: str, start: str, end: str, columns: list[str], best: list[str] | None = None,
    end_included: bool = True, prefix: str = "valid_",
) -> DataFrame:
    """Left join of each lead with the version valid on the day of ``at``; of several the one with the greatest ``best`` columns
    (by default the latest start), then the greatest ``columns``."""
    best = [start] if best is None else best
    found = version_on(leads, key, at, interval_index(history, key, start, end, best, columns, end_included))
    joined = leads.withColumn("_day", to_day(at)).join(found.withColumnRenamed("_k", key), [key, "_day"], "left")
    return joined.select(*[F.col(c) for c in leads.columns], *[F.col(f"_version.{c}").alias(f"{prefix}{c}") for c in columns])


def valid_and_last(
    leads: DataFrame, history: DataFrame, key: str, at: str, history_ts: str, start: str, end: str, columns: list[str],
    tie: list[str] = (), end_included: bool = True,
) -> DataFrame:
    """Both readings of a history: ``valid_*`` from the version valid on the day, ``last_*`` from the last event before the moment."""
    valid = valid_version_join(leads, history, key, at, start, end, columns, [start, history_ts, *tie], end_included)
    last = asof_join(leads.select(key, at).distinct(), history, key, at, history_ts, columns, list(tie))
    renamed = last.select(key, at, *[F.col(c).alias(f"last_{c}") for c in columns])
    return valid.join(renamed, [key, at], "left").select(*valid.columns, *[f"last_{c}" for c in columns])
