"""Joins that stay splittable when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_many(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join for a right side that may hold very many rows of one key.

    AQE can split a skewed partition of an outer join only on the preserved side. An inner join can be
    split on both, so the matched rows come from an inner join and the unmatched ones from an anti join
    against the distinct keys, which are folded on the map side.
    """
    matched = left.join(right, on)
    unmatched = left.join(right.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
