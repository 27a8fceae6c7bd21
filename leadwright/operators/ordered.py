"""Global order without a single-task window: row positions and running sums.

The rows are range-sorted once, so a heavy key or score is split over many tasks as long as the
order columns tell its rows apart. The sorted rows are written with the number of their slice;
only one total per slice (and group) is carried from slice to slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadwright.session import materialise

# monotonically_increasing_id keeps the partition number above bit 33 and the row number below.
_SLICE_BITS = 33


def _sorted_slices(df: DataFrame, order: list[Column | str]) -> DataFrame:
    ordered = df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id())
    return materialise(ordered, "sorted").withColumn("_slice", F.shiftright("_row", _SLICE_BITS))


def with_position(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """Number all rows 1..n in the given order."""
    rows = _sorted_slices(df, order)
    sizes = rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    # One row per sort partition, so this window and the broadcast are bounded by the partition count.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    in_slice = F.col("_row").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))
    return (
        rows.join(F.broadcast(starts), "_slice")
        .withColumn(name, (F.col("_start") + in_slice + 1).cast("bigint"))
        .drop("_slice", "_row", "_start")
    )


def running_sums(df: DataFrame, by: list[str], order: list[Column | str], sums: dict[str, str]) -> DataFrame:
    """Add, for every ``name: column`` in ``sums``, ``cum_name`` (inclusive running sum inside each
    ``by`` group, in ``order``) and ``total_name`` (sum of the whole group). NULL is a group like any other.
    """
    rows = _sorted_slices(df, [*by, *order])
    totals = rows.groupBy("_slice", *by).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    # At most (sort partitions + groups) rows; inside one group at most one row per sort partition.
    group = Window.partitionBy(*by)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "_slice", *by,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(group).alias(f"total_{n}") for n in sums],
    )
    inside = Window.partitionBy("_slice", *by).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(c).over(inside).alias(f"_l_{n}") for n, c in sums.items()])
    if by:
        same = reduce(lambda a, b: a & b, [local[c].eqNullSafe(carry[c]) for c in by], local["_slice"] == carry["_slice"])
        joined = local.join(carry, same)
    else:
        joined = local.join(F.broadcast(carry), "_slice")
    return joined.select(
        *[local[c] for c in df.columns],
        *[(F.col(f"_c_{n}") + F.col(f"_l_{n}")).alias(f"cum_{n}") for n in sums],
        *[f"total_{n}" for n in sums],
    )


def number_rows_by(df: DataFrame, by: str, order: list[Column | str], name: str) -> DataFrame:
    """row_number() per key that also splits a key holding a large share of all rows."""
    numbered = running_sums(df.withColumn("_one", F.lit(1)), [by], order, {"one": "_one"})
    return numbered.withColumn(name, F.col("cum_one")).drop("_one", "cum_one", "total_one")
