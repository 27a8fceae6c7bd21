"""Point-in-time operators: what was known about a key strictly before a moment.

``point_in_time`` puts the moments asked for ("probes") and the events of any number of sources on
one timeline per key, and reads running aggregates off it. No pair of probe and event is ever formed, so the
work is linear in the rows, and no large key is handled as a whole: a key with very many rows is spread over its
days, a day with very many over its minutes or seconds, a small table carries the aggregates of the earlier
ones, and copies at one instant are folded before they are shuffled. Only events of the keys
asked for, up to the last moment asked for, are read on. Nothing runs before the result is asked for.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadwright.functions.columns import as_col, days_between


@dataclass(frozen=True)
class Source:
    """Events with a time column and measures ``name -> (how, column)``; how is sum, min, max or last.

    The ``last`` measures of a source come from one row: the last in which any of them is not NULL. Of rows
    at one instant that is the one with the greatest values, in the order of the measures.
    """

    df: DataFrame
    ts: str
    measures: dict[str, tuple[str, Column]]


_RUNNING = {
    "sum": lambda c: F.sum(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "last": lambda c: F.last(c, ignorenulls=True),
}
# Several events of one key at one instant; "last" takes the greatest row.
_SAME_INSTANT = {"sum": F.sum, "min": F.min, "max": F.max, "last": F.max}
_WITH_CARRY = {
    "sum": lambda here, carry: F.when(here.isNull(), carry).otherwise(here + F.coalesce(carry, F.lit(0))),
    "min": lambda here, carry: F.least(here, carry),
    "max": lambda here, carry: F.greatest(here, carry),
    "last": lambda here, carry: F.coalesce(here, carry),
}


#: Events of one key and day from which on the day is cut into minutes, and times 1,000 into seconds. A tenth of it in all is
#: what makes a key hot: its days are then handled apart. Fewer than ten in so many rows can be such a key, and fewer than
#: one such a day, which bounds the table of them that is broadcast.
HOT_ROWS = 2_000_000


def _events(sources: list[Source], key: str, at_type: str, limit: Column, strict: bool) -> DataFrame:
    """The events that can count; ``last`` measures as one row column per source."""
    events = None
    for i, source in enumerate(sources):
        ts = as_col(source.ts)
        if source.df.select(ts).dtypes[0][1] != at_type:
            ts = ts.cast(at_type)
        known = source.df.where(((ts < limit) if strict else (ts <= limit)) & as_col(key).isNotNull() & F.to_date(ts).isNotNull())
        lasts = {n: col for n, (how, col) in source.measures.items() if how == "last"}
        some = reduce(lambda a, b: a | b, [c.isNotNull() for c in lasts.values()], F.lit(False))
        row = [F.when(some, F.struct(*[c.alias(n) for n, c in lasts.items()])).alias(f"_last{i}")] if lasts else []
        part = known.select(
            as_col(key).alias("_k"), ts.alias("_ts"),
            *[col.alias(n) for n, (how, col) in source.measures.items() if how != "last"], *row,
        )
        events = part if events is None else events.unionByName(part, allowMissingColumns=True)
    return events


def _sliced(rows: DataFrame, events: DataFrame, measures: list[str], hot_rows: int) -> DataFrame:
    """``rows`` with ``_day`` and ``_slice``: one place, the slice -1, for most keys; for those with very many ``events`` the
    day, and for their days with very many the minute or second of the day. ``measures`` are not read: the counts need keys and times alone."""
    days = events.drop(*measures).groupBy("_k", F.to_date("_ts").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    width = F.when(F.col("_n") > hot_rows * 1000, 1).when(F.col("_n") > hot_rows, 60)
    cut = F.collect_list(F.when(width.isNotNull(), F.struct("_d", width)))  # without NULLs: hot days only
    hot = days.groupBy("_k").agg(F.sum("_n").alias("_n"), F.map_from_entries(cut).alias("_widths")).where(
        F.col("_n") * 10 > hot_rows).select("_k", "_widths")
    second = F.hour("_ts") * 3600 + F.minute("_ts") * 60 + F.second("_ts")
    met, many = rows.join(F.broadcast(hot), "_k", "left"), F.col("_widths").isNotNull()
    day = F.coalesce(F.when(many, F.to_date("_ts")), F.lit("1970-01-01").cast("date"))  # never NULL, so that no test for it is pushed down
    place = F.when(many, F.coalesce(F.floor(second / F.col("_widths")[F.to_date("_ts")]).cast("int"), F.lit(0)))
    return met.withColumns({"_day": day, "_slice": F.coalesce(place, F.lit(-1))}).drop("_widths")


def point_in_time(
    probes: DataFrame,
    key: str,
    at: str,
    sources: list[Source],
    strict: bool = True,
    earlier: dict[str, Callable[[Column], Column]] | None = None,
    until: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For every distinct (``key``, ``at``) of ``probes``: the measures over all events before ``at``.

    ``strict`` excludes events at the very moment. ``earlier`` maps a suffix to a function of ``at``
    giving a second moment, not after ``at``; the measures at it are returned as ``<measure>_<suffix>``.
    Times are compared in the type of ``at``. ``until`` is a moment that no probe lies after, where the caller knows
    one: it reaches the scans as a constant. Without it the last moment asked for is found as part of the plan.
    """
    earlier = earlier or {}
    kinds = {n: how for s in sources for n, (how, _) in s.measures.items() if how != "last"}
    lasts = {f"_last{i}": [n for n, (how, _) in s.measures.items() if how == "last"] for i, s in enumerate(sources)}
    lasts = {row: names for row, names in lasts.items() if names}
    held = kinds | {row: "last" for row in lasts}
    moments = (
        probes.select(F.col(key).alias("_k"), F.col(at).alias("_at"))
        .where(F.col("_k").isNotNull() & F.col("_at").isNotNull())
        .distinct()
    )
    at_type = moments.dtypes[1][1]
    limit = F.lit(until).cast(at_type) if until else probes.where(F.col(key).isNotNull()).agg(F.max(at)).scalar()
    points = F.array(
        F.struct(F.lit("").alias("tag"), F.col("_at").alias("ts")),
        *[F.struct(F.lit(tag).alias("tag"), f(F.col("_at")).alias("ts")) for tag, f in earlier.items()],
    )
    probe_kind, event_kind = (0, 1) if strict else (1, 0)
    asked = moments.select("_k", "_at", F.explode(points).alias("_p")).select(
        "_k", "_at", F.col("_p.tag").alias("_tag"), F.col("_p.ts").alias("_ts"), F.lit(probe_kind).alias("_kind")
    ).where(F.to_date("_ts").isNotNull())
    found = _events(sources, key, at_type, limit, strict)
    events = found.join(moments.select("_k").distinct(), "_k", "left_semi")
    folded = events.groupBy("_k", "_ts").agg(*[_SAME_INSTANT[how](n).alias(n) for n, how in held.items()])
    rows = asked.unionByName(folded.withColumn("_kind", F.lit(event_kind)), allowMissingColumns=True)
    place = ["_k", "_day", "_slice"]
    # Shuffled once, for the running values and for the totals: both name every column.
    rows = _sliced(rows, found, list(held), hot_rows).repartition(*place)
    inside = Window.partitionBy(*place).orderBy("_ts", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select(
        *place, "_at", "_tag", *[_RUNNING[how](n).over(inside).alias(n) for n, how in held.items()]
    ).where(F.col("_tag").isNotNull())
    # One row per slice of a hot key; the slices of one key are few, however many rows they hold. With the (never met) test of the
    # task's number it stays above the shuffle, which would not be shared otherwise.
    sliced = (F.col("_slice") >= 0) | (F.spark_partition_id() < 0)
    totals = rows.where(sliced).groupBy(*place).agg(
        F.max(F.xxhash64("_at", "_tag", "_kind")).alias("_any"),
        *[(F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_ts"))) if how == "last" else _SAME_INSTANT[how](n)).alias(n)
          for n, how in held.items()]).where(F.col("_any").isNotNull())
    before = Window.partitionBy("_k").orderBy("_day", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(*place, *[_RUNNING[how](n).over(before).alias(f"_c_{n}") for n, how in held.items()])
    known = running.join(carries, place, "left").select(
        "_k", "_at", "_tag", *[_WITH_CARRY[how](F.col(n), F.col(f"_c_{n}")).alias(n) for n, how in held.items()])
    known = known.select("_k", "_at", "_tag", *kinds, *[F.col(f"{row}.{n}").alias(n) for row, names in lasts.items() for n in names])
    measures = [*kinds, *[n for names in lasts.values() for n in names]]
    if not earlier:
        return known.select(F.col("_k").alias(key), F.col("_at").alias(at), *measures)
    picked = [
        F.first(F.when(F.col("_tag") == tag, F.col(n)), ignorenulls=True).alias(n if tag == "" else f"{n}_{tag}")
        for tag in ["", *earlier] for n in measures
    ]
    return known.groupBy(F.col("_k").alias(key), F.col("_at").alias(at)).agg(*picked)


def asof_join(
    leads: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    history_ts: str,
    columns: list[str],
    tie: list[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Left join of each lead with its last history row before ``at``; ties go to the greatest
    ``tie`` columns, then to the greatest ``columns``."""
    row = F.struct(*tie, history_ts, *[c for c in columns if c != history_ts and c not in tie])
    found = point_in_time(leads, key, at, [Source(history, history_ts, {"_last": ("last", row)})], strict)
    return leads.join(found, [key, at], "left").select(*leads.columns, *[f"_last.{c}" for c in columns])


def first_by(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The earliest row's ``columns`` per key. Folded on the map side, unlike a row_number window."""
    row = F.min(F.struct(*order, *[c for c in columns if c not in order])).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[f"_row.{c}" for c in columns])


def latest_by(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The latest row's ``columns`` per key."""
    row = F.max(F.struct(*order, *[c for c in columns if c not in order])).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[f"_row.{c}" for c in columns])


def conversion_labels(
    leads: DataFrame,
    orders: DataFrame,
    on: str,
    lead_date: str,
    order_ts: str,
    order_id: str,
    amount: str,
    horizons: list[int],
    lower: int | None = 0,
) -> DataFrame:
    """Per lead with orders and per horizon h: ``t<h>_policy_flag``, ``t<h>_policy_cnt`` (distinct orders)
    and ``t<h>_origin`` (amount, NULL if none), for orders from ``lower`` to h days after the lead.

    Two aggregation levels replace the distinct counts, so no row is expanded and a lead with very
    many orders is folded before the last shuffle.
    """
    delay = days_between(order_ts, lead_date)
    joined = orders.join(leads.select(on, lead_date), on).withColumn("_delay", delay)

    def inside(h: int) -> Column:
        test = F.col("_delay") <= h
        return test if lower is None else test & (F.col("_delay") >= lower)

    per_order = joined.groupBy(on, order_id).agg(
        *[F.max(F.when(inside(h), 1).otherwise(0)).alias(f"_in{h}") for h in horizons],
        *[F.sum(F.when(inside(h), F.col(amount))).alias(f"_amt{h}") for h in horizons],
    )
    counted = F.col(order_id).isNotNull()
    return per_order.groupBy(on).agg(
        *[F.max(f"_in{h}").alias(f"t{h}_policy_flag") for h in horizons],
        *[F.sum(F.when(counted, F.col(f"_in{h}")).otherwise(0)).alias(f"t{h}_policy_cnt") for h in horizons],
        *[F.sum(f"_amt{h}").alias(f"t{h}_origin") for h in horizons],
    )
