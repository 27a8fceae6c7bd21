"""Column expressions: category maps, safe casts, recency, URL tails and null filling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadwright.functions import fixed_values as fx

_MATCHERS = {
    "in": lambda col, value: col.isin(value),
    "prefix": lambda col, value: col.startswith(value),
    "contains": lambda col, value: col.contains(value),
    "regex": lambda col, value: col.rlike(value),
}


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def category_map(col: Column | str, rules: list, default: str | None, null_label: str | None = None) -> Column:
    """First matching rule's label; NULL gives ``null_label`` if set, else ``default``."""
    col = as_col(col)
    tests = [
        (reduce(lambda a, b: a | b, [_MATCHERS[op](col, value) for op, value in tests]), label)
        for label, tests in rules
    ]
    if null_label is not None:
        tests.insert(0, (col.isNull(), null_label))
    chain = F
    for test, label in tests:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(default))


def city_class(col: Column | str, tiers: list) -> Column:
    return category_map(col, tiers, fx.TIER_ELSE, fx.TIER_UNKNOWN)


def to_long(col: Column | str) -> Column:
    """Text id to bigint; text that is no number gives NULL instead of an error."""
    return as_col(col).try_cast("bigint")


def to_day(col: Column | str) -> Column:
    """Calendar day of a date, timestamp or text; text that is no date gives NULL."""
    return as_col(col).try_cast("date")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(to_day(later), to_day(earlier))


def url_tail(col: Column | str) -> Column:
    """Text after the last slash; empty when there is no slash."""
    col = as_col(col)
    return F.when(col.contains("/"), F.substring_index(col, "/", -1)).when(col.isNotNull(), F.lit(""))


def flag(test: Column) -> Column:
    """1 where the test holds, 0 where it is false or NULL."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def text_flag(test: Column) -> Column:
    return F.when(test, F.lit("1")).otherwise(F.lit("0"))


def moved_up(home: Column | str, now: Column | str, unknown_label: str = fx.TIER_UNKNOWN) -> Column:
    """'1' when the home tier is below the top and the present tier is the top tier."""
    home, now = as_col(home), as_col(now)
    unknown = (home == fx.TIER_UNKNOWN) | (now == fx.TIER_UNKNOWN)
    up = home.isin(fx.LOWER_TIERS) & (now == "Tier_1")
    return F.when(unknown, F.lit(unknown_label)).otherwise(text_flag(up))


def fill_nulls(df: DataFrame, zero: list[str] = (), text_zero: list[str] = ()) -> DataFrame:
    """0 for counts and amounts, '0' for text flags; every other column keeps its NULLs."""
    fills = {c: 0 for c in zero if c in df.columns} | {c: "0" for c in text_zero if c in df.columns}
    return df.fillna(fills) if fills else df
