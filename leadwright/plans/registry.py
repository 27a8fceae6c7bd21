"""Registry of the named queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadwright.plans import features as ft
from leadwright.plans import oracle as oc
from leadwright.session import materialise, tune
from leadwright.sources import roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPAN = ft.Span(oc.START, oc.END, oc.CALLS_UNTIL, oc.SINCE, oc.SINCE, oc.SNAPSHOT)
_RULES = [(label, [("regex", pattern)]) for label, pattern in oc.TIER_PATTERNS]
TIERS = ft.Tiers(_RULES, _RULES)


def query(name: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    """Register a query; ``oracle`` is the SQL body, its common table expressions are added."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oc.statement(oracle, extra)
        return fn
    return register


# Stage tables shared by several queries of one session, as the stages of a daily run share them.
_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGES:
        _STAGES[key] = materialise(build(), name)
    return _STAGES[key]


def forget_stages() -> None:
    _STAGES.clear()


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return roles.role(spark, sf_dir, name)


def event_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their JSON field extracted: fourteen roles read it, most of them several times."""
    return stage(spark, sf_dir, "events", lambda: roles.extracted_events(spark, sf_dir))


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All roles, over the extracted events."""
    return roles.load_roles(spark, sf_dir, event_stage(spark, sf_dir))


def lead_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead base as a stage table: the later stages read it several times."""
    return stage(spark, sf_dir, "lead_base", lambda: ft.lead_base(sources(spark, sf_dir), SPAN))


def feature_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as a stage table, the input of training and scoring."""
    def build() -> DataFrame:
        return ft.feature_table(sources(spark, sf_dir), SPAN, TIERS, lead_stage(spark, sf_dir))
    return stage(spark, sf_dir, "features", build)
