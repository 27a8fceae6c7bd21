"""The daily run: features, points, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leadwright.functions import fixed_values as fx
from leadwright.operators import scorecard as sc
from leadwright.plans import features as ft

OUTPUT = ["total_score", "user_id", "task_id", fx.TARGET, "last_visit_time"]


def daily_scoring(
    src: ft.Sources, span: ft.Span, tiers: ft.Tiers = ft.DEFAULT_TIERS, rules: DataFrame | None = None,
    base: int | None = fx.BASE_POINTS,
) -> DataFrame:
    """Ranked leads from the source roles. Only the columns the rules use survive in the plan."""
    spark = src["crm_task"].sparkSession
    features = ft.feature_table(src, span, tiers)
    scored = sc.score(sc.eligible(features), sc.deployed_rules(spark) if rules is None else rules, base)
    return sc.rank_leads(scored.select(*OUTPUT), recency="last_visit_time", ids=["user_id", "task_id"])
