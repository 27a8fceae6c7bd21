"""Feature build: from source roles to one leakage-free row per lead.

Two readings are offered. ``mode="lead"`` (default) keys everything on the lead and uses only what was
known before its allocation time. ``mode="reference"`` reproduces the original user-level results, in
which the rows of one user's leads meet each other and each column takes its own maximum. Because only
maxima survive there, they are computed per user first; the rows never meet in a join.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadwright.functions import fixed_values as fx
from leadwright.functions.columns import (
    category_map, city_class, days_between, fill_nulls, flag, moved_up, text_flag, to_day, to_long, url_tail,
)
from leadwright.operators.joins import left_join_many
from leadwright.operators.temporal import Source, conversion_labels, first_by, latest_by, point_in_time
from leadwright.plans.runs import Stage
from leadwright.session import materialise
from leadwright.sources.snapshots import Catalogue, Rule, between, fixed, rolling

Sources = dict[str, DataFrame]


@dataclass(frozen=True)
class Span:
    """Dates of one build; every scan window is a parameter."""

    start: str
    end: str
    calls_until: str
    subscriptions_from: str
    views_from: str
    snapshot: str


@dataclass(frozen=True)
class Tiers:
    """City tier rules for the identity city and for the other five city columns."""

    identity: list
    visits: list


DEFAULT_TIERS = Tiers(fx.ID_CITY_TIERS, fx.VISIT_CITY_TIERS)


# ---------------------------------------------------------------- 01 lead base
def campaign_tasks(task: DataFrame, span: Span) -> DataFrame:
    created = to_day("create_time")
    return task.where(
        F.col("first_chance_name").contains(fx.CAMPAIGN_MARK) & created.between(span.start, span.end)
    ).select(
        "task_id", to_long("target_user_id").alias("user_id"), "target_user_mobile", "first_chance_name",
        "agent_name", "agent_type", F.col("create_time").alias("alloc_time"), created.alias("alloc_date"),
    )


LEAD_COLUMNS = ["user_id", "target_user_mobile", "first_chance_name", "agent_type", "alloc_time", "alloc_date"]


def one_row_per_task(tasks: DataFrame) -> DataFrame:
    """A task given to several agents is one lead; the earliest allocation is kept whole."""
    return first_by(tasks, "task_id", ["alloc_time", *[c for c in LEAD_COLUMNS if c != "alloc_time"]], LEAD_COLUMNS)


def in_call_window(calls: DataFrame, span: Span) -> DataFrame:
    return calls.where(to_day("start_time").between(span.start, span.calls_until))


def connected(col_status: str = "status") -> Column:
    return F.col(col_status) == fx.CONNECTED_STATUS


def not_like_service() -> Column:
    return ~F.col("team_name").contains(fx.SERVICE_TEAM_MARK)


def not_in_service() -> Column:
    return ~F.col("team_name").isin(fx.SERVICE_TEAM_NAME)


def first_connected_call(calls: DataFrame, span: Span) -> DataFrame:
    wanted = in_call_window(calls, span).where(connected() & not_like_service())
    return wanted.groupBy("task_id").agg(F.min("start_time").alias("first_connected_time"))


def mobile_first_calls(calls: DataFrame) -> DataFrame:
    """The very first call of each mobile, of any status and date."""
    firsts = first_by(calls, "mobile", ["start_time", "task_id"], ["start_time", "task_id"])
    return firsts.select("task_id", "start_time").distinct()


def call_flags(leads: DataFrame, calls: DataFrame, span: Span, mode: str) -> DataFrame:
    """``through_flag`` (the earliest connected call came after the allocation) and ``fst_through_flag``
    (the task's first connected call was the first call of its mobile)."""
    windowed = in_call_window(calls, span).where(connected())
    if mode == "lead":
        after = F.col("start_time") > F.col("alloc_time")
        windowed = windowed.join(leads.select("task_id", "alloc_time"), "task_id")
    else:
        after = F.lit(True)
    per_task = windowed.groupBy("task_id").agg(
        F.min(F.when(not_like_service(), F.col("start_time"))).alias("_through"),
        F.min(F.when(not_in_service() & after, F.col("start_time"))).alias("_first"),
    )
    # Matched on the narrow call table, so that the leads keep their partitioning by task.
    firsts = mobile_first_calls(calls).select("task_id", F.col("start_time").alias("_first"), F.lit(1).alias("_seen"))
    marked = per_task.join(firsts, ["task_id", "_first"], "left").select("task_id", "_through", "_seen")
    return (
        leads.join(marked, "task_id", "left")
        .withColumn("through_flag", flag(F.col("_through") > F.col("alloc_time")))
        .withColumn("fst_through_flag", flag(F.col("_seen") == 1))
        .drop("_through", "_seen")
    )


def counted_policies(orders: DataFrame, span: Span) -> DataFrame:
    return orders.where(
        (to_day("policy_time") >= F.lit(span.start).cast("date")) & (F.col("is_long") == 1) & (F.col("valid") == 1)
        & F.col("status").isin(fx.POLICY_STATUS)
    ).select("task_id", "policy_no", "policy_time", "origin")


def campaign_clues(clues: DataFrame) -> DataFrame:
    return clues.where(F.col("chance_type_name").contains(fx.CAMPAIGN_MARK))


def first_clue(clues: DataFrame) -> DataFrame:
    """Channel of the earliest campaign clue per mobile, with the first channel map."""
    firsts = first_by(campaign_clues(clues), "mobile", ["create_time", "clue_id"], ["channel", "subchannel"])
    kind = category_map("channel", fx.CHANNEL_TYPE_INITIAL, fx.CHANNEL_TYPE_INITIAL_ELSE)
    return firsts.select(F.col("mobile").alias("target_user_mobile"), kind.alias("channel_type"), "channel", "subchannel")


def lead_base(src: Sources, span: Span) -> DataFrame:
    """One row per campaign task: allocation, call flags, conversion labels, first clue channel.

    The campaign's tasks are written first: calls and policies are both matched against them, and the full
    task snapshot is then read once.
    """
    leads = materialise(one_row_per_task(campaign_tasks(src["crm_task"], span)), "tasks")
    flagged = call_flags(leads, src["call_record"], span, "lead")
    labels = conversion_labels(leads, counted_policies(src["policy_order"], span), "task_id", "alloc_date",
                               "policy_time", "policy_no", "origin", fx.LABEL_HORIZONS, lower=0)
    counts = [f"t{h}_policy_{x}" for h in fx.LABEL_HORIZONS for x in ("flag", "cnt")]
    return (
        flagged.join(labels, "task_id", "left").fillna(0, counts)
        .join(first_clue(src["clue"]), "target_user_mobile", "left")
    )


def label_groups(src: Sources, span: Span, tasks: DataFrame | None = None) -> DataFrame:
    """Label table at the original grain: one row per task and pair of label flags, policies before the
    allocation counted as early ones, amounts counted once per agent of the task."""
    tasks = campaign_tasks(src["crm_task"], span).distinct() if tasks is None else tasks
    attributes = ["task_id", *LEAD_COLUMNS]
    agents = tasks.groupBy(*attributes).agg(F.count(F.lit(1)).alias("_agents"))
    delay = days_between("policy_time", "alloc_date")
    joined = left_join_many(agents, counted_policies(src["policy_order"], span), ["task_id"])
    for h in fx.LABEL_HORIZONS:
        joined = joined.withColumn(f"t{h}_policy_flag", flag(delay <= h))
    flags = [f"t{h}_policy_flag" for h in fx.LABEL_HORIZONS]
    inside = {h: F.col(f"t{h}_policy_flag") == 1 for h in fx.LABEL_HORIZONS}
    # Folded per policy first: the distinct counts then need no expanded rows.
    per_policy = joined.groupBy(*attributes, "_agents", *flags, "policy_no").agg(
        F.sum(F.col("origin") * F.col("_agents")).alias("_amount")
    )
    grouped = per_policy.groupBy(*attributes, *flags).agg(
        *[F.count(F.when(inside[h], F.col("policy_no"))).alias(f"t{h}_policy_cnt") for h in fx.LABEL_HORIZONS],
        *[F.sum(F.when(inside[h], F.col("_amount"))).alias(f"t{h}_origin") for h in fx.LABEL_HORIZONS],
    )
    return grouped.join(first_clue(src["clue"]), "target_user_mobile", "left")


# ---------------------------------------------------------------- 02 subscriptions and tags
def subscription_flags(wx: DataFrame, span: Span) -> DataFrame:
    """Per user and day: is the user subscribed to an account of each business line."""
    rows = wx.where(F.col("dt").between(span.subscriptions_from, span.snapshot) & (F.col("subscribe") == 1))
    return rows.groupBy("dt", "user_id").agg(
        *[F.max(flag(F.col("third_type").isin(codes))).alias(name) for name, codes in fx.SUBSCRIPTION_CODES.items()]
    )


def first_subscription_days(wx: DataFrame, span: Span) -> DataFrame:
    """First subscribed day per user and line: all that the follow tags need of the history."""
    rows = wx.where(F.col("dt").between(span.subscriptions_from, span.snapshot) & (F.col("subscribe") == 1))
    return rows.groupBy("user_id").agg(
        *[F.min(F.when(F.col("third_type").isin(codes), F.col("dt"))).alias(f"_{name}")
          for name, codes in fx.SUBSCRIPTION_CODES.items()]
    )


FOLLOW_TAGS = {f"_{name}": name.replace("_flag", "_tag") for name in fx.SUBSCRIPTION_CODES}


def add_follow_tags(leads: DataFrame, wx: DataFrame, span: Span, day: str = "alloc_date") -> DataFrame:
    """'1' when the user had subscribed on or before the day before ``day``."""
    days = leads.join(first_subscription_days(wx, span), "user_id", "left")
    known = F.col("user_id").isNotNull()
    tags = {tag: F.when(known, text_flag(F.col(first) <= F.date_sub(F.col(day), 1)))
            for first, tag in FOLLOW_TAGS.items()}
    any_tag = reduce(lambda a, b: a | b, [F.col(t) == "1" for t in FOLLOW_TAGS.values()])
    return days.withColumns(tags).withColumn("follow_tag", text_flag(any_tag)).drop(*FOLLOW_TAGS)


def tag_features(tag: DataFrame, tiers: Tiers) -> DataFrame:
    """User tags with the six city columns mapped to tiers."""
    classes = {
        name: city_class(column, tiers.identity if column == "id_city_name" else tiers.visits)
        for column, name in fx.CITY_COLUMNS.items()
    }
    kept = [*fx.KEEP_NULL_TAGS, "mobile_operator", *fx.ZERO_FILL_TAGS, *fx.FLAG_FILL_TAGS, *fx.TAG_TIMES]
    return tag.select("user_id", *kept, *[c.alias(n) for n, c in classes.items()])


def add_tags(leads: DataFrame, tag: DataFrame, tiers: Tiers, users: DataFrame | None = None) -> DataFrame:
    """``users`` is a stage table with all users of ``leads``: the cities of others are then not matched against the tiers."""
    if users is not None:
        tag = tag.join(users.select("user_id").distinct(), "user_id", "left_semi")
    joined = leads.join(tag_features(tag, tiers), "user_id", "left")
    recency = {name: days_between("alloc_date", column) for column, name in fx.TAG_TIMES.items()}
    return joined.withColumns(recency).drop(*fx.TAG_TIMES)


def add_user_agent(leads: DataFrame, ua: DataFrame) -> DataFrame:
    return leads.join(ua.select("user_id", "ua", "device_type"), "user_id", "left")


# ---------------------------------------------------------------- 05 product pages
def page_view_rows(actions: DataFrame, span: Span, codes: list[str] = fx.PRODUCT_CODES) -> DataFrame:
    code = url_tail("current_original_path")
    return actions.where(
        F.col("dt").between(span.views_from, span.snapshot) & (F.col("biz") == fx.PAGE_BIZ)
        & F.col("operation").isin(fx.PAGE_OPERATION) & (F.col("user_id") != 0) & code.isin(codes)
    ).select("user_id", "operation_time", code.alias("produ_no"))


def product_page_views(actions: DataFrame, span: Span, codes: list[str] = fx.PRODUCT_CODES) -> DataFrame:
    return page_view_rows(actions, span, codes).distinct()


def is_gift_order() -> Column:
    return (F.col("order_type") == 1) & (F.col("policy_no") != "")


def gift_orders(orders: DataFrame) -> DataFrame:
    return orders.where(is_gift_order())


# ---------------------------------------------------------------- 03, 04, 05.2, 07 point-in-time features
VISITS = {  # suffix -> (role, extra counters)
    "cf": ("visit_cf", ["visit_case_cnt", "visit_caseid_num"]),
    "hz": ("visit_hz", ["visit_event_cnt", "visit_payment_cnt"]),
    "bao": ("visit_bao", []),
}
VISIT_FIELDS = ["first_visit_time", "last_visit_time", "last_week_visit_cnt", "visit_cnt"]


def _visit_row(suffix: str) -> Column:
    # Ties at one visit time go to the row that stayed valid longest.
    return F.struct("dw_end_date", *VISIT_FIELDS, *VISITS[suffix][1])


def timeline_sources(src: Sources, span: Span, groups: list[str]) -> list[Source]:
    """Event sources of the asked feature groups, for one shared timeline."""
    out = [Source(src[VISITS[g][0]], "last_visit_time", {f"_{g}": ("last", _visit_row(g))}) for g in groups if g in VISITS]
    if "views" in groups:
        # Both folds below drop repeated rows themselves, so the views need no distinct of their own.
        views = page_view_rows(src["user_action"], span)
        moments = views.groupBy("user_id", "operation_time").agg(F.lit(1).alias("one"))
        products = views.groupBy("user_id", "produ_no").agg(F.min("operation_time").alias("first_seen"))
        out.append(Source(moments, "operation_time", {
            "_views": ("sum", F.col("one")), "_first_view": ("min", F.col("operation_time")),
            "_last_view": ("max", F.col("operation_time"))}))
        out.append(Source(products, "first_seen", {"_products": ("sum", F.lit(1))}))
    if "gifts" in groups:
        rows = gift_orders(src["ins_order"])
        gifts = rows.groupBy("user_id", "id").agg(F.min("create_time").alias("create_time"))
        out.append(Source(gifts, "create_time", {"_gifts": ("sum", F.lit(1))}))
    # The order table is read once for the order history and the latest gift order's channel.
    of_orders = {}
    if "orders" in groups:
        of_orders |= {"cnt": ("sum", F.when(F.col("order_no").isNotNull(), 1).otherwise(0)),
                      "money": ("sum", F.col("money")), "origin": ("sum", F.col("origin"))}
    if "channel" in groups:
        of_orders["_order"] = ("last", F.when(is_gift_order(), F.struct("create_time", "id", "channel")))
    if of_orders:
        out.append(Source(src["ins_order"], "create_time", of_orders))
    if "shares" in groups:
        out.append(Source(src["share_action"], "time", {
            "share_cnt": ("sum", F.lit(1)), "_last_share": ("max", F.col("time"))}))
    if "app" in groups:
        out.append(Source(src["app_tag"], "last_appstart_op_time", {"_app_start": ("max", F.col("last_appstart_op_time"))}))
    return out


def day_after(day: str) -> str:
    """Start of the next day: no lead of a span lies after it."""
    return f"{datetime.date.fromisoformat(day) + datetime.timedelta(days=1)} 00:00:00"


def week_before(at: Column) -> Column:
    """Start of the day seven days before the day of ``at``."""
    return F.date_sub(to_day(at), 7).cast("timestamp_ntz")


FINAL_GROUPS = ["cf", "hz", "bao", "views", "gifts", "channel", "shares", "app"]


def add_point_in_time(leads: DataFrame, src: Sources, span: Span, groups: list[str]) -> DataFrame:
    """Everything known about the lead's user strictly before its allocation time: one timeline, one
    window pass, whatever the number of sources."""
    earlier = {"week": week_before} if "views" in groups else None
    known = point_in_time(leads, "user_id", "alloc_time", timeline_sources(src, span, groups), earlier=earlier, until=day_after(span.end))
    out = leads.join(known, ["user_id", "alloc_time"], "left")
    for g in [g for g in groups if g in VISITS]:
        out = out.withColumns({
            **{f"{f}_{g}": F.col(f"_{g}.{f}") for f in VISIT_FIELDS},
            **{f: F.col(f"_{g}.{f}") for f in VISITS[g][1]},
            f"datediff_first_visit_{g}": days_between("alloc_date", f"_{g}.first_visit_time"),
            f"datediff_last_visit_{g}": days_between("alloc_date", f"_{g}.last_visit_time"),
        })
    if "views" in groups:
        out = out.withColumns({
            "datediff_first_oper_short": days_between("alloc_date", "_first_view"),
            "datediff_last_oper_short": days_between("alloc_date", "_last_view"),
            "total_visit_cnt_short": F.coalesce("_views", F.lit(0)),
            "last_week_visit_cnt_short": F.coalesce("_views", F.lit(0)) - F.coalesce("_views_week", F.lit(0)),
            "product_cnt_short": F.coalesce("_products", F.lit(0)),
        })
    if "gifts" in groups:
        out = out.withColumn("gift_insurance_cnt", F.coalesce("_gifts", F.lit(0)))
    if "channel" in groups:
        out = out.withColumn("order_channel", F.col("_order.channel"))
    if "shares" in groups:
        out = out.withColumn("datediff_lastshare", days_between("alloc_date", "_last_share"))
    if "app" in groups:
        out = out.withColumn("sdb_app_start_flag", flag(F.col("_app_start").isNotNull()))
    # With a second moment asked for, every measure comes back twice; only the view count is used.
    spare = [c for c in out.columns if c.startswith("_") or c.endswith("_week")]
    return out.drop(*spare)


# ---------------------------------------------------------------- 08 final table
ZERO_FILL = [
    *fx.ZERO_FILL_TAGS,
    "last_week_visit_cnt_cf", "visit_cnt_cf", "visit_case_cnt", "visit_caseid_num",
    "last_week_visit_cnt_hz", "visit_cnt_hz", "visit_event_cnt", "visit_payment_cnt",
    "last_week_visit_cnt_bao", "visit_cnt_bao",
    "total_visit_cnt_short", "last_week_visit_cnt_short", "product_cnt_short", "gift_insurance_cnt",
    "sdb_app_start_flag",
]
RECENCIES = [
    "datediff_cf_fst_donate", "datediff_cf_lst_donate", "datediff_lastshare", "datediff_hz_fst_join",
    *[f"datediff_{end}_visit_{g}" for g in VISITS for end in ("first", "last")],
    "datediff_first_oper_short", "datediff_last_oper_short",
]
FINAL_COLUMNS = [
    "user_id", "task_id", "target_user_mobile", "alloc_date", "first_chance_name", "channel_type", "channel_group",
    "agent_type", "t14_policy_flag", *fx.KEEP_NULL_TAGS, *fx.CITY_COLUMNS.values(),
    "id_mostvisit_city_up_flag", "id_wx_city_up_flag", "id_wx_class_concat", "id_mostvisit_class_concat",
    "device_type", "mobile_operator", *FOLLOW_TAGS.values(), "follow_tag",
    *ZERO_FILL, *fx.FLAG_FILL_TAGS, *RECENCIES,
]


def channel_maps(column: str = "order_channel") -> dict[str, Column]:
    return {
        "channel_type": category_map(column, fx.CHANNEL_TYPE_FINAL, fx.CHANNEL_TYPE_FINAL_ELSE),
        "channel_group": category_map(column, fx.CHANNEL_GROUP_FINAL, fx.CHANNEL_GROUP_FINAL_ELSE),
    }


def mobility_columns(unknown_label: str = fx.TIER_UNKNOWN) -> dict[str, Column]:
    return {
        "id_mostvisit_city_up_flag": moved_up("id_city_class", "most_visit_city_class", unknown_label),
        "id_wx_city_up_flag": moved_up("id_city_class", "wx_city_class", unknown_label),
        "id_wx_class_concat": F.concat("id_city_class", "wx_city_class"),
        "id_mostvisit_class_concat": F.concat("id_city_class", "most_visit_city_class"),
    }


def operator_map() -> Column:
    return category_map("mobile_operator", fx.OPERATOR_MAP, fx.OPERATOR_ELSE)


def finish(df: DataFrame, unknown_label: str) -> DataFrame:
    mapped = df.withColumns({**mobility_columns(unknown_label), "mobile_operator": operator_map()})
    return fill_nulls(mapped, ZERO_FILL, fx.FLAG_FILL_TAGS)


def feature_table(src: Sources, span: Span, tiers: Tiers = DEFAULT_TIERS, leads: DataFrame | None = None) -> DataFrame:
    """One row per lead, plus the allocation time and the last visit time for ranking."""
    base = materialise(lead_base(src, span), "lead_base") if leads is None else leads
    base = base.drop("channel_type", "channel", "subchannel")
    rows = add_point_in_time(base, src, span, FINAL_GROUPS)
    return final_columns(add_follow_tags(add_user_agent(add_tags(rows, src["user_tag"], tiers, base), src["user_ua"]), src["wx_detail"], span))


def final_columns(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns(channel_maps()).withColumn(
        "last_visit_time", F.greatest(*[F.col(f"last_visit_time_{g}") for g in VISITS])
    )
    return finish(rows, fx.TIER_UNKNOWN).select(*FINAL_COLUMNS, "alloc_time", "last_visit_time")


# ---------------------------------------------------------------- the build from a store of stamped tables
def source_rules(span: Span, late: int = 1) -> dict[str, Rule]:
    """By which copy each role is read: yesterday's for the call centre's tables, the snapshot's for the tables of users and
    orders, the asked days for increments. Histories have no copies."""
    rules = {r: rolling(1, late) for r in ("crm_task", "call_record", "policy_order", "clue")}
    rules |= {r: fixed(span.snapshot) for r in ("ins_order", "share_action", "app_tag", "user_ua", "user_tag")}
    return rules | {"wx_detail": between(span.subscriptions_from, span.snapshot), "user_action": between(span.views_from, span.snapshot)}


def feature_table_of(spark: SparkSession, catalogue: Catalogue, span: Span, run_date: str, tiers: Tiers = DEFAULT_TIERS) -> DataFrame:
    """The feature table of one run: every copy is resolved from the run date before the first plan is made."""
    return feature_table(catalogue.open(spark, run_date), span, tiers)


def feature_stages(span: Span, tiers: Tiers = DEFAULT_TIERS) -> list[Stage]:
    """The build as a restartable run: leads, what the logs knew of them, user tables, the final columns."""
    def timeline(src: Sources, _) -> DataFrame:
        base = src["lead_base"].drop("channel_type", "channel", "subchannel")
        return add_point_in_time(base, src, span, FINAL_GROUPS)

    def users(src: Sources, _) -> DataFrame:
        rows = add_user_agent(add_tags(src["timeline"], src["user_tag"], tiers, src["timeline"]), src["user_ua"])
        return add_follow_tags(rows, src["wx_detail"], span)

    return [
        Stage("lead_base", ("crm_task", "call_record", "policy_order", "clue"), lambda src, _: lead_base(src, span)),
        Stage("timeline", ("lead_base", *[VISITS[g][0] for g in VISITS], "user_action", "ins_order", "share_action", "app_tag"), timeline),
        Stage("users", ("timeline", "user_tag", "user_ua", "wx_detail"), users),
        Stage("features", ("users",), lambda src, _: final_columns(src["users"])),
    ]


# ---------------------------------------------------------------- original user-level results
def _folded_history(history: DataFrame, suffix: str) -> DataFrame:
    """Rows tied at one visit time as one row of independent maxima (earliest first visit)."""
    counters = ["last_week_visit_cnt", "visit_cnt", *VISITS[suffix][1]]
    return history.groupBy("user_id", "last_visit_time").agg(
        F.min("first_visit_time").alias("first_visit_time"), *[F.max(c).alias(c) for c in counters]
    )


def user_level_features(leads: DataFrame, src: Sources, span: Span) -> DataFrame:
    """Per user: the values that survive when all leads of the user meet all their history rows."""
    sources = []
    for g in VISITS:
        row = F.struct(*VISIT_FIELDS, *VISITS[g][1])
        sources.append(Source(_folded_history(src[VISITS[g][0]], g), "last_visit_time", {f"_{g}": ("last", row)}))
    sources += timeline_sources(src, span, ["views"])
    known = point_in_time(leads, "user_id", "alloc_time", sources, earlier={"week": week_before}, until=day_after(span.end))
    per_day = known.withColumn("_day", to_day("alloc_time")).withColumn(
        "_week_views", F.coalesce("_views", F.lit(0)) - F.coalesce("_views_week", F.lit(0))
    )
    visit_max = [
        F.max(f"_{g}.{f}").alias(f"{f}_{g}" if f in VISIT_FIELDS else f)
        for g in ("cf", "hz") for f in ["last_week_visit_cnt", "visit_cnt", *VISITS[g][1]]
    ]
    visit_min = [F.min(f"_{g}.{f}_visit_time").alias(f"_{f}_{g}") for g in ("cf", "hz") for f in ("first", "last")]
    by_day = per_day.groupBy("user_id", "_day").agg(
        *visit_max, *visit_min, F.max(F.struct("alloc_time", "_bao")).alias("_newest"),
        F.max("_views").alias("total_visit_cnt_short"), F.max("_week_views").alias("last_week_visit_cnt_short"),
        F.max("_products").alias("product_cnt_short"), F.min("_first_view").alias("_first_view"),
        F.max("_last_view").alias("_last_view"),
    )
    maxima = [c for c in by_day.columns if not c.startswith("_") and c != "user_id"]
    minima = [f"_{f}_{g}" for g in ("cf", "hz") for f in ("first", "last")] + ["_first_view", "_last_view"]
    users = by_day.groupBy("user_id").agg(
        *[F.max(c).alias(c) for c in maxima], *[F.min(c).alias(c) for c in minima],
        F.max("_newest").alias("_newest"), F.max("_day").alias("_max_day"),
    )
    return users.withColumn("_bao", F.col("_newest._bao")).drop("_newest")


def gift_counts_by_user(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct gift orders up to and including the user's last allocation day."""
    joined = gift_orders(orders).join(users.select("user_id", "_max_day"), "user_id")
    counted = joined.where(to_day("create_time") <= F.col("_max_day"))
    return counted.groupBy("user_id").agg(F.countDistinct("id").alias("gift_insurance_cnt"))


def latest_order_channels(orders: DataFrame) -> DataFrame:
    """Channel type and group of each user's latest gift order; ties take each label's maximum."""
    mapped = gift_orders(orders).withColumns(channel_maps("channel"))
    tied = mapped.groupBy("user_id", "create_time").agg(
        F.max("channel_type").alias("channel_type"), F.max("channel_group").alias("channel_group")
    )
    return latest_by(tied, "user_id", ["create_time"], ["channel_type", "channel_group"])


def feature_table_reference(src: Sources, span: Span, tiers: Tiers = DEFAULT_TIERS) -> DataFrame:
    """The original result, one row per user and task, without the joins that multiply rows."""
    leads = materialise(campaign_tasks(src["crm_task"], span).distinct(), "tasks")
    labels = label_groups(src, span, leads)
    kept = ["target_user_mobile", "alloc_date", "first_chance_name", "agent_type", "t14_policy_flag"]
    tasks = labels.groupBy("user_id", "task_id").agg(*[F.max(c).alias(c) for c in kept])
    users = user_level_features(leads, src, span)
    last_days = leads.groupBy("user_id").agg(F.max("alloc_date").alias("_max_day"))
    shares = src["share_action"].where(F.col("dt") == F.lit(span.snapshot).cast("date")).groupBy("user_id").agg(
        F.max("time").alias("_last_share"))
    apps = src["app_tag"].groupBy("user_id").agg(F.max("last_appstart_op_time").alias("_app_start"))
    rows = tasks
    for part in (users, gift_counts_by_user(last_days, src["ins_order"]), latest_order_channels(src["ins_order"]), shares, apps):
        rows = rows.join(part, "user_id", "left")
    rows = add_user_agent(add_tags(rows, src["user_tag"], tiers, leads), src["user_ua"])
    rows = add_follow_tags(rows, src["wx_detail"], span, "_max_day")
    day = {  # the behaviour recencies use the user's last allocation day, the log recencies the lead's own
        **{f"datediff_{f}_visit_{g}": days_between("_max_day", f"_{f}_{g}") for g in ("cf", "hz") for f in ("first", "last")},
        **{f"datediff_{f}_visit_bao": days_between("alloc_date", f"_bao.{f}_visit_time") for f in ("first", "last")},
        "last_week_visit_cnt_bao": F.col("_bao.last_week_visit_cnt"), "visit_cnt_bao": F.col("_bao.visit_cnt"),
        "datediff_first_oper_short": days_between("alloc_date", "_first_view"),
        "datediff_last_oper_short": days_between("alloc_date", "_last_view"),
        "datediff_lastshare": days_between("alloc_date", "_last_share"),
        "sdb_app_start_flag": flag(F.col("_app_start").isNotNull()),
        "channel_type": F.coalesce("channel_type", F.lit(fx.CHANNEL_TYPE_FINAL_ELSE)),
        "channel_group": F.coalesce("channel_group", F.lit(fx.CHANNEL_GROUP_FINAL_ELSE)),
    }
    return finish(rows.withColumns(day), fx.TIER_UNKNOWN_MISSPELT).select(*FINAL_COLUMNS)


# ---------------------------------------------------------------- checks on the table
def leakage_audit(rows: DataFrame, event_times: dict[str, str], at: str = "alloc_time") -> DataFrame:
    """Per feature time column: rows in all and rows whose event is not strictly before ``at``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(c).alias("ts")) for n, c in event_times.items()])
    long = rows.select(at, F.explode(pairs).alias("p")).select(at, "p.feature", "p.ts")
    return long.groupBy("feature").agg(
        F.count("ts").alias("n_events"), F.sum(flag(F.col("ts") >= F.col(at))).alias("n_leaks")
    )


EVENT_TIMES = {
    "visit_cf": "last_visit_time", "visit_hz": "last_visit_time", "visit_bao": "last_visit_time", "user_action": "operation_time",
    "ins_order": "create_time", "share_action": "time", "app_tag": "last_appstart_op_time", "wx_detail": "dt",
}


def without_later_events(src: Sources, cuts: DataFrame, times: dict[str, str] = EVENT_TIMES) -> Sources:
    """The sources without the events of a user at or after that user's ``cut``; users without one keep all."""
    out = dict(src)
    for role, ts in times.items():
        own = src[role]
        cut = F.col("_cut") if dict(own.dtypes)[ts] != "date" else F.col("_cut").cast("date")
        met = own.join(cuts.select(F.col("user_id").alias("_user"), F.col("cut").alias("_cut")), F.col("user_id") == F.col("_user"), "left")
        out[role] = met.where(F.col("_cut").isNull() | F.col(ts).isNull() | (F.col(ts) < cut)).select(*own.columns)
    return out


def changed_columns(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per column the rows, and those whose value differs between two builds of the same rows."""
    joined = before.alias("a").join(after.alias("b"), keys)
    counts = joined.agg(F.count(F.lit(1)).alias("rows"), *[
        F.sum(F.when(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), 0).otherwise(1)).alias(f"_{c}") for c in columns])
    return counts.select("rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_{c}").alias("changed")) for c in columns])).alias("c")).select("c.feature", "rows", "c.changed")


def leakage_by_perturbation(src: Sources, build: Callable[[Sources], DataFrame], first_leads: DataFrame, columns: list[str]) -> DataFrame:
    """Rebuild the features without any event at or after each user's first allocation, and compare the first leads' rows.

    ``first_leads`` has user_id, task_id and cut, one row per user. A feature that changes has used what was not known yet, also where no column shows the
    time of what it was made from.
    """
    wanted = first_leads.select("user_id", "task_id")
    whole, cut = (build(s).join(wanted, ["user_id", "task_id"], "left_semi").select("user_id", "task_id", *columns)
                  for s in (src, without_later_events(src, first_leads)))
    return changed_columns(materialise(whole, "audit"), materialise(cut, "audit"), ["user_id", "task_id"], columns)


def mature(leads: DataFrame, as_of: str, days: int = fx.MATURATION_DAYS, day: str = "alloc_date") -> DataFrame:
    """Leads old enough for their label to be final."""
    return leads.where(F.col(day) <= F.date_sub(F.lit(as_of).cast("date"), days))


def training_window(leads: DataFrame, as_of: str, months: int, days: int = fx.MATURATION_DAYS) -> DataFrame:
    """Matured leads of the last ``months`` months."""
    since = F.add_months(F.lit(as_of).cast("date"), -months)
    return mature(leads, as_of, days).where(F.col("alloc_date") >= since)
