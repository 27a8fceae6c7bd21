"""Queries on scans, filters, joins, folds and windows of the source roles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadwright.functions import fixed_values as fx
from leadwright.functions.columns import category_map, city_class, days_between, text_flag, to_day, to_long, url_tail
from leadwright.operators import temporal as tp
from leadwright.operators.joins import left_join_many
from leadwright.operators.ordered import number_rows_by
from leadwright.plans import features as ft
from leadwright.plans import oracle as oc
from leadwright.plans.registry import SPAN, TIERS, query, role
from leadwright.session import shared_dir
from leadwright.sources import roles, tables


# ---------------------------------------------------------------- scans
@query("scan_snapshot_rolling",
       f"SELECT task_id, target_user_id, create_time, dt FROM stamped WHERE dt = DATE '{oc.AS_OF}' - 1",
       {"stamped": roles.duck_snapshots("crm_task")})
def scan_snapshot_rolling(spark, sf):
    rows = tables.snapshot_before(roles.snapshots(spark, sf, "crm_task"), oc.AS_OF)
    return rows.select("task_id", "target_user_id", "create_time", "dt")


@query("scan_snapshot_fixed", "SELECT id, user_id, money, dt FROM stamped WHERE dt = DATE '2024-01-29'",
       {"stamped": roles.duck_snapshots("ins_order")})
def scan_snapshot_fixed(spark, sf):
    return tables.snapshot_on(roles.snapshots(spark, sf, "ins_order"), "2024-01-29").select("id", "user_id", "money", "dt")


@query("scan_partition_range",
       "SELECT user_id, operation_time, dt FROM user_action WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'")
def scan_partition_range(spark, sf):
    return tables.increments(role(spark, sf, "user_action"), "2024-01-10", "2024-01-20").select("user_id", "operation_time", "dt")


def scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_roundtrip", "SELECT task_id, target_user_id, first_chance_name, agent_type, create_time, dt FROM crm_task")
def csv_roundtrip(spark, sf):
    rows = role(spark, sf, "crm_task").select("task_id", "target_user_id", "first_chance_name", "agent_type", "create_time", "dt")
    return tables.read_csv(spark, tables.write_csv(rows, scratch(spark, "tasks-csv")), rows.schema)


@query("stage_materialise", "SELECT dt, user_id, follow_hz_flag, follow_cf_flag, follow_sdb_flag FROM subscribed")
def stage_materialise(spark, sf):
    """Subscription flags written as a table partitioned by day, then read back."""
    path = tables.write_dated(ft.subscription_flags(role(spark, sf, "wx_detail"), SPAN), scratch(spark, "subscriptions"))
    return spark.read.parquet(path).select("dt", "user_id", *fx.SUBSCRIPTION_CODES)


# ---------------------------------------------------------------- filters
@query("distinct_task_call", "SELECT DISTINCT task_id, mobile FROM call_record")
def distinct_task_call(spark, sf):
    return role(spark, sf, "call_record").select("task_id", "mobile").distinct()


@query("case_city_tier", "SELECT user_id, {} FROM user_tag".format(
    ", ".join(f"{oc.tier(c)} AS {n}" for c, n in fx.CITY_COLUMNS.items())))
def case_city_tier(spark, sf):
    return role(spark, sf, "user_tag").select(
        "user_id", *[city_class(c, TIERS.visits).alias(n) for c, n in fx.CITY_COLUMNS.items()])


@query("filter_policy_orders", "SELECT task_id, policy_no, policy_time, origin FROM policies")
def filter_policy_orders(spark, sf):
    return ft.counted_policies(role(spark, sf, "policy_order"), SPAN)


@query("filter_date_window", "SELECT task_id, create_time, first_chance_name FROM crm_task WHERE create_time >= "
       "TIMESTAMP '2024-01-08' AND create_time < TIMESTAMP '2024-01-16'")
def filter_date_window(spark, sf):
    rows = role(spark, sf, "crm_task").where(to_day("create_time").between("2024-01-08", "2024-01-15"))
    return rows.select("task_id", "create_time", "first_chance_name")


@query("filter_in_list", f"SELECT user_id, third_type, dt FROM wx_detail WHERE {oc.any_of('third_type', [3, 17, 61, 115, 116])}")
def filter_in_list(spark, sf):
    rows = role(spark, sf, "wx_detail").where(F.col("third_type").isin(fx.SUBSCRIPTION_CODES["follow_cf_flag"]))
    return rows.select("user_id", "third_type", "dt")


@query("filter_team_not_in", "SELECT call_id, team_name FROM call_record WHERE team_name <> 'Customer Service Team'")
def filter_team_not_in(spark, sf):
    return role(spark, sf, "call_record").where(ft.not_in_service()).select("call_id", "team_name")


@query("filter_like_channel", "SELECT clue_id, channel FROM clue WHERE regexp_matches(channel, '^(SQ|lesson)|app')")
def filter_like_channel(spark, sf):
    c = F.col("channel")
    return role(spark, sf, "clue").where(c.like("SQ%") | c.like("lesson%") | c.like("%app%")).select("clue_id", "channel")


@query("filter_team_not_like", "SELECT call_id, team_name FROM call_record WHERE NOT contains(team_name, 'Customer Service')")
def filter_team_not_like(spark, sf):
    return role(spark, sf, "call_record").where(ft.not_like_service()).select("call_id", "team_name")


@query("filter_known_city", "SELECT task_id, user_id, most_visit_city_class FROM leads0 JOIN lead_tags USING (task_id) "
       "WHERE most_visit_city_class IS NOT NULL")
def filter_known_city(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    classes = role(spark, sf, "user_tag").select("user_id", city_class("most_visit_city", TIERS.visits).alias("most_visit_city_class"))
    rows = leads.join(classes, "user_id", "left").where(F.col("most_visit_city_class").isNotNull())
    return rows.select("task_id", "user_id", "most_visit_city_class")


# ---------------------------------------------------------------- joins
@query("join_task_policy", "SELECT t.task_id, agent_name, policy_no, policy_time FROM crm_task t LEFT JOIN policies p "
       "ON p.task_id = t.task_id")
def join_task_policy(spark, sf):
    policies = ft.counted_policies(role(spark, sf, "policy_order"), SPAN)
    joined = left_join_many(role(spark, sf, "crm_task"), policies, ["task_id"])
    return joined.select("task_id", "agent_name", "policy_no", "policy_time")


@query("first_clue_channel", "SELECT task_id, target_user_mobile, channel, subchannel, channel_type FROM leads0 "
       "LEFT JOIN clue1 ON mobile = target_user_mobile")
def first_clue_channel(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    rows = leads.join(ft.first_clue(role(spark, sf, "clue")), "target_user_mobile", "left")
    return rows.select("task_id", "target_user_mobile", "channel", "subchannel", "channel_type")


@query("join_back_extreme", "SELECT o.user_id, o.id, o.create_time, o.money FROM ins_order o JOIN (SELECT user_id, "
       "max(create_time) AS create_time FROM ins_order GROUP BY user_id) m USING (user_id, create_time)")
def join_back_extreme(spark, sf):
    """The whole row of each user's latest order, without joining the maximum back."""
    return tp.latest_by(role(spark, sf, "ins_order"), "user_id", ["create_time", "id"], ["id", "create_time", "money"])


VISIT_OUT = {g: [f"{f}_{g}" for f in ft.VISIT_FIELDS] + extras for g, (_, extras) in ft.VISITS.items()}


def _asof(spark, sf, g):
    role_name, extras = ft.VISITS[g]
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN)).select("task_id", "user_id", "alloc_time")
    fields = [*ft.VISIT_FIELDS, *extras]
    found = tp.asof_join(leads, role(spark, sf, role_name), "user_id", "alloc_time", "last_visit_time", fields,
                         tie=["dw_end_date", "first_visit_time"])
    return found.select("task_id", "user_id", "alloc_time", *[F.col(a).alias(b) for a, b in zip(fields, VISIT_OUT[g])])


for _g in ft.VISITS:
    query(f"asof_visit_{_g}", f"SELECT l.task_id, l.user_id, l.alloc_time, {', '.join(VISIT_OUT[_g])} "
          "FROM leads0 l JOIN lead_visits v USING (task_id)")(lambda spark, sf, g=_g: _asof(spark, sf, g))


def _asof_reference(spark, sf, g):
    """History rows that are some allocation's last row before it, ties included: a semi join on the found
    moments, so leads and history rows never multiply."""
    leads = ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN)
    role_name, extras = ft.VISITS[g]
    history = role(spark, sf, role_name)
    newest = tp.point_in_time(leads, "user_id", "alloc_time", [
        tp.Source(history, "last_visit_time", {"last_visit_time": ("max", F.col("last_visit_time"))})])
    moments = newest.select("user_id", "last_visit_time").distinct()
    rows = history.join(moments, ["user_id", "last_visit_time"], "left_semi").distinct()
    return rows.select("user_id", *ft.VISIT_FIELDS, *extras)


for _g, (_, _extras) in ft.VISITS.items():
    query(f"asof_visit_{_g}_reference", f"SELECT user_id, {', '.join([*ft.VISIT_FIELDS, *_extras])} FROM ref_{_g}_rows")(
        lambda spark, sf, g=_g: _asof_reference(spark, sf, g))


@query("events_before_alloc", "SELECT l.task_id, count(a.operation_time) AS n_events, max(a.operation_time) AS last_event "
       "FROM leads0 l LEFT JOIN user_action a ON a.user_id = l.user_id AND a.operation_time < l.alloc_time GROUP BY l.task_id")
def events_before_alloc(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    known = tp.point_in_time(leads, "user_id", "alloc_time", [tp.Source(role(spark, sf, "user_action"), "operation_time", {
        "n_events": ("sum", F.lit(1)), "last_event": ("max", F.col("operation_time"))})])
    rows = leads.join(known, ["user_id", "alloc_time"], "left")
    return rows.select("task_id", F.coalesce("n_events", F.lit(0)).alias("n_events"), "last_event")


@query("follow_tags_asof", "SELECT task_id, follow_hz_tag, follow_cf_tag, follow_sdb_tag, CASE WHEN '1' IN (follow_hz_tag, "
       "follow_cf_tag, follow_sdb_tag) THEN '1' ELSE '0' END AS follow_tag FROM follow")
def follow_tags_asof(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    return ft.add_follow_tags(leads, role(spark, sf, "wx_detail"), SPAN).select("task_id", *ft.FOLLOW_TAGS.values(), "follow_tag")


@query("task_dial_count", f"SELECT task_id, count(DISTINCT start_time) AS dials FROM call_record WHERE {oc._CALL_DAYS} GROUP BY task_id")
def task_dial_count(spark, sf):
    return ft.in_call_window(role(spark, sf, "call_record"), SPAN).groupBy("task_id").agg(F.countDistinct("start_time").alias("dials"))


# ---------------------------------------------------------------- folds
_LABEL_OUT = ["task_id", *ft.LEAD_COLUMNS, "t7_policy_flag", "t14_policy_flag", "t7_policy_cnt", "t7_origin", "t14_policy_cnt",
              "t14_origin", "channel_type", "channel", "subchannel"]


@query("label_base", f"SELECT {', '.join(_LABEL_OUT)}, through_flag, fst_through_flag FROM ref_labels JOIN lead_flags USING (task_id)")
def label_base(spark, sf):
    """Labels at the original grain, with the call flags of the task."""
    rows = ft.label_groups({r: role(spark, sf, r) for r in ("crm_task", "policy_order", "clue")}, SPAN)
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    flags = ft.call_flags(leads, role(spark, sf, "call_record"), SPAN, "lead").select("task_id", "through_flag", "fst_through_flag")
    rounded = rows.withColumns({c: F.round(c, 4) for c in ("t7_origin", "t14_origin")}).select(*_LABEL_OUT)
    return rounded.join(flags, "task_id").select(*_LABEL_OUT, "through_flag", "fst_through_flag")



@query("first_connected_call", "SELECT task_id, min(start_time) AS first_connected_time FROM connected_calls "
       "WHERE team_name NOT LIKE '%Customer Service%' GROUP BY task_id")
def first_connected_call(spark, sf):
    return ft.first_connected_call(role(spark, sf, "call_record"), SPAN)


@query("subscribe_flags_daily", "SELECT dt, user_id, follow_hz_flag, follow_cf_flag, follow_sdb_flag FROM subscribed")
def subscribe_flags_daily(spark, sf):
    return ft.subscription_flags(role(spark, sf, "wx_detail"), SPAN)


@query("share_counts", f"SELECT user_id, count(*) AS share_cnt, CAST(max(time) AS DATE) AS last_share_date, "
       f"date_diff('day', CAST(max(time) AS DATE), DATE '{oc.AS_OF}') AS days_since_share FROM share_action GROUP BY user_id")
def share_counts(spark, sf):
    shares = tables.increments(role(spark, sf, "share_action"), SPAN.views_from, SPAN.snapshot)
    last = to_day(F.max("time"))
    return shares.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("share_cnt"), last.alias("last_share_date"),
        F.datediff(F.lit(oc.AS_OF).cast("date"), last).cast("bigint").alias("days_since_share"))


@query("order_history_agg", "SELECT user_id, count(order_no) AS cnt, round(sum(money), 4) AS money, round(sum(origin), 4) AS origin "
       "FROM ins_order GROUP BY user_id")
def order_history_agg(spark, sf):
    return role(spark, sf, "ins_order").groupBy("user_id").agg(
        F.count("order_no").alias("cnt"), F.round(F.sum("money"), 4).alias("money"), F.round(F.sum("origin"), 4).alias("origin"))


def _labels(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    return tp.conversion_labels(leads, ft.counted_policies(role(spark, sf, "policy_order"), SPAN), "task_id", "alloc_date",
                                "policy_time", "policy_no", "origin", fx.LABEL_HORIZONS)


_LABELLED = "WHERE task_id IN (SELECT task_id FROM policies)"


@query("policy_counts_7_14", f"SELECT task_id, t7_policy_cnt, t14_policy_cnt FROM lead_labels {_LABELLED}")
def policy_counts_7_14(spark, sf):
    return _labels(spark, sf).select("task_id", "t7_policy_cnt", "t14_policy_cnt")


@query("policy_amount_7_14", f"SELECT task_id, t7_origin, t14_origin FROM lead_labels {_LABELLED}")
def policy_amount_7_14(spark, sf):
    return _labels(spark, sf).select("task_id", F.round("t7_origin", 4).alias("t7_origin"), F.round("t14_origin", 4).alias("t14_origin"))


@query("conversion_labels", "SELECT task_id, t7_policy_flag, t14_policy_flag FROM lead_labels")
def conversion_labels(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN)).select("task_id")
    flags = ["t7_policy_flag", "t14_policy_flag"]
    return leads.join(_labels(spark, sf).select("task_id", *flags), "task_id", "left").fillna(0, flags)


@query("through_flag", "SELECT task_id, through_flag FROM lead_flags")
def through_flag(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    return ft.call_flags(leads, role(spark, sf, "call_record"), SPAN, "lead").select("task_id", "through_flag")


@query("fst_through_flag", "SELECT task_id, CASE WHEN EXISTS (SELECT 1 FROM numbered_calls n WHERE n.task_id = l.task_id "
       "AND callnum = 1 AND start_time = (SELECT min(start_time) FROM connected_calls c WHERE c.task_id = l.task_id "
       "AND team_name <> 'Customer Service Team')) THEN 1 ELSE 0 END AS fst_through_flag FROM leads0 l")
def fst_through_flag(spark, sf):
    leads = ft.one_row_per_task(ft.campaign_tasks(role(spark, sf, "crm_task"), SPAN))
    return ft.call_flags(leads, role(spark, sf, "call_record"), SPAN, "reference").select("task_id", "fst_through_flag")


@query("channel_type_initial", "SELECT clue_id, channel, CASE WHEN regexp_full_match(channel, 'feed|sem|qywx|dy|DY') THEN 'Ads' "
       "WHEN regexp_full_match(channel, 'huzhusq|SQ.*|lesson.*|sdbsqnew|lujiekz') THEN 'Community' ELSE 'Normal' END AS channel_type FROM clue")
def channel_type_initial(spark, sf):
    kind = category_map("channel", fx.CHANNEL_TYPE_INITIAL, fx.CHANNEL_TYPE_INITIAL_ELSE)
    return role(spark, sf, "clue").select("clue_id", "channel", kind.alias("channel_type"))


@query("app_start_flag", "SELECT l.user_id, max(CASE WHEN a.user_id IS NOT NULL THEN 1 ELSE 0 END) AS sdb_app_start_flag FROM "
       "user_ua l LEFT JOIN app_tag a ON a.user_id = l.user_id GROUP BY l.user_id")
def app_start_flag(spark, sf):
    starts = role(spark, sf, "app_tag").groupBy("user_id").agg(F.max("last_appstart_op_time").alias("last_start"))
    users = role(spark, sf, "user_ua").select("user_id").join(starts, "user_id", "left")
    return users.select("user_id", F.col("last_start").isNotNull().cast("int").alias("sdb_app_start_flag"))


@query("product_page_views", "SELECT user_id, operation_time, produ_no FROM page_views")
def product_page_views(spark, sf):
    return ft.product_page_views(role(spark, sf, "user_action"), SPAN)


# ---------------------------------------------------------------- windows and scalar functions
@query("call_sequence", "SELECT call_id, mobile, start_time, row_number() OVER (PARTITION BY mobile ORDER BY start_time, call_id) "
       "AS callnum FROM call_record")
def call_sequence(spark, sf):
    calls = role(spark, sf, "call_record").select("call_id", "mobile", "start_time")
    return number_rows_by(calls, "mobile", ["start_time", "call_id"], "callnum")


@query("latest_order_channel", f"SELECT user_id, channel, {oc.channel_group('channel')} AS channel_group FROM gift "
       "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY create_time DESC, id DESC) = 1")
def latest_order_channel(spark, sf):
    latest = tp.latest_by(ft.gift_orders(role(spark, sf, "ins_order")), "user_id", ["create_time", "id"], ["channel"])
    return latest.select("user_id", "channel", ft.channel_maps("channel")["channel_group"].alias("channel_group"))


@query("channel_group_final", f"SELECT id, channel, {oc.channel_type('channel')} AS channel_type, "
       f"{oc.channel_group('channel')} AS channel_group FROM gift")
def channel_group_final(spark, sf):
    return ft.gift_orders(role(spark, sf, "ins_order")).select("id", "channel", *[c.alias(n) for n, c in ft.channel_maps("channel").items()])


@query("recency_days", "SELECT user_id, {} FROM user_tag".format(", ".join(
    f"{oc.gap(chr(39) + oc.AS_OF + chr(39), c)} AS {n}" for c, n in fx.TAG_TIMES.items())))
def recency_days(spark, sf):
    return role(spark, sf, "user_tag").select(
        "user_id", *[days_between(F.lit(oc.AS_OF), c).alias(n) for c, n in fx.TAG_TIMES.items()])


@query("url_last_segment", "SELECT user_id, operation_time, current_original_path, CASE WHEN contains(current_original_path, '/') "
       "THEN string_split(current_original_path, '/')[-1] ELSE '' END AS produ_no FROM user_action")
def url_last_segment(spark, sf):
    return role(spark, sf, "user_action").select(
        "user_id", "operation_time", "current_original_path", url_tail("current_original_path").alias("produ_no"))


@query("tier_cross", f"SELECT user_id, {oc.tier('id_city_name')} || {oc.tier('wx_city')} AS id_wx_class_concat, "
       f"{oc.tier('id_city_name')} || {oc.tier('most_visit_city')} AS id_mostvisit_class_concat FROM user_tag")
def tier_cross(spark, sf):
    rows = ft.tag_features(role(spark, sf, "user_tag"), TIERS).withColumns(ft.mobility_columns())
    return rows.select("user_id", "id_wx_class_concat", "id_mostvisit_class_concat")


@query("city_up_flags", "SELECT user_id, {} FROM (SELECT user_id, {}, {}, {} FROM user_tag)".format(
    ", ".join([oc.moved("home", "often", "unknown") + " AS id_mostvisit_city_up_flag", oc.moved("home", "wx", "unknown") + " AS id_wx_city_up_flag"]),
    oc.tier("id_city_name") + " AS home", oc.tier("most_visit_city") + " AS often", oc.tier("wx_city") + " AS wx"))
def city_up_flags(spark, sf):
    rows = ft.tag_features(role(spark, sf, "user_tag"), TIERS).withColumns(ft.mobility_columns())
    return rows.select("user_id", "id_mostvisit_city_up_flag", "id_wx_city_up_flag")


@query("operator_map", f"SELECT user_id, {oc._OPERATOR} AS mobile_operator FROM user_tag")
def operator_map(spark, sf):
    return role(spark, sf, "user_tag").select("user_id", ft.operator_map().alias("mobile_operator"))


@query("safe_casts", "SELECT task_id, target_user_id, try_cast(target_user_id AS BIGINT) AS user_id, try_cast(target_user_mobile AS DATE) "
       "AS not_a_day, CAST(create_time AS DATE) AS alloc_date FROM crm_task")
def safe_casts(spark, sf):
    return role(spark, sf, "crm_task").select(
        "task_id", "target_user_id", to_long("target_user_id").alias("user_id"), to_day("target_user_mobile").alias("not_a_day"),
        to_day("create_time").alias("alloc_date"))


@query("null_fill_features", "SELECT user_id, {} FROM user_tag t".format(", ".join([oc._TAG_KEPT, oc._TAG_ZERO, oc._TAG_FLAG])))
def null_fill_features(spark, sf):
    rows = role(spark, sf, "user_tag").select("user_id", *fx.KEEP_NULL_TAGS, *fx.ZERO_FILL_TAGS, *fx.FLAG_FILL_TAGS)
    return ft.fill_nulls(rows, ft.ZERO_FILL, fx.FLAG_FILL_TAGS)
