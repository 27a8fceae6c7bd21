"""Queries on the feature stages and the final feature tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from leadwright.operators import temporal as tp
from leadwright.operators.history import valid_and_last
from leadwright.plans import features as ft
from leadwright.plans import oracle as oc
from leadwright.plans.registry import SPAN, TIERS, event_stage, feature_stage, lead_stage, query, role, sources
from leadwright.plans.runs import run_stages
from leadwright.session import materialise, shared_dir
from leadwright.sources import roles
from leadwright.sources.snapshots import Catalogue, copies_read

_LEAD_OUT = ["task_id", *ft.LEAD_COLUMNS, "through_flag", "fst_through_flag", "t7_policy_flag", "t14_policy_flag",
             "t7_policy_cnt", "t14_policy_cnt", "t7_origin", "t14_origin", "channel_type", "channel", "subchannel"]


@query("stage_lead_base", f"SELECT {', '.join(_LEAD_OUT)} FROM base_leads")
def stage_lead_base(spark, sf):
    rows = ft.lead_base(sources(spark, sf), SPAN)
    rounded = {c: F.round(c, 4) for c in ("t7_origin", "t14_origin")}
    return rows.withColumns(rounded).select(*_LEAD_OUT)


_CLASSES = list(ft.fx.CITY_COLUMNS.values())
_RAW_TAGS = [*ft.fx.KEEP_NULL_TAGS, "mobile_operator", *ft.fx.ZERO_FILL_TAGS, *ft.fx.FLAG_FILL_TAGS]
_LEAD_REST = [c for c in _LEAD_OUT if c != "task_id"]
_BASE_OUT = [*_LEAD_REST, *_RAW_TAGS, *_CLASSES, *ft.fx.TAG_TIMES.values(), *ft.FOLLOW_TAGS.values()]
_BASE_JOIN = ("base_leads l JOIN lead_tags g USING (task_id) JOIN follow f USING (task_id) JOIN lead_share USING (task_id) "
              "JOIN lead_app USING (task_id) LEFT JOIN user_tag t ON t.user_id = l.user_id")
# Filled only at the end, so NULLs still show here.
_BASE_SQL = ", ".join([f"l.{c}" for c in _LEAD_REST] + [f"t.{c}" for c in _RAW_TAGS]
                      + [f"g.{c}" for c in [*_CLASSES, *ft.fx.TAG_TIMES.values()]]
                      + [f"f.{c}" for c in ft.FOLLOW_TAGS.values()]
                      + ["share_cnt", f"{oc.gap('l.alloc_date', 'last_share')} AS datediff_lastshare",
                         "CASE WHEN app_start IS NOT NULL THEN 1 ELSE 0 END AS sdb_app_start_flag"])
_SHARE_OUT = ["share_cnt", "datediff_lastshare", "sdb_app_start_flag"]


def _with_base(spark, sf, groups):
    src = sources(spark, sf)
    leads = lead_stage(spark, sf).withColumns({c: F.round(c, 4) for c in ("t7_origin", "t14_origin")}).select(*_LEAD_OUT)
    rows = ft.add_point_in_time(leads, src, SPAN, groups)
    if "shares" in groups:
        rows = ft.add_follow_tags(ft.add_tags(rows, src["user_tag"], TIERS), src["wx_detail"], SPAN)
        rows = rows.withColumn("share_cnt", F.coalesce("share_cnt", F.lit(0)))
    if "cf" in groups:
        rows = ft.add_user_agent(rows, src["user_ua"])
    if "orders" in groups:
        rows = rows.withColumns({"cnt": F.coalesce("cnt", F.lit(0)), "money": F.round("money", 4), "origin": F.round("origin", 4)})
    return rows


@query("stage_base_features", f"SELECT l.task_id, {_BASE_SQL} FROM {_BASE_JOIN}")
def stage_base_features(spark, sf):
    return _with_base(spark, sf, ["shares", "app"]).select("task_id", *_BASE_OUT, *_SHARE_OUT)


def _visit_columns(gs):
    return [c for g in gs for c in [*[f"{f}_{g}" for f in ft.VISIT_FIELDS], *ft.VISITS[g][1],
                                    f"datediff_first_visit_{g}", f"datediff_last_visit_{g}"]]


_BEHAVIOR_OUT = ["ua", "device_type", *_visit_columns(["cf", "hz"]), "cnt", "money", "origin"]
_BEHAVIOR_JOIN = ("JOIN lead_visits v USING (task_id) JOIN lead_orders o USING (task_id) LEFT JOIN user_ua u ON u.user_id = l.user_id")


@query("stage_behavior_features", f"SELECT l.task_id, {', '.join(_BEHAVIOR_OUT)} FROM leads0 l {_BEHAVIOR_JOIN}")
def stage_behavior_features(spark, sf):
    return _with_base(spark, sf, ["cf", "hz", "orders"]).select("task_id", *_BEHAVIOR_OUT)


@query("merge_base_behavior", f"SELECT l.task_id, {_BASE_SQL}, {', '.join(_BEHAVIOR_OUT)} FROM {_BASE_JOIN} {_BEHAVIOR_JOIN}")
def merge_base_behavior(spark, sf):
    """Base and behaviour features of a lead come from one timeline, so there is nothing to join on the user."""
    rows = _with_base(spark, sf, ["shares", "app", "cf", "hz", "orders"])
    return rows.select("task_id", *_BASE_OUT, *_SHARE_OUT, *_BEHAVIOR_OUT)


_VIEW_OUT = ["datediff_first_oper_short", "datediff_last_oper_short", "total_visit_cnt_short", "last_week_visit_cnt_short", "product_cnt_short"]
_LOG_OUT = [*_VIEW_OUT, *_visit_columns(["bao"]), "gift_insurance_cnt"]
_VIEW_SQL = (f"{oc.gap('l.alloc_date', 'first_view')} AS datediff_first_oper_short, {oc.gap('l.alloc_date', 'last_view')} AS "
             "datediff_last_oper_short, total_visit_cnt_short, last_week_visit_cnt_short, product_cnt_short")


@query("shortview_features", f"SELECT l.task_id, {_VIEW_SQL} FROM leads0 l JOIN lead_views w USING (task_id)")
def shortview_features(spark, sf):
    return _with_base(spark, sf, ["views"]).select("task_id", *_VIEW_OUT)


@query("stage_append_logs", f"SELECT l.task_id, {_BASE_SQL}, {', '.join(_BEHAVIOR_OUT)}, {_VIEW_SQL}, "
       f"{', '.join(_visit_columns(['bao']))}, gift_insurance_cnt FROM {_BASE_JOIN} JOIN lead_views w USING (task_id) {_BEHAVIOR_JOIN}")
def stage_append_logs(spark, sf):
    rows = _with_base(spark, sf, ["shares", "app", "cf", "hz", "orders", "views", "bao", "gifts"])
    return rows.select("task_id", *_BASE_OUT, *_SHARE_OUT, *_BEHAVIOR_OUT, *_LOG_OUT)


@query("gift_order_count", "SELECT task_id, gift_insurance_cnt FROM lead_orders")
def gift_order_count(spark, sf):
    return _with_base(spark, sf, ["gifts"]).select("task_id", "gift_insurance_cnt")


@query("final_feature_table", f"SELECT {', '.join(ft.FINAL_COLUMNS)}, alloc_time, last_visit_time FROM features")
def final_feature_table(spark, sf):
    """The whole feature build in one plan, from the source roles to one row per lead."""
    return ft.feature_table(sources(spark, sf), SPAN, TIERS)


@query("final_feature_table_reference", f"SELECT {', '.join(ft.FINAL_COLUMNS)} FROM features_reference")
def final_feature_table_reference(spark, sf):
    return ft.feature_table_reference(sources(spark, sf), SPAN, TIERS)


_AUDITED = {**{f"last_visit_{g}": f"last_visit_time_{g}" for g in ft.VISITS}, "last_view": "last_view", "last_order": "last_order",
            "last_gift": "last_gift", "last_share": "last_share", "last_app_start": "app_start"}
_AUDIT_ORDERS = {"lead_order_times": """SELECT l.task_id, max(o.create_time) AS last_order,
  max(o.create_time) FILTER (WHERE o.order_type = 1 AND o.policy_no <> '') AS last_gift
  FROM leads0 l LEFT JOIN ins_order o ON o.user_id = l.user_id AND o.create_time < l.alloc_time GROUP BY l.task_id"""}


@query("leakage_audit", " UNION ALL ".join(
    f"SELECT '{n}' AS feature, count({c}) AS n_events, count(*) FILTER (WHERE {c} >= alloc_time) AS n_leaks FROM leads0 JOIN lead_visits USING (task_id) "
    "JOIN lead_views USING (task_id) JOIN lead_share USING (task_id) JOIN lead_app USING (task_id) JOIN lead_order_times USING (task_id)"
    for n, c in _AUDITED.items()), _AUDIT_ORDERS)
def leakage_audit(spark, sf):
    """The newest event behind every timed feature, against the allocation."""
    src = sources(spark, sf)
    leads = ft.add_point_in_time(lead_stage(spark, sf).select("task_id", *ft.LEAD_COLUMNS), src, SPAN, list(ft.VISITS))
    views = ft.page_view_rows(src["user_action"], SPAN)
    logs = [(views, "operation_time", {"last_view": F.col("operation_time")}),
            (src["ins_order"], "create_time", {"last_order": F.col("create_time"), "last_gift": F.when(ft.is_gift_order(), F.col("create_time"))}),
            (src["share_action"], "time", {"last_share": F.col("time")}),
            (src["app_tag"], "last_appstart_op_time", {"app_start": F.col("last_appstart_op_time")})]
    known = tp.point_in_time(leads, "user_id", "alloc_time", [
        tp.Source(df, ts, {n: ("max", c) for n, c in newest.items()}) for df, ts, newest in logs])
    return ft.leakage_audit(leads.join(known, ["user_id", "alloc_time"], "left"), _AUDITED)


@query("leakage_audit_reference", """SELECT 'last_visit_cf' AS feature, count(*) AS n_events,
       count(*) FILTER (WHERE h.newest >= l.alloc_time) AS n_leaks FROM leads0 l JOIN (SELECT l.user_id, max(h.last_visit_time) AS newest
       FROM lead_tasks l JOIN visit_cf h ON h.user_id = l.user_id AND h.last_visit_time < l.alloc_time GROUP BY l.user_id) h
       ON h.user_id = l.user_id""")
def leakage_audit_reference(spark, sf):
    """The original join on the user alone shows a lead the visits before the user's later allocations."""
    leads = lead_stage(spark, sf).select("task_id", *ft.LEAD_COLUMNS)
    newest = tp.point_in_time(leads, "user_id", "alloc_time", [
        tp.Source(role(spark, sf, "visit_cf"), "last_visit_time", {"seen": ("max", F.col("last_visit_time"))})])
    by_user = newest.groupBy("user_id").agg(F.max("seen").alias("seen"))
    return ft.leakage_audit(leads.join(by_user, "user_id"), {"last_visit_cf": "seen"})


@query("mature_leads", f"SELECT task_id, alloc_date FROM leads0 WHERE date_diff('day', alloc_date, DATE '{oc.AS_OF}') >= 14")
def mature_leads(spark, sf):
    return ft.mature(lead_stage(spark, sf), oc.AS_OF).select("task_id", "alloc_date")


@query("training_window", "SELECT task_id, alloc_date, t14_policy_flag FROM leads0 JOIN lead_labels USING (task_id) WHERE alloc_date "
       "BETWEEN DATE '2024-04-20' - INTERVAL 3 MONTH AND DATE '2024-04-20' - 14")
def training_window(spark, sf):
    rows = ft.training_window(lead_stage(spark, sf), "2024-04-20", 3)
    return rows.select("task_id", "alloc_date", "t14_policy_flag")


@query("features_scan", f"SELECT {', '.join(ft.FINAL_COLUMNS)} FROM features")
def features_scan(spark, sf):
    """The feature table read from its stage table, as training and scoring read it."""
    return feature_stage(spark, sf).select(*ft.FINAL_COLUMNS)


# ---------------------------------------------------------------- from a store of stamped tables
_RUN_DATE = oc.AS_OF
_TAKEN = {r: "2024-01-30" for r in roles.copied_roles()} | {"clue": "2024-01-29"}  # the newest copy of clue is a day late
_FROM_COPIES = {r: roles.duck_copy(r, stamp) for r, stamp in _TAKEN.items()} | {
    r: f"SELECT * FROM ({roles.duck_role(r)}) i WHERE dt BETWEEN DATE '{oc.SINCE}' AND DATE '{oc.SNAPSHOT}'" for r in roles.INCREMENT_ROLES}


def store_of(spark, sf):
    """The given tables as a store of stamped copies, written once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        _STORES[key] = roles.write_store(spark, sf, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", event_stage(spark, sf))
    return Catalogue(_STORES[key], ft.source_rules(SPAN))


_STORES: dict[tuple[str, str], dict[str, str]] = {}


@query("final_feature_table_stamped", f"SELECT {', '.join(ft.FINAL_COLUMNS)}, alloc_time, last_visit_time FROM features", _FROM_COPIES)
def final_feature_table_stamped(spark, sf):
    """The feature build of one run date from a store in which every table has several copies."""
    return ft.feature_table_of(spark, store_of(spark, sf), SPAN, _RUN_DATE, TIERS)


@query("snapshot_copies", " UNION ALL ".join(
    [f"SELECT '{r}' AS role, DATE '{stamp}' AS stamp, count(*) AS rows FROM {r} HAVING count(*) > 0" for r, stamp in _TAKEN.items()]
    + [f"SELECT '{r}' AS role, dt AS stamp, count(*) AS rows FROM {r} GROUP BY dt" for r in roles.INCREMENT_ROLES]), _FROM_COPIES)
def snapshot_copies(spark, sf):
    """Which copy of each role the run reads, and how many rows it holds."""
    catalogue = store_of(spark, sf)
    return copies_read(catalogue.open(spark, _RUN_DATE), catalogue.resolve(spark, _RUN_DATE))


@query("pipeline_features", f"SELECT {', '.join(ft.FINAL_COLUMNS)}, alloc_time, last_visit_time FROM features", _FROM_COPIES)
def pipeline_features(spark, sf):
    """The build as a restartable run of stages; stages that a broken run has finished are not built again."""
    catalogue = store_of(spark, sf)
    folder = f"{shared_dir(spark)}/run-{_RUN_DATE}-{os.path.basename(sf.rstrip('/'))}"
    done = run_stages(spark, folder, ft.feature_stages(SPAN, TIERS), catalogue.open(spark, _RUN_DATE), {"run_date": _RUN_DATE})
    return done["features"]


# ---------------------------------------------------------------- histories with validity intervals
_VERSION = ["last_visit_time", "visit_cnt", "visit_case_cnt"]
# One version in seven is still open.
_OPEN = {"versions": "SELECT *, CASE WHEN visit_cnt % 7 = 0 THEN NULL ELSE dw_end_date END AS open_end FROM visit_cf"}
_VALID = ("SELECT * FROM versions h WHERE h.user_id = l.user_id AND h.dw_start_date <= l.alloc_date AND coalesce(h.open_end, DATE '9999-12-31') >= "
          "l.alloc_date ORDER BY dw_start_date DESC, last_visit_time DESC, visit_cnt DESC, visit_case_cnt DESC LIMIT 1")
_LAST = ("SELECT * FROM versions h WHERE h.user_id = l.user_id AND h.last_visit_time < l.alloc_time "
         "ORDER BY last_visit_time DESC, visit_cnt DESC, visit_case_cnt DESC LIMIT 1")


@query("visit_versions", f"""SELECT l.task_id, l.user_id, l.alloc_time, {', '.join(f'v.{c} AS valid_{c}' for c in _VERSION)},
       {', '.join(f'e.{c} AS last_{c}' for c in _VERSION)} FROM leads0 l LEFT JOIN LATERAL ({_VALID}) v ON true LEFT JOIN LATERAL ({_LAST}) e ON true""", _OPEN)
def visit_versions(spark, sf):
    """Per lead the version of the visit history valid on the allocation day, and the last visit before the allocation."""
    leads = lead_stage(spark, sf).select("task_id", "user_id", "alloc_time")
    history = role(spark, sf, "visit_cf").withColumn("open_end", F.expr("CASE WHEN visit_cnt % 7 = 0 THEN NULL ELSE dw_end_date END"))
    return valid_and_last(leads, history, "user_id", "alloc_time", "last_visit_time", "dw_start_date", "open_end", _VERSION)


# ---------------------------------------------------------------- audit by perturbation
_AUDIT_COLUMNS = [c for c in ft.FINAL_COLUMNS if c not in ("user_id", "task_id", "t14_policy_flag")]
_FIRST = {"first_leads": """SELECT user_id, task_id, alloc_time AS cut FROM leads0 WHERE user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY alloc_time, task_id) = 1"""}
_CUT_ROLES = {r: f"SELECT r.* FROM {r} r LEFT JOIN first_leads c ON c.user_id = r.user_id WHERE c.cut IS NULL OR r.{ts} IS NULL OR r.{ts} < "
              + ("CAST(c.cut AS DATE)" if r == "wx_detail" else "c.cut") for r, ts in ft.EVENT_TIMES.items()}


def _changed_sql(build: str, table: str) -> str:
    cells = ", ".join(f"{{'feature': '{c}', 'changed': count(*) FILTER (WHERE a.{c} IS DISTINCT FROM b.{c})}}" for c in _AUDIT_COLUMNS)
    return (f"SELECT '{build}' AS build, c.feature AS feature, rows, c.changed AS changed FROM (SELECT rows, unnest(cells) AS c FROM ("
            f"SELECT count(*) AS rows, [{cells}] AS cells FROM {table} a JOIN {table}_cut b USING (user_id, task_id) JOIN first_leads USING (user_id, task_id)))")


@query("leakage_perturbation", f"{_changed_sql('lead', 'features')} UNION ALL {_changed_sql('user_level', 'features_reference')}",
       {**_FIRST, **oc.variant("features", _CUT_ROLES, "_cut"), **oc.variant("features_reference", _CUT_ROLES, "_cut")})
def leakage_perturbation(spark, sf):
    """Per feature the first leads whose value changes when everything from their allocation on is taken away, for both builds."""
    src = sources(spark, sf)
    leads = lead_stage(spark, sf).where(F.col("user_id").isNotNull())
    first = materialise(tp.first_by(leads, "user_id", ["alloc_time", "task_id"], ["task_id", "alloc_time"]).withColumnRenamed("alloc_time", "cut"), "first-leads")
    builds = {"lead": lambda s: ft.feature_table(s, SPAN, TIERS, lead_stage(spark, sf)), "user_level": lambda s: ft.feature_table_reference(s, SPAN, TIERS)}
    found = [ft.leakage_by_perturbation(src, build, first, _AUDIT_COLUMNS).select(F.lit(name).alias("build"), "feature", "rows", "changed")
             for name, build in builds.items()]
    return found[0].unionByName(found[1])
