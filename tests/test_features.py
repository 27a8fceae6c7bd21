"""Column functions, leakage, and the user-level results against written-out joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadwright.functions import columns as cl
from leadwright.functions import fixed_values as fx
from leadwright.plans import catalog
from leadwright.plans import features as ft
from leadwright.plans import registry as rg
from leadwright.sources import roles


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("v")).first().v


@pytest.mark.parametrize("value,want", [("/x/abc", "abc"), ("abc", ""), ("/x/", ""), ("", ""), (None, None)])
def test_url_tail(spark, value, want):
    assert one(spark, value, cl.url_tail("c")) == want


@pytest.mark.parametrize("value,want", [("北京市", "Tier_1"), ("杭州", "New_Tier_1"), ("昆明", "others"), (None, "unknown")])
def test_city_class(spark, value, want):
    assert one(spark, value, cl.city_class("c", fx.ID_CITY_TIERS)) == want


@pytest.mark.parametrize("value,kind,group", [
    ("feed", "Ads", "feed"), ("x_BD_1", "Ads", "BD"), ("sem", "Ads", "others"), ("myapp", "Internal", "sdbao"),
    ("sdbao", "Internal", "sdbao"), ("cf", "Internal", "cf"), ("qywx", "Community", "qywx"), (None, "Others", "others")])
def test_channel_maps(spark, value, kind, group):
    maps = ft.channel_maps("c")
    assert (one(spark, value, maps["channel_type"]), one(spark, value, maps["channel_group"])) == (kind, group)


def test_bad_ids_and_dates_become_null(spark):
    assert one(spark, "abc", cl.to_long("c")) is None and one(spark, "12", cl.to_long("c")) == 12
    assert one(spark, "xx", cl.to_day("c")) is None and one(spark, "2024-01-02 03:04:05", cl.to_day("c")) == dt.date(2024, 1, 2)


def test_moved_up(spark):
    df = spark.createDataFrame([("others", "Tier_1"), ("Tier_1", "Tier_1"), ("unknown", "Tier_1"), (None, None), ("Tier_2", "others")], "a string, b string")
    assert [r.v for r in df.select(cl.moved_up("a", "b").alias("v")).collect()] == ["1", "0", "unknown", "0", "0"]


def test_no_leak_in_the_feature_build_and_leaks_in_the_original(spark, small):
    assert all(r.n_leaks == 0 and r.n_events > 0 for r in catalog.QUERIES["leakage_audit"](spark, small).collect())
    assert catalog.QUERIES["leakage_audit_reference"](spark, small).first().n_leaks > 0


def test_one_row_per_lead(spark, small):
    table = rg.feature_stage(spark, small)
    assert table.count() == table.select("task_id").distinct().count()


def test_user_level_results_equal_the_written_out_joins(spark, small):
    """The original joins all of a user's leads with all of their as-of rows and takes maxima; here in full."""
    src = roles.load_roles(spark, small)
    leads = ft.campaign_tasks(src["crm_task"], rg.SPAN).distinct().alias("l")
    history = src["visit_hz"].alias("h")
    newest = leads.join(history, (F.col("l.user_id") == F.col("h.user_id")) & (F.col("h.last_visit_time") < F.col("l.alloc_time"))).groupBy(
        F.col("l.user_id").alias("u"), F.col("l.alloc_time").alias("a")).agg(F.max("h.last_visit_time").alias("newest"))
    rows = newest.join(history, (F.col("u") == F.col("h.user_id")) & (F.col("newest") == F.col("h.last_visit_time"))).select(
        "u", "first_visit_time", "visit_payment_cnt", "visit_event_cnt", "visit_cnt")
    naive = leads.join(rows, F.col("l.user_id") == F.col("u")).groupBy("u").agg(
        F.max("visit_payment_cnt").alias("pay"), F.max("visit_event_cnt").alias("ev"), F.max("visit_cnt").alias("cnt"),
        F.max(F.datediff("alloc_date", F.to_date("first_visit_time"))).alias("first"))
    want = {r.u: (r.pay, r.ev, r.cnt, r.first) for r in naive.collect()}
    table = ft.feature_table_reference(src, rg.SPAN, rg.TIERS).where(F.col("user_id").isNotNull())
    got = {r.user_id: (r.visit_payment_cnt, r.visit_event_cnt, r.visit_cnt_hz, r.datediff_first_visit_hz) for r in table.collect()}
    assert want and all(got[u] == v for u, v in want.items())


def test_perturbation_finds_leaks_that_no_time_shows(spark, small):
    """The lead build does not move; a build that counts a user's visits at any time is named."""
    src = roles.load_roles(spark, small)
    leads = ft.lead_base(src, rg.SPAN)
    first = leads.where("user_id IS NOT NULL").groupBy("user_id").agg(F.min(F.struct("alloc_time", "task_id")).alias("x")).select(
        "user_id", "x.task_id", F.col("x.alloc_time").alias("cut"))

    def leaky(s):
        visits = s["visit_cf"].groupBy("user_id").agg(F.count(F.lit(1)).alias("visits"))
        views = s["user_action"].join(leads.select("user_id", "alloc_time"), "user_id").where("operation_time < alloc_time").groupBy("user_id").agg(
            F.count(F.lit(1)).alias("views"))
        return leads.select("user_id", "task_id", "agent_type").join(visits, "user_id", "left").join(views, "user_id", "left")

    found = {r["feature"]: (r["rows"], r["changed"]) for r in ft.leakage_by_perturbation(src, leaky, first, ["agent_type", "visits", "views"]).collect()}
    assert found["agent_type"] == (first.count(), 0) and found["visits"][1] > 0 and found["views"][1] > 0


def test_timeline_and_totals_share_one_shuffle(spark, small):
    """The running values and the day totals read the same shuffled rows, also where a second moment is asked for."""
    table = ft.add_point_in_time(rg.lead_stage(spark, small), rg.sources(spark, small), rg.SPAN, ft.FINAL_GROUPS)
    exchanges, todo = [], [table._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "REPARTITION_BY_COL" in node.simpleString(50):
            exchanges.append(node)
    assert len(exchanges) == 2 and exchanges[0].sameResult(exchanges[1])


def test_only_asked_users_are_matched_against_the_tiers(spark, small):
    users = spark.createDataFrame([(1,), (2,), (2,)], "user_id bigint")
    leads = users.select("user_id", F.lit("2024-01-20").cast("date").alias("alloc_date"))
    tag = roles.role(spark, small, "user_tag")
    found = ft.add_tags(leads, tag, rg.TIERS, leads)
    assert "LeftSemi" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.collect(), key=str) == sorted(ft.add_tags(leads, tag, rg.TIERS).collect(), key=str)
