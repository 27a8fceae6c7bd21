"""Deployed points on hand-made rows, compiled rules, generation, ranking, reasons."""

import math

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators import scorecard as sc
from leadwright.operators import woe as wo
from leadwright.operators.model import INTERCEPT
from leadwright.sources import tables

SCHEMA = ("id int, wx_city_class string, channel_group string, id_age int, hz_total_bal_amt double, "
          "total_visit_cnt_short int, sdb_app_start_flag int")
GOLDEN = {
    "id_age": ([None, 17, 18, 23, 24, 30, 31, 40, 41, 49, 50], [-97, 12, 13, 13, -9, -9, -1, -1, 3, 3, 0]),
    "hz_total_bal_amt": ([None, 0.5, 1.0, 3.9, 4.0], [0, -1, -1, -1, 8]),
    "total_visit_cnt_short": ([None, 0, 1, 2, 3], [0, -5, -8, 4, 20]),
    "sdb_app_start_flag": ([None, 0, 1], [0, -1, 55]),
    "wx_city_class": (["New_Tier_1", "Tier_1", "Tier_2", "Tier_3", "Tier_4", "Tier_5", "others", "unknown", None],
                      [36, 27, 25, 30, 36, 51, 34, -81, 0]),
    "channel_group": (["sdbao", "sdhz", "cf", "feed", "BD", "others", "qywx", None], [32, 24, -8, 1, -19, -13, 156, 0]),
}


def frame(spark, variable=None, values=(None,)):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    rows = [tuple(i if n == "id" else (v if n == variable else None) for n in names) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("variable", GOLDEN)
def test_deployed_points(spark, variable):
    values, points = GOLDEN[variable]
    scored = sc.score(frame(spark, variable, values), sc.deployed_rules(spark), fx.BASE_POINTS)
    assert [r[f"{variable}_score"] for r in scored.orderBy("id").collect()] == points


def test_base_points_alone(spark):
    row = sc.score(frame(spark).withColumn("id_age", F.lit(50)), sc.deployed_rules(spark), fx.BASE_POINTS).first()
    assert row.total_score == 327


@pytest.mark.parametrize("variable", GOLDEN)
def test_join_and_sql_text_equal_the_compiled_rules(spark, variable):
    df, rules = frame(spark, variable, GOLDEN[variable][0]), sc.deployed_rules(spark)
    compiled = {r.id: r.total_score for r in sc.score(df, rules, fx.BASE_POINTS).collect()}
    joined = {r.id: r.total_score for r in sc.score_by_join(df, rules, ["id"], fx.BASE_POINTS).collect()}
    text = " + ".join(f"({s})" for s in sc.rules_sql(rules).values())
    by_text = {r.id: r.t for r in df.selectExpr("id", f"{text} + {fx.BASE_POINTS} AS t").collect()}
    assert compiled == joined == by_text


def test_scoring_does_not_shuffle(spark):
    text = plan_text(sc.score(frame(spark), sc.deployed_rules(spark), fx.BASE_POINTS))
    assert "Exchange" not in text and "Join" not in text


def test_limits_keep_all_their_digits(spark, tmp_path):
    """Neighbouring limits of more than six digits: text, columns and the table read back give the same scores."""
    rules = sc.rules_frame(spark, sc.rules_from_points({
        "x": {(None, 1234567): 1, (1234567, 1234569): 2, (1234569, None): 4, "missing": 8}, "c": {"a|b": 16, 'quote" and, comma': 32}}))
    assert rules.select("bin").distinct().count() == 6
    df = spark.createDataFrame([(1234566.9, "a|b"), (1234567.0, "a"), (1234568.99, 'quote" and, comma'), (1234569.0, None), (None, "b")], "x double, c string")
    want = [17, 2, 34, 4, 8]
    text = " + ".join(f"({s})" for s in sc.rules_sql(rules).values())
    assert [r.t for r in df.selectExpr(f"{text} AS t").collect()] == want
    assert [r.total_score for r in sc.score(df, rules, 0).collect()] == want
    back = tables.import_rules(spark, tables.export_rules(rules, str(tmp_path / "exact")))
    assert [r.total_score for r in sc.score(df, back, 0).collect()] == want


def test_rule_table_round_trip(spark, tmp_path):
    rules = sc.deployed_rules(spark)
    back = tables.import_rules(spark, tables.export_rules(rules, str(tmp_path / "rules")))
    key = ["variable", "bin", "kind", "lo", "hi", "points"]
    assert sorted(map(str, rules.select(*key, "categories").collect())) == sorted(map(str, back.select(*key, "categories").collect()))


@pytest.mark.parametrize("direction,base", [(1, 600 + 50 / math.log(2) * (-6.73 - math.log(1 / 19))), (-1, 600 - 50 / math.log(2) * (-6.73 - math.log(1 / 19)))])
def test_points_follow_the_scale(spark, direction, base):
    bins = wo.woe_table(wo.bin_counts(
        spark.createDataFrame([(1, 0), (1, 1), (5, 0), (5, 0), (5, 1)], "x int, y int"), wo.bins_from_breaks({"x": [3]}), "y"))
    coefs = spark.createDataFrame([(INTERCEPT, -6.73), ("x_woe", 0.5)], "feature string, coefficient double")
    rules = {(r.variable, r.bin): r.points for r in sc.scorecard(bins, coefs, direction=direction).collect()}
    assert rules["basepoints", None] == round(base)
    low = math.log((1 / 2) / (1 / 3))
    assert rules["x", "[-inf,3)"] == round(direction * 50 / math.log(2) * 0.5 * low)


def test_generated_rules_score_through_the_compiler(spark):
    df = spark.createDataFrame([(1, 0), (None, 1), (5, 0), (5, 0), (5, 1), (1, 1)], "x int, y int")
    bins = wo.woe_table(wo.bin_counts(df, wo.bins_from_breaks({"x": [3]}), "y"))
    coefs = spark.createDataFrame([(INTERCEPT, -3.0), ("x_woe", 1.0)], "feature string, coefficient double")
    rules = sc.scorecard(bins, coefs)
    points = {(r.variable, r.bin): r.points for r in rules.collect()}
    got = {r.x: r.total_score for r in sc.score(df, rules).collect()}
    assert got == {1: points["x", "[-inf,3)"] + points["basepoints", None], 5: points["x", "[3,inf)"] + points["basepoints", None],
                   None: points["x", "missing"] + points["basepoints", None]}


def test_rank_ties_and_top_share(spark):
    rows = [(1, 10, 5), (2, 10, 9), (3, 10, None), (4, 30, 1), (5, 10, 9), (6, 20, 2), (7, 1, 1)]
    df = spark.createDataFrame(rows, "user_id int, total_score int, seen int")
    ranked = sc.rank_leads(df, recency="seen")
    assert [r.user_id for r in ranked.orderBy("lead_rank").collect()] == [4, 6, 2, 5, 1, 3, 7]
    assert sorted(r.user_id for r in sc.top_fraction(ranked, 0.3).collect()) == [2, 4, 6]


def test_reasons_are_the_largest_parts(spark):
    scored = sc.score(frame(spark).withColumns({"wx_city_class": F.lit("Tier_5"), "channel_group": F.lit("qywx")}), sc.deployed_rules(spark), 327)
    reasons = sc.score_reasons(scored, list(fx.DEPLOYED_POINTS), ["id"], 2)
    assert [(r.reason, r.variable, r.points) for r in reasons.orderBy("reason").collect()] == [(1, "channel_group", 156), (2, "id_age", -97)]
    assert "Exchange" not in plan_text(sc.score_reasons(scored, list(fx.DEPLOYED_POINTS), ["id"], 2))


def test_lookup_join_with_thousands_of_rules(spark):
    """5,000 rules a variable: the same points as trying the rules one by one, by joins for equality alone."""
    import bisect
    import random

    rng = random.Random(1)
    limits = sorted(rng.sample(range(100_000), 4_999))
    points = {"x": {(a, b): rng.randrange(-50, 50) for a, b in zip([None, *limits], [*limits, None])}, "g": {f"c{i}": i % 17 for i in range(5_000)}}
    points["x"]["missing"], points["g"]["missing"] = 7, 9
    rules = sc.rules_frame(spark, sc.rules_from_points(points))
    values = [(i, rng.choice([None, float("nan"), *rng.sample(range(100_000), 5), rng.choice(limits)]), rng.choice([None, "other", f"c{rng.randrange(5_000)}"]))
              for i in range(2_000)]
    df = spark.createDataFrame([(i, None if x is None else float(x), g) for i, x, g in values], "id long, x double, g string")
    out = sc.score_by_join(df, rules, ["id"], 100)
    of_x = list(points["x"].values())
    def want(x, g):
        cell = -1 if x is None else 4_999 if x != x else bisect.bisect_right(limits, x)
        return 100 + (7 if x is None else of_x[cell]) + (9 if g is None else points["g"].get(g, 0))
    assert {r["id"]: r["total_score"] for r in out.collect()} == {i: want(x, g) for i, x, g in values}
    plan = plan_text(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    joins = [line for line in plan.split("\n") if "Join [variable" in line]
    assert joins and all("array_contains" not in line and ">=" not in line for line in joins)


def test_lookup_join_takes_the_first_of_two_rules_and_leaves_gaps(spark):
    rules = sc.rules_frame(spark, sc.rules_from_points({"x": {(0, 10): 5, (5, 20): 3, (30, None): 2}, "g": {"a": 1}}))
    df = spark.createDataFrame([(i, float(x), "a" if i % 2 else "b") for i, x in enumerate([-1, 0, 5, 10, 19, 20, 25, 30, 1e9])], "id long, x double, g string")
    got = {r["id"]: r["total_score"] for r in sc.score_by_join(df, rules, ["id"], 0).collect()}
    assert got == {r["id"]: r["total_score"] for r in sc.score(df, rules, 0).collect()}
