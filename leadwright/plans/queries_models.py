"""Queries on splits, bins, models, evaluation, scorecards and monitoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators import evaluate as ev
from leadwright.operators import model as md
from leadwright.operators import monitor as mn
from leadwright.operators import scorecard as sc
from leadwright.operators import woe as wo
from leadwright.operators.monitor_state import MonitorState
from leadwright.plans import features as ft
from leadwright.plans import oracle as oc
from leadwright.plans.registry import SPAN, TIERS, feature_stage, query, sources
from leadwright.plans.scoring import daily_scoring as run_daily
from leadwright.plans.training import NOT_FEATURES, train_scorecard
from leadwright.session import materialise, shared_dir
from leadwright.sources import roles, tables

TARGET = fx.TARGET
NUMERIC = {v: b for v, b in fx.BREAKS.items() if not any(isinstance(x, str) and x != wo.MISSING for x in b)}
TEXT = {v: b for v, b in fx.BREAKS.items() if v not in NUMERIC}
MODEL_VARIABLES = [v for v in fx.SELECTED if v in fx.BREAKS]
MODEL_BREAKS = {v: fx.BREAKS[v] for v in MODEL_VARIABLES}
FIXED_COEFS = {md.INTERCEPT: -3.0, **{f"{v}_woe": round(0.9 - 0.1 * i, 2) for i, v in enumerate(MODEL_VARIABLES)}}


# ---------------------------------------------------------------- SQL of the bin tables
def bins_sql(breaks: dict[str, list], source: str = "features") -> str:
    parts = []
    for v, marks in breaks.items():
        values = [m for m in marks if m != wo.MISSING]
        labels = [b.label for b in wo.bins_from_breaks({v: marks})]
        if v in NUMERIC:
            cell = f"1 + len(list_filter([{', '.join(map(str, values))}], lambda b: b <= {v}))"
        else:
            cell = f"list_position({values!r}, {v})"
        parts.append(f"SELECT '{v}' AS variable, CASE WHEN {v} IS NULL THEN 0 ELSE {cell} END AS bin_id, "
                     f"{labels!r}[bin_id + 1] AS bin, {TARGET} AS y FROM {source}")
    return (f"SELECT variable, CAST(bin_id AS INTEGER) AS bin_id, bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos, "
            f"count(*) - CAST(sum(y) AS BIGINT) AS neg FROM ({' UNION ALL '.join(parts)}) WHERE bin_id IS NOT NULL GROUP BY ALL")


def woe_sql(counts: str) -> str:
    return f"""SELECT *, ln(p / q) AS woe, (p - q) * ln(p / q) AS bin_iv FROM (
      SELECT *, pa / sum(pa) OVER (PARTITION BY variable) AS p, na / sum(na) OVER (PARTITION BY variable) AS q FROM (
        SELECT *, CASE WHEN pos = 0 THEN 0.9::DOUBLE ELSE pos::DOUBLE END AS pa, CASE WHEN neg = 0 THEN 0.9::DOUBLE ELSE neg::DOUBLE END AS na
        FROM ({counts})))"""


WOE = {"woe_bins": woe_sql(bins_sql(fx.BREAKS))}
MODEL_WOE = {"woe_bins": woe_sql(bins_sql(MODEL_BREAKS))}


def manual(spark, sf, breaks):
    return wo.woe_table(wo.bin_counts(feature_stage(spark, sf), wo.bins_from_breaks(breaks), TARGET))


# ---------------------------------------------------------------- splits
@query("split_stratified", f"""SELECT task_id, {TARGET}, CASE WHEN rn <= round(0.7 * n) THEN 'train' ELSE 'test' END AS part FROM (
       SELECT task_id, {TARGET}, count(*) OVER (PARTITION BY {TARGET}) AS n,
       row_number() OVER (PARTITION BY {TARGET} ORDER BY md5('{fx.SPLIT_SEED}|' || task_id), task_id) AS rn FROM features)""")
def split_stratified(spark, sf):
    rows = feature_stage(spark, sf).select("task_id", TARGET)
    return md.split_stratified(rows, ["task_id"], TARGET)


@query("split_out_of_time", "SELECT task_id, alloc_date, CASE WHEN alloc_date >= DATE '2024-01-20' THEN 'test' ELSE 'train' END AS part FROM features")
def split_out_of_time(spark, sf):
    return md.split_out_of_time(feature_stage(spark, sf).select("task_id", "alloc_date"), "alloc_date", "2024-01-20")


# ---------------------------------------------------------------- bins
@query("woe_bin_counts", f"SELECT variable, bin_id, bin, n, pos, neg FROM ({bins_sql(fx.BREAKS)})")
def woe_bin_counts(spark, sf):
    counts = wo.bin_counts(feature_stage(spark, sf), wo.bins_from_breaks(fx.BREAKS), TARGET)
    return counts.select("variable", "bin_id", "bin", "n", "pos", "neg")


def rounded(df):
    return df.select("variable", "bin", "n", "pos", F.round("woe", 6).alias("woe"), F.round("bin_iv", 6).alias("bin_iv"))


_ROUNDED = "variable, bin, n, pos, round(woe, 6) AS woe, round(bin_iv, 6) AS bin_iv"


@query("woe_manual_numeric", f"SELECT {_ROUNDED} FROM ({woe_sql(bins_sql(NUMERIC))})")
def woe_manual_numeric(spark, sf):
    return rounded(manual(spark, sf, NUMERIC))


@query("woe_manual_categorical", f"SELECT {_ROUNDED} FROM ({woe_sql(bins_sql(TEXT))})")
def woe_manual_categorical(spark, sf):
    return rounded(manual(spark, sf, TEXT))


@query("woe_missing_bin", f"SELECT {_ROUNDED} FROM woe_bins WHERE bin = 'missing'", WOE)
def woe_missing_bin(spark, sf):
    return rounded(manual(spark, sf, fx.BREAKS).where(F.col("kind") == wo.MISSING))


@query("woe_table", f"SELECT {_ROUNDED} FROM woe_bins", WOE)
def woe_table(spark, sf):
    return rounded(manual(spark, sf, fx.BREAKS))


@query("information_value", "SELECT variable, round(sum(bin_iv), 6) AS iv, count(*) AS n_bins FROM woe_bins GROUP BY variable "
       "HAVING sum(bin_iv) >= 0.02", WOE)
def information_value(spark, sf):
    return wo.information_value(manual(spark, sf, fx.BREAKS), 0.02).withColumn("iv", F.round("iv", 6))


def _woe_value(v: str) -> str:
    values = [m for m in fx.BREAKS[v] if m != wo.MISSING]
    cell = (f"1 + len(list_filter([{', '.join(map(str, values))}], lambda b: b <= f.{v}))" if v in NUMERIC
            else f"list_position({values!r}, f.{v})")
    return (f"coalesce((SELECT max(woe) FROM woe_bins b WHERE b.variable = '{v}' AND b.bin_id = CASE WHEN f.{v} IS NULL THEN 0 "
            f"ELSE {cell} END), 0.0)")


@query("woe_apply", "SELECT task_id, {} FROM features f".format(
    ", ".join(f"round({_woe_value(v)}, 6) AS {v}_woe" for v in MODEL_VARIABLES)), MODEL_WOE)
def woe_apply(spark, sf):
    out = wo.apply_woe(feature_stage(spark, sf), manual(spark, sf, MODEL_BREAKS), ["task_id"])
    return out.select("task_id", *[F.round(f"{v}_woe", 6).alias(f"{v}_woe") for v in MODEL_VARIABLES])


@query("woe_monotonicity", """SELECT variable, count(*) AS n_bins, CAST(count(*) FILTER (WHERE step * before < 0) AS BIGINT) AS turns,
       count(*) FILTER (WHERE step * before < 0) = 0 AS monotone
       FROM (SELECT variable, step, lag(step) OVER (PARTITION BY variable ORDER BY bin_id) AS before FROM (
         SELECT variable, bin_id, sign(woe - lag(woe) OVER (PARTITION BY variable ORDER BY bin_id)) AS step FROM woe_bins
         WHERE bin <> 'missing')) GROUP BY variable""", {"woe_bins": woe_sql(bins_sql(NUMERIC))})
def woe_monotonicity(spark, sf):
    return wo.monotonicity(manual(spark, sf, NUMERIC))


AUTO_VARIABLES = ["id_age", "hz_eff_order_num", "sdb_app_start_flag", "visit_cnt_cf", "device_type", "channel_group"]


def _auto_step(k: int) -> dict[str, str]:
    """One greedy step: every further cut is tried, the best one joins the cuts if it gains enough."""
    return {
        f"tried{k}": f"""SELECT t.variable, t.cand, t.cuts, t.iv, sum(n) AS n, sum(pos) AS pos FROM (
          SELECT s.variable, s.iv, f.cell AS cand, list_append(s.cuts, f.cell) AS cuts FROM state{k - 1} s JOIN fine f USING (variable)
          WHERE f.cell > 0 AND NOT list_contains(s.cuts, f.cell)) t JOIN fine f USING (variable)
          GROUP BY t.variable, t.cand, t.cuts, t.iv, len(list_filter(t.cuts, lambda c: c <= f.cell))""",
        f"valued{k}": f"""SELECT variable, cand, cuts, iv, round(sum((p - q) * ln(p / q)), 9) AS gained FROM (
          SELECT *, pa / sum(pa) OVER w AS p, na / sum(na) OVER w AS q, min(n) OVER w AS least, sum(n) OVER w AS everything FROM (
            SELECT *, CASE WHEN pos = 0 THEN 0.9::DOUBLE ELSE pos::DOUBLE END AS pa, CASE WHEN n = pos THEN 0.9::DOUBLE ELSE (n - pos)::DOUBLE END AS na
            FROM tried{k}) WINDOW w AS (PARTITION BY variable, cand)) WHERE least >= 0.05::DOUBLE * everything GROUP BY variable, cand, cuts, iv""",
        f"state{k}": f"""SELECT s.variable, coalesce(v.cuts, s.cuts) AS cuts, coalesce(v.gained, s.iv) AS iv FROM state{k - 1} s LEFT JOIN (
          SELECT * FROM valued{k} WHERE gained > iv AND NOT (iv > 0 AND gained / iv - 1 < 0.1::DOUBLE)
          QUALIFY row_number() OVER (PARTITION BY variable ORDER BY gained DESC, cand) = 1) v USING (variable)""",
    }


_AUTO_TEXT = ("device_type", "channel_group")
AUTO = {
    "auto_rows": " UNION ALL ".join(
        f"SELECT '{v}' AS variable, {'NULL::DOUBLE' if v in _AUTO_TEXT else v + '::DOUBLE'} AS num, {v if v in _AUTO_TEXT else 'NULL'}::VARCHAR AS txt, "
        f"{TARGET} AS y FROM features" for v in AUTO_VARIABLES),
    "fine": """SELECT *, CASE WHEN txt IS NULL THEN dense_rank() OVER (PARTITION BY variable ORDER BY num)
      ELSE row_number() OVER (PARTITION BY variable ORDER BY pos::DOUBLE / n::DOUBLE, txt) END - 1 AS cell FROM (
        SELECT variable, num, txt, count(*) AS n, sum(y)::BIGINT AS pos FROM auto_rows WHERE num IS NOT NULL OR txt IS NOT NULL GROUP BY ALL)""",
    "state0": "SELECT DISTINCT variable, [0::BIGINT] AS cuts, 0.0::DOUBLE AS iv FROM fine",
    **{name: sql for k in range(1, 8) for name, sql in _auto_step(k).items()},
    "auto_cells": "SELECT f.*, len(list_filter(cuts, lambda c: c <= cell)) AS bin_id FROM fine f JOIN state7 USING (variable)",
    "auto_counts": """SELECT variable, bin_id::INTEGER AS bin_id, CASE WHEN max(txt) IS NOT NULL THEN string_agg(txt, '|' ORDER BY txt)
        ELSE '[' || CASE WHEN bin_id = 1 THEN '-inf' ELSE printf('%g', min(num)) END || ',' || coalesce(printf('%g', (SELECT min(num) FROM auto_cells b
          WHERE b.variable = a.variable AND b.bin_id = a.bin_id + 1)), 'inf') || ')' END AS bin, sum(n)::BIGINT AS n, sum(pos)::BIGINT AS pos,
      (sum(n) - sum(pos))::BIGINT AS neg FROM auto_cells a GROUP BY variable, bin_id
      UNION ALL SELECT variable, 0, 'missing', count(*), sum(y)::BIGINT, (count(*) - sum(y))::BIGINT FROM auto_rows WHERE num IS NULL AND txt IS NULL GROUP BY variable""",
}


@query("woe_auto_bins", f"SELECT variable, bin_id, bin, n, pos, round(woe, 6) AS woe FROM ({woe_sql('SELECT * FROM auto_counts')})", AUTO)
def woe_auto_bins(spark, sf):
    """Automatic bins: greedy splits of the fine cells by gain in information value."""
    bins = wo.auto_bins(feature_stage(spark, sf), TARGET, AUTO_VARIABLES)
    return bins.select("variable", "bin_id", "bin", "n", "pos", F.round("woe", 6).alias("woe"))


# Least squares under an order, by its min-max formula: the greatest of the least means over all runs of bins around each bin.
MONOTONE = {
    "numeric_bins": f"SELECT * FROM ({bins_sql(NUMERIC)})",
    "runs": """SELECT a.variable, a.bin_id AS a, b.bin_id AS b, sum(m.pos)::DOUBLE / sum(m.n)::DOUBLE AS mean FROM numeric_bins a JOIN numeric_bins b
      ON a.variable = b.variable AND a.bin_id <= b.bin_id AND a.bin <> 'missing' AND b.bin <> 'missing'
      JOIN numeric_bins m ON m.variable = a.variable AND m.bin_id BETWEEN a.bin_id AND b.bin_id AND m.bin <> 'missing' GROUP BY ALL""",
    "fits": """SELECT variable, bin_id, max(up) AS up, min(down) AS down FROM (
        SELECT n.variable, n.bin_id, a, min(mean) AS up, max(mean) AS down FROM numeric_bins n JOIN runs r
        ON r.variable = n.variable AND n.bin_id BETWEEN a AND b GROUP BY ALL) GROUP BY ALL""",
    "ways": """SELECT variable, round(sum(n * (pos::DOUBLE / n::DOUBLE - up) ** 2), 9) <= round(sum(n * (pos::DOUBLE / n::DOUBLE - down) ** 2), 9) AS rising
      FROM fits JOIN numeric_bins USING (variable, bin_id) GROUP BY variable""",
    "pooled": """SELECT variable, bin_id, fit, dense_rank() OVER (PARTITION BY variable ORDER BY CASE WHEN rising THEN fit ELSE -fit END)::INTEGER AS pool
      FROM (SELECT *, CASE WHEN rising THEN up ELSE down END AS fit FROM fits JOIN ways USING (variable))""",
    "pooled_counts": """SELECT variable, pool AS bin_id, '[' || split_part(arg_min(bin, bin_id)[2:], ',', 1) || ',' || split_part(arg_max(bin, bin_id), ',', 2) AS bin,
      sum(n)::BIGINT AS n, sum(pos)::BIGINT AS pos, sum(neg)::BIGINT AS neg FROM pooled JOIN numeric_bins USING (variable, bin_id) GROUP BY variable, pool
      UNION ALL SELECT variable, bin_id, bin, n, pos, neg FROM numeric_bins WHERE bin = 'missing'""",
}


@query("woe_monotone_bins", f"SELECT variable, bin_id, bin, n, pos, round(woe, 6) AS woe, true AS monotone FROM ({woe_sql('SELECT * FROM pooled_counts')})", MONOTONE)
def woe_monotone_bins(spark, sf):
    """The manual bins pooled until every variable's WOE is monotone, and whether it is."""
    bins = wo.monotone_bins(manual(spark, sf, NUMERIC))
    checked = wo.monotonicity(bins, F.col("pos") / F.col("n")).select("variable", "monotone")
    return bins.join(checked, "variable").select(
        "variable", "bin_id", "bin", "n", "pos", F.round("woe", 6).alias("woe"), "monotone")


# ---------------------------------------------------------------- model
TRAIN_SPLIT = f"""SELECT features.*, CASE WHEN row_number() OVER (PARTITION BY {TARGET} ORDER BY md5('{fx.SPLIT_SEED}|' || task_id), task_id)
  <= round(0.7 * count(*) OVER (PARTITION BY {TARGET})) THEN 'train' ELSE 'test' END AS part FROM features"""
_TRAINED: dict = {}


def trained(spark, sf):
    """One training run per session and input: the three queries below report parts of it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = train_scorecard(feature_stage(spark, sf))
    return _TRAINED[key]


@query("l1_fit")
def l1_fit(spark, sf):
    """Coefficients of the first fit over all binned variables; optimality is checked in the tests."""
    return trained(spark, sf).first_coefs


_FITTED = sorted(c for c in ft.FINAL_COLUMNS if c not in NOT_FEATURES and c != TARGET)


@query("l1_optimality", f"""SELECT feature, n, positives, true AS optimal FROM (SELECT unnest({[md.INTERCEPT, *(f'{c}_woe' for c in _FITTED)]!r}) AS feature),
       (SELECT count(*) AS n, sum({TARGET})::BIGINT AS positives FROM train_rows)""", {"split": TRAIN_SPLIT, "train_rows": "SELECT * FROM split WHERE part = 'train'"})
def l1_optimality(spark, sf):
    """Whether every coefficient of the first fit meets the condition of the optimum, from the gradients over the training rows."""
    run = trained(spark, sf)
    found = md.l1_optimality(run.train_woe, run.first_coefs, TARGET)
    return found.select("feature", "n", "positives", "optimal")


@query("l1_selected")
def l1_selected(spark, sf):
    coefs = trained(spark, sf).first_coefs
    return coefs.where((F.col("feature") != md.INTERCEPT) & (F.abs("coefficient") > 1e-6)).select("feature")


@query("l1_fit_final")
def l1_fit_final(spark, sf):
    return trained(spark, sf).coefs


_LOGIT = " + ".join([str(FIXED_COEFS[md.INTERCEPT])] + [f"{b} * ({_woe_value(v)})" for v, b in zip(MODEL_VARIABLES, list(FIXED_COEFS.values())[1:])])


@query("predict_fixed_coefs", f"SELECT task_id, round(1 / (1 + exp(-({_LOGIT}))), 8) AS probability FROM features f", MODEL_WOE)
def predict_fixed_coefs(spark, sf):
    woe = wo.apply_woe(feature_stage(spark, sf), manual(spark, sf, MODEL_BREAKS), ["task_id"])
    return woe.select("task_id", F.round(md.probability(FIXED_COEFS), 8).alias("probability"))


# ---------------------------------------------------------------- evaluation, on the line items as scored rows
SCORED_ITEMS = {"scored_rows": "SELECT l_extendedprice AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem"}


def scored_items(spark, sf):
    items = roles.given(spark, sf, "lineitem")
    return items.select(F.col("l_extendedprice").alias("score"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))


_CURVE = ("SELECT score, sum(sum(1 - y)) OVER w AS fp, sum(sum(y)) OVER w AS tp, sum(sum(1 - y)) OVER () AS n, sum(sum(y)) OVER () AS p "
          "FROM scored_rows GROUP BY score WINDOW w AS (ORDER BY score DESC)")


@query("roc_curve", f"SELECT score AS threshold, fp::DOUBLE / n::DOUBLE AS fpr, tp::DOUBLE / p::DOUBLE AS tpr FROM ({_CURVE}) UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE", SCORED_ITEMS)
def roc_curve(spark, sf):
    return ev.roc_curve(scored_items(spark, sf), "score", "y")


def rank_auc(by: str = "", source: str = "scored_rows", score: str = "score", y: str = "y") -> str:
    """AUC from the mean ranks of the positives (Mann-Whitney)."""
    part = f"PARTITION BY {by} " if by else ""
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return (f"SELECT {keys}count(*) AS n, CAST(sum({y}) AS BIGINT) AS positives, "
            f"CASE WHEN sum({y}) > 0 AND sum(1 - {y}) > 0 THEN round((sum(CASE WHEN {y} = 1 THEN r END) - sum({y})::DOUBLE * (sum({y}) + 1) / 2) "
            f"/ (sum({y})::DOUBLE * sum(1 - {y})), 9) END AS auc FROM (SELECT {keys}{y}, rank() OVER ({part}ORDER BY {score}) "
            f"+ (count(*) OVER (PARTITION BY {keys}{score}) - 1) / 2.0::DOUBLE AS r FROM {source}) {group}")


@query("auc", rank_auc(), SCORED_ITEMS)
def auc(spark, sf):
    return ev.auc_ks(scored_items(spark, sf), "score", "y").select("n", "positives", F.round("auc", 9).alias("auc"))


@query("ks", f"SELECT round(max(abs(tp::DOUBLE / p::DOUBLE - fp::DOUBLE / n::DOUBLE)), 9) AS ks FROM ({_CURVE})", SCORED_ITEMS)
def ks(spark, sf):
    return ev.auc_ks(scored_items(spark, sf), "score", "y").select(F.round("ks", 9).alias("ks"))


DECILES = {
    **SCORED_ITEMS,
    "edges": "SELECT list_sort(list_distinct(quantile_cont(score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM scored_rows",
    "deciles": """SELECT i, CASE WHEN i = 1 THEN e[1] - 0.00001::DOUBLE ELSE e[i] END AS lo,
      CASE WHEN i = len(e) - 1 THEN e[i + 1] + 0.00001::DOUBLE ELSE e[i + 1] END AS hi FROM (SELECT e, unnest(range(1, len(e))) AS i FROM edges)""",
    "report": """SELECT i, printf('%d.%s%.5f,%.5f]', 10 - i, CASE WHEN i = 1 THEN '[' ELSE '(' END, lo, hi) AS Decile,
      CAST(sum(y) AS BIGINT) AS Ones, count(*) AS Population FROM scored_rows JOIN deciles ON score > lo AND score <= hi GROUP BY i, lo, hi""",
    "shares": """SELECT i, Decile, Ones, Population, Ones::DOUBLE / Population AS ResponseRate,
      (sum(Ones) OVER w)::DOUBLE / (sum(Population) OVER w)::DOUBLE AS CumulativeResponseRate,
      Ones::DOUBLE / (sum(Ones) OVER ())::DOUBLE AS RecallRate, (sum(Ones) OVER w)::DOUBLE / (sum(Ones) OVER ())::DOUBLE AS CumulativeRecallRate
      FROM report WINDOW w AS (ORDER BY i DESC)""",
}


@query("decile_table", "SELECT * EXCLUDE (i) FROM shares", DECILES)
def decile_table(spark, sf):
    return ev.decile_table(scored_items(spark, sf), "score", "y")


@query("decile_table_approx")
def decile_table_approx(spark, sf):
    """Sketched edges; the tests bound the distance from the exact report."""
    return ev.decile_table_approx(scored_items(spark, sf), "score", "y")


DAY_SHARES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


@query("decile_sketch_errors", f"""SELECT share, n, round({ev.SKETCH_ERROR!r}::DOUBLE, 9) AS bound, true AS within
       FROM (SELECT unnest({DAY_SHARES}::DOUBLE[]) AS share), (SELECT count(*) AS n FROM scored_rows)""", SCORED_ITEMS)
def decile_sketch_errors(spark, sf):
    """One stored sketch per ship day, merged: whether the true rank of every decile edge keeps to the stated bound."""
    days = roles.given(spark, sf, "lineitem").select("l_shipdate", F.col("l_extendedprice").alias("score"), F.lit(1).alias("y"))
    kept = materialise(ev.score_sketches(days, "score", "y", ["l_shipdate"]), "sketches")
    found = ev.edge_errors(days, "score", "y", kept, DAY_SHARES)
    return found.select("share", "n", F.round("bound", 9).alias("bound"), "within")


@query("top_deciles", "SELECT * EXCLUDE (i) FROM shares ORDER BY i DESC LIMIT 3", DECILES)
def top_deciles(spark, sf):
    return ev.top_deciles(ev.decile_table(scored_items(spark, sf), "score", "y"))


# ---------------------------------------------------------------- scorecard rules
_B = f"({fx.PDO} / ln(2))"
_BETA = "[{}]".format(", ".join(f"{{'v': '{v}', 'beta': {FIXED_COEFS[v + '_woe']}}}" for v in MODEL_VARIABLES))


def rules_sql(woe: str = "woe_bins") -> str:
    return (f"SELECT variable, bin, CAST(round({_B} * c.beta * woe) AS INTEGER) AS points FROM {woe} JOIN "
            f"(SELECT unnest({_BETA}, recursive := true)) c ON c.v = variable UNION ALL SELECT 'basepoints', NULL, "
            f"CAST(round({fx.POINTS0} + {_B} * ({FIXED_COEFS[md.INTERCEPT]} - ln(1 / 19.0))) AS INTEGER)")


def fixed_coefs(spark):
    return spark.createDataFrame(list(FIXED_COEFS.items()), "feature string, coefficient double")


def data_rules(spark, sf, rows=None):
    rows = feature_stage(spark, sf) if rows is None else rows
    bins = wo.woe_table(wo.bin_counts(rows, wo.bins_from_breaks(MODEL_BREAKS), TARGET))
    return sc.scorecard(bins, fixed_coefs(spark))


@query("scorecard_rules", rules_sql(), MODEL_WOE)
def scorecard_rules(spark, sf):
    return data_rules(spark, sf).select("variable", "bin", "points")


@query("rules_export", rules_sql(), MODEL_WOE)
def rules_export(spark, sf):
    """Rules written as one CSV file and read back."""
    path = tables.export_rules(data_rules(spark, sf), f"{shared_dir(spark)}/rules-{uuid.uuid4().hex}")
    return tables.import_rules(spark, path).select("variable", "bin", "points")


# Limits of more than six digits, two of them neighbours.
ITEM_POINTS = {
    "l_extendedprice": {(None, 12345.67): 5, (12345.67, 23456.78): -4, (23456.78, 23456.79): 90, (23456.79, 54321.05): 11, (54321.05, None): 30, "missing": 1},
    "l_returnflag": {"R": 7, "A": -3},
}
ITEM_SCORES = """SELECT l_orderkey, l_linenumber, 100 + CASE WHEN l_extendedprice IS NULL THEN 1 WHEN l_extendedprice < 12345.67 THEN 5
  WHEN l_extendedprice < 23456.78 THEN -4 WHEN l_extendedprice < 23456.79 THEN 90 WHEN l_extendedprice < 54321.05 THEN 11 ELSE 30 END
  + CASE l_returnflag WHEN 'R' THEN 7 WHEN 'A' THEN -3 ELSE 0 END AS total_score FROM lineitem"""


@query("rules_sql_scoring", ITEM_SCORES)
def rules_sql_scoring(spark, sf):
    """Scores from the rules written as SQL text."""
    rules = sc.rules_frame(spark, sc.rules_from_points(ITEM_POINTS))
    total = " + ".join(f"({text})" for text in sc.rules_sql(rules).values())
    return roles.given(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"100 + {total} AS total_score")


@query("rules_reimport_scoring", ITEM_SCORES)
def rules_reimport_scoring(spark, sf):
    """Scores from a rule table that was exported and read back."""
    rules = sc.rules_frame(spark, sc.rules_from_points(ITEM_POINTS))
    path = tables.export_rules(rules, f"{shared_dir(spark)}/rules-{uuid.uuid4().hex}")
    scored_rows = sc.score(roles.given(spark, sf, "lineitem"), tables.import_rules(spark, path), 100)
    return scored_rows.select("l_orderkey", "l_linenumber", "total_score")


# ---------------------------------------------------------------- evaluation on the test part
def cells_sql(breaks: dict[str, list], source: str) -> str:
    """Row, variable and bin number of every binned value."""
    parts = []
    for v, marks in breaks.items():
        values = [m for m in marks if m != wo.MISSING]
        cell = (f"1 + len(list_filter([{', '.join(map(str, values))}], lambda b: b <= {v}))" if v in NUMERIC
                else f"list_position({values!r}, {v})")
        parts.append(f"SELECT task_id, {TARGET} AS y, '{v}' AS variable, CASE WHEN {v} IS NULL THEN 0 ELSE {cell} END AS bin_id FROM {source}")
    return " UNION ALL ".join(parts)


_LOGIT = " + ".join(f"max(CASE WHEN variable = '{v}' THEN coalesce(woe, 0) END) * {FIXED_COEFS[v + '_woe']}::DOUBLE" for v in MODEL_VARIABLES)
TEST_PART = {
    "split": f"""SELECT features.*, CASE WHEN row_number() OVER (PARTITION BY {TARGET} ORDER BY md5('{fx.SPLIT_SEED}|' || task_id), task_id)
      <= round(0.7 * count(*) OVER (PARTITION BY {TARGET})) THEN 'train' ELSE 'test' END AS part FROM features""",
    "train_rows": "SELECT * FROM split WHERE part = 'train'",
    "test_rows": "SELECT * FROM split WHERE part = 'test'",
    "train_woe": woe_sql(bins_sql(MODEL_BREAKS, "train_rows")),
    "test_cells": cells_sql(MODEL_BREAKS, "test_rows"),
    "scored_rows": f"""SELECT y, round(1 / (1 + exp(-({FIXED_COEFS[md.INTERCEPT]}::DOUBLE + {_LOGIT}))), 12) AS score FROM test_cells
      LEFT JOIN train_woe USING (variable, bin_id) GROUP BY task_id, y""",
}


def test_part_scores(spark, sf):
    """Probability of the test part under fixed coefficients, with bins and WOE of the training part only."""
    split = md.split_stratified(feature_stage(spark, sf), ["task_id"], TARGET)
    bins = wo.woe_table(wo.bin_counts(split.where("part = 'train'"), wo.bins_from_breaks(MODEL_BREAKS), TARGET))
    test = wo.apply_woe(split.where("part = 'test'"), bins, ["task_id", TARGET])
    return test.select(F.col(TARGET).alias("y"), F.round(md.probability(FIXED_COEFS), 12).alias("score"))


@query("test_performance", f"SELECT n, positives, auc, ks FROM ({rank_auc()}), (SELECT round(max(abs(tp::DOUBLE / p::DOUBLE - fp::DOUBLE / n::DOUBLE)), 9) AS ks "
       f"FROM ({_CURVE}))", TEST_PART)
def test_performance(spark, sf):
    """AUC and KS of the probabilities on the test part."""
    return ev.auc_ks(test_part_scores(spark, sf), "score", "y").select("n", "positives", F.round("auc", 9).alias("auc"), F.round("ks", 9).alias("ks"))


@query("test_deciles", "SELECT * EXCLUDE (i) FROM shares", {**TEST_PART, **{n: q for n, q in DECILES.items() if n != "scored_rows"}})
def test_deciles(spark, sf):
    """Decile report of the probabilities on the test part."""
    return ev.decile_table(test_part_scores(spark, sf), "score", "y")


_HALVES = {
    "first_half": "SELECT * FROM features WHERE alloc_date < DATE '2024-01-16'",
    "second_half": "SELECT * FROM features WHERE alloc_date >= DATE '2024-01-16'",
}


@query("points_diff", "SELECT coalesce(a.variable, b.variable) AS variable, coalesce(a.bin, b.bin) AS bin, a.points AS old_points, "
       "b.points AS new_points, coalesce(b.points, 0) - coalesce(a.points, 0) AS change FROM old_rules a FULL JOIN new_rules b "
       "ON a.variable = b.variable AND a.bin IS NOT DISTINCT FROM b.bin",
       {**_HALVES, "old_rules": rules_sql(f"({woe_sql(bins_sql(MODEL_BREAKS, 'first_half'))})"),
        "new_rules": rules_sql(f"({woe_sql(bins_sql(MODEL_BREAKS, 'second_half'))})")})
def points_diff(spark, sf):
    """Rules learned on the first half of the month against those of the second half."""
    rows = feature_stage(spark, sf)
    early = F.col("alloc_date") < F.lit("2024-01-16").cast("date")
    return mn.points_diff(data_rules(spark, sf, rows.where(early)), data_rules(spark, sf, rows.where(~early)))


# ---------------------------------------------------------------- scoring
def scored(spark, sf):
    return sc.score(sc.eligible(feature_stage(spark, sf)), sc.deployed_rules(spark), fx.BASE_POINTS)


for _name, _variable in {
    "score_city_tier": "wx_city_class", "score_channel_group": "channel_group", "score_age": "id_age",
    "score_balance": "hz_total_bal_amt", "score_visits": "total_visit_cnt_short", "score_app_start": "sdb_app_start_flag",
}.items():
    query(_name, f"SELECT task_id, {_variable}, {_variable}_score FROM scored")(
        lambda spark, sf, v=_variable: scored(spark, sf).select("task_id", v, f"{v}_score"))


@query("score_compiled", "SELECT task_id, total_score FROM scored")
def score_compiled(spark, sf):
    return scored(spark, sf).select("task_id", "total_score")


@query("score_rules_join", "SELECT task_id, total_score FROM scored")
def score_rules_join(spark, sf):
    return sc.score_by_join(sc.eligible(feature_stage(spark, sf)), sc.deployed_rules(spark), ["task_id"], fx.BASE_POINTS)


@query("total_score", f"SELECT DISTINCT total_score, user_id, {TARGET} FROM scored")
def total_score(spark, sf):
    """The original grain: distinct score, user and flag."""
    return scored(spark, sf).select("total_score", "user_id", TARGET).distinct()


RANK_COLUMNS = ["lead_rank", "total_score", "user_id", "task_id", TARGET, "last_visit_time"]


def ranked(spark, sf):
    rows = scored(spark, sf).select(*RANK_COLUMNS[1:])
    return sc.rank_leads(rows, recency="last_visit_time", ids=["user_id", "task_id"]).select(*RANK_COLUMNS)


@query("rank_leads", "SELECT * FROM ranked")
def rank_leads(spark, sf):
    return ranked(spark, sf)


@query("top_fraction", "SELECT * FROM ranked WHERE lead_rank <= ceil(0.3 * (SELECT count(*) FROM ranked))")
def top_fraction(spark, sf):
    return sc.top_fraction(ranked(spark, sf))


@query("score_reasons", "SELECT task_id, total_score, CAST(reason AS INTEGER) AS reason, variable, points FROM (SELECT *, "
       "row_number() OVER (PARTITION BY task_id ORDER BY abs(points) DESC, variable) AS reason FROM (" + " UNION ALL ".join(
           f"SELECT task_id, total_score, '{v}' AS variable, {v}_score AS points FROM scored" for v in oc.SCORED_VARIABLES)
       + ")) WHERE reason <= 3")
def score_reasons(spark, sf):
    return sc.score_reasons(scored(spark, sf), oc.SCORED_VARIABLES, ["task_id"])


@query("ranked_export", "SELECT *, DATE '2024-01-31' AS run_date FROM ranked")
def ranked_export(spark, sf):
    """Ranked leads delivered as a table partitioned by run date, delivered twice, then read back."""
    path = f"{shared_dir(spark)}/ranked-{uuid.uuid4().hex}"
    for _ in range(2):
        tables.export_ranked(ranked(spark, sf), path, oc.AS_OF)
    return spark.read.parquet(path).where(F.col("run_date") == F.lit(oc.AS_OF).cast("date"))


# The delivery of the day before holds the leads allocated until then, with points a little lower for some.
_BEFORE = {"ranked_before": """SELECT row_number() OVER (ORDER BY points DESC, last_visit_time DESC NULLS LAST, user_id NULLS LAST, task_id) AS lead_rank,
  points AS total_score, user_id, task_id FROM (SELECT *, CAST(total_score - (total_visit_cnt_short_score > 0)::INTEGER AS INTEGER) AS points
  FROM scored WHERE alloc_date <= DATE '2024-01-29' OR alloc_date > DATE '2024-01-30')"""}


@query("delivery_changes", """SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.task_id, b.task_id) AS task_id,
       CASE WHEN b.task_id IS NULL THEN 'new' WHEN a.task_id IS NULL THEN 'dropped' ELSE 'moved' END AS change,
       b.total_score AS before, a.total_score AS after, DATE '2024-01-31' AS run_date
       FROM (SELECT * FROM ranked JOIN (SELECT task_id FROM features WHERE alloc_date <= DATE '2024-01-30') USING (task_id)) a
       FULL JOIN ranked_before b ON a.task_id = b.task_id AND a.user_id IS NOT DISTINCT FROM b.user_id
       WHERE a.total_score IS DISTINCT FROM b.total_score""", _BEFORE)
def delivery_changes(spark, sf):
    """New, moved and dropped leads of a delivery against the one before it; the second delivery is made twice."""
    rows = scored(spark, sf)
    path, changes = (f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}" for name in ("deliveries", "changes"))
    lower = F.col("total_score") - (F.col("total_visit_cnt_short_score") > 0).cast("int")
    first = rows.where((F.col("alloc_date") <= "2024-01-29") | (F.col("alloc_date") > "2024-01-30")).withColumn("total_score", lower)
    second = rows.where(F.col("alloc_date") <= "2024-01-30")
    for day, part in (("2024-01-30", first), ("2024-01-31", second), ("2024-01-31", second)):
        found = sc.rank_leads(part.select(*RANK_COLUMNS[1:]), recency="last_visit_time", ids=["user_id", "task_id"])
        tables.export_ranked(found.select(*RANK_COLUMNS), path, day)
        tables.deliver_changes(path, changes, spark, day, ["user_id", "task_id"], "total_score")
    return spark.read.parquet(changes).where(F.col("run_date") == F.lit("2024-01-31").cast("date"))


@query("daily_scoring", "SELECT * FROM ranked")
def daily_scoring(spark, sf):
    return run_daily(sources(spark, sf), SPAN, TIERS).select(*RANK_COLUMNS)


# ---------------------------------------------------------------- monitoring
WEEKLY = {
    "week_rows": f"SELECT CAST(date_trunc('week', alloc_date) AS DATE) AS week, total_score AS score, {TARGET} AS y FROM scored",
    "week_auc": rank_auc("week", "week_rows"),
    "week_ks": """SELECT week, CASE WHEN p > 0 AND n > 0 THEN round(max(abs(tp::DOUBLE / p::DOUBLE - fp::DOUBLE / n::DOUBLE)), 9) END AS ks FROM (
      SELECT week, sum(sum(1 - y)) OVER o AS fp, sum(sum(y)) OVER o AS tp, sum(sum(1 - y)) OVER (PARTITION BY week) AS n,
      sum(sum(y)) OVER (PARTITION BY week) AS p FROM week_rows GROUP BY week, score WINDOW o AS (PARTITION BY week ORDER BY score DESC)) GROUP BY week, p, n""",
}


def weekly(spark, sf):
    rows = mn.weekly_performance(scored(spark, sf).select("alloc_date", "total_score", TARGET), "total_score", TARGET, "alloc_date")
    return rows.withColumns({"auc": F.round("auc", 9), "ks": F.round("ks", 9)})


@query("weekly_performance", "SELECT week, n, positives, auc, ks FROM week_auc JOIN week_ks USING (week)", WEEKLY)
def weekly_performance(spark, sf):
    return weekly(spark, sf).select("week", "n", "positives", "auc", "ks")


SCORE_BREAKS = [280, 310, 340, 370, 400]


def monitor_state(spark, sf, bins, training=None):
    """A monitoring state after three daily updates, the second of them made twice."""
    state = MonitorState(f"{shared_dir(spark)}/monitor-{uuid.uuid4().hex}", bins)
    rows = scored(spark, sf)
    if training is not None:
        state.freeze(rows.where(training))
    day = F.col("alloc_date")
    for part in (day <= "2024-01-10", day.between("2024-01-11", "2024-01-20"), day.between("2024-01-11", "2024-01-20"), day > "2024-01-20"):
        state.update(rows.where(part), "alloc_date", "total_score", TARGET)
    return state


@query("weekly_performance_state", "SELECT week, n, positives, auc, ks FROM week_auc JOIN week_ks USING (week)", WEEKLY)
def weekly_performance_state(spark, sf):
    """Weekly AUC and KS read from the kept histograms."""
    found = monitor_state(spark, sf, wo.bins_from_breaks({"total_score": SCORE_BREAKS})).weekly_performance(spark)
    return found.select("week", "n", "positives", F.round("auc", 9).alias("auc"), F.round("ks", 9).alias("ks"))


@query("retrain_trigger", """SELECT week, auc, ks, below, below AND coalesce(lag(below) OVER (ORDER BY week)
       AND lag(week) OVER (ORDER BY week) = week - 7, false) AS trigger FROM (
       SELECT week, auc, ks, coalesce(ks < 0.30 OR auc < 0.65, false) AS below FROM week_auc JOIN week_ks USING (week))""", WEEKLY)
def retrain_trigger(spark, sf):
    return mn.retrain_trigger(weekly(spark, sf)).select("week", "auc", "ks", "below", "trigger")


def psi_sql(parts: dict[str, tuple[str, str]]) -> str:
    """``parts``: variable -> (cell expression, source)."""
    sides = []
    for side, test in (("e", "alloc_date < DATE '2024-01-16'"), ("a", "alloc_date >= DATE '2024-01-16'")):
        rows = " UNION ALL ".join(f"SELECT '{v}' AS variable, {cell} AS cell FROM {source} WHERE {test}" for v, (cell, source) in parts.items())
        sides.append(f"(SELECT variable, cell, count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY variable))::DOUBLE AS {side} FROM ({rows}) GROUP BY variable, cell)")
    return (f"SELECT variable, round(sum((a1 - e1) * ln(a1 / e1)), 6) AS psi, count(*) AS n_bins, sum((a1 - e1) * ln(a1 / e1)) > 0.2 AS shifted FROM ("
            f"SELECT variable, greatest(coalesce(e, 0), 0.0001) AS e1, greatest(coalesce(a, 0), 0.0001) AS a1 FROM {sides[0]} FULL JOIN {sides[1]} "
            "USING (variable, cell)) GROUP BY variable")


@query("psi_score", psi_sql({"total_score": (f"len(list_filter({SCORE_BREAKS}, lambda b: b <= total_score))", "scored")}))
def psi_score(spark, sf):
    rows = scored(spark, sf)
    early = F.col("alloc_date") < F.lit("2024-01-16").cast("date")
    out = mn.psi(rows.where(early), rows.where(~early), wo.bins_from_breaks({"total_score": SCORE_BREAKS}))
    return out.withColumn("psi", F.round("psi", 6))


TOP3 = ["wx_city_class", "channel_group", "id_age"]


@query("psi_features", psi_sql({
    **{v: (f"coalesce({v}, 'missing')", "features") for v in TOP3[:2]},
    "id_age": ("CASE WHEN id_age IS NULL THEN 'missing' ELSE CAST(len(list_filter([18, 24, 31, 41, 50], lambda b: b <= id_age)) AS VARCHAR) END", "features")}))
def psi_features(spark, sf):
    rows = feature_stage(spark, sf)
    early = F.col("alloc_date") < F.lit("2024-01-16").cast("date")
    out = mn.psi(rows.where(early), rows.where(~early), wo.bins_from_breaks({v: fx.BREAKS[v] for v in TOP3}))
    return out.withColumn("psi", F.round("psi", 6))


@query("psi_state", psi_sql({
    "total_score": (f"CAST(len(list_filter({SCORE_BREAKS}, lambda b: b <= total_score)) AS VARCHAR)", "scored"),
    **{v: (f"coalesce({v}, 'missing')", "scored") for v in TOP3[:2]},
    "id_age": ("CASE WHEN id_age IS NULL THEN 'missing' ELSE CAST(len(list_filter([18, 24, 31, 41, 50], lambda b: b <= id_age)) AS VARCHAR) END", "scored")}))
def psi_state(spark, sf):
    """PSI of score and features, read from the kept histograms against the frozen first half of the month."""
    bins = wo.bins_from_breaks({"total_score": SCORE_BREAKS, **{v: fx.BREAKS[v] for v in TOP3}})
    state = monitor_state(spark, sf, bins, F.col("alloc_date") < F.lit("2024-01-16").cast("date"))
    return state.stability(spark, F.col("dt") >= F.lit("2024-01-16").cast("date")).withColumn("psi", F.round("psi", 6))


KNOWN = {"channel_group": ["sdbao", "sdhz", "cf", "feed", "others"], "device_type": ["AUTOMOBILE", "BUILDING", "FURNITURE"],
         "wx_city_class": fx.CITY_CLASSES}


@query("new_categories", " UNION ALL ".join(
    f"SELECT '{v}' AS variable, {v} AS category, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM features) AS share FROM features "
    f"WHERE {v} NOT IN ({', '.join(repr(c) for c in cs)}) GROUP BY {v}" for v, cs in KNOWN.items()))
def new_categories(spark, sf):
    """Categories that a rule table of fewer labels does not cover."""
    return mn.new_categories(feature_stage(spark, sf), KNOWN)
