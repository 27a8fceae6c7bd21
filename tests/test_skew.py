"""One user holds a third of all events: same results, and the work is really split."""

import shutil

import pytest
from pyspark.sql import functions as F

from compare import duck, duck_rows, spark_rows
from leadwright.operators import temporal as tp
from leadwright.plans import catalog

HOT = [
    "asof_visit_cf", "asof_visit_hz", "asof_visit_cf_reference", "events_before_alloc", "shortview_features", "call_sequence",
    "label_base", "final_feature_table", "final_feature_table_reference", "daily_scoring", "join_task_policy", "first_clue_channel",
]


@pytest.fixture(scope="module")
def hot_dir(spark, small, tmp_path_factory):
    """The given tables, with every third event moved to user 0."""
    folder = tmp_path_factory.mktemp("hot")
    for name in ("customer", "orders"):
        shutil.copy(f"{small}/{name}.parquet", folder / f"{name}.parquet")
    con = duck(small)
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)
                    TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", HOT)
def test_hot_user_gives_the_same_rows(spark, hot_dir, name):
    columns, rows = spark_rows(catalog.QUERIES[name](spark, hot_dir))
    want_columns, want = duck_rows(duck(hot_dir), catalog.ORACLES[name])
    assert columns == want_columns and rows == want


def test_hot_task_join_is_split(spark):
    """AQE splits the partition of a task that holds most orders, although an aggregation on the task follows."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        leads = spark.range(200).select(F.col("id").alias("task_id"), F.lit("2024-01-10").cast("date").alias("alloc_date"))
        orders = spark.range(0, 40000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("task_id"),
            F.concat(F.lit("P"), F.col("id")).alias("policy_no"), F.lit("2024-01-12 00:00:00").cast("timestamp_ntz").alias("policy_time"),
            F.lit(1.0).alias("origin"))
        labels = tp.conversion_labels(leads, orders, "task_id", "alloc_date", "policy_time", "policy_no", "origin", [7, 14])
        counts = {r.task_id: r.t14_policy_cnt for r in labels.collect()}
        assert sum(counts.values()) == 40000 and counts[7] > 13000
        labels.collect()
        assert "skew=true" in labels._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
