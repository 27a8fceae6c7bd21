"""Readers and writers, and what reaches the scan."""

import datetime as dt

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from leadwright.session import materialise, shared_dir
from leadwright.sources import roles, tables


@pytest.fixture()
def dated(spark, tmp_path):
    df = spark.range(300).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("dt"))
    return tables.write_dated(df, str(tmp_path / "dated"))


def test_partition_filters_reach_the_scan(spark, dated):
    df = spark.read.parquet(dated)
    for scan in (tables.snapshot_on(df, "2024-01-02"), tables.snapshot_before(df, "2024-01-03")):
        assert scan.count() == 100
        assert "PartitionFilters: [isnotnull(dt" in plan_text(scan)
    assert tables.increments(df, "2024-01-02", "2024-01-03").count() == 200


def test_only_written_days_are_replaced(spark, dated):
    tables.write_dated(spark.createDataFrame([(7, dt.date(2024, 1, 2))], "id bigint, dt date"), dated)
    counts = {r.dt.day: r["count"] for r in spark.read.parquet(dated).groupBy("dt").count().collect()}
    assert counts == {1: 100, 2: 1, 3: 100}


def test_csv_keeps_types_nulls_and_microseconds(spark, tmp_path):
    rows = [(1, "a,\"b\"", None, dt.datetime(2024, 1, 1, 2, 3, 4, 567891)), (2, None, 1.5, None)]
    df = spark.createDataFrame(rows, "id int, s string, x double, t timestamp_ntz")
    back = tables.read_csv(spark, tables.write_csv(df, str(tmp_path / "csv")), df.schema)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_with_wrong_types_fails(spark, tmp_path):
    path = tables.write_csv(spark.createDataFrame([("abc",)], "x string"), str(tmp_path / "bad"))
    with pytest.raises(Exception):
        tables.read_csv(spark, path, "x int").collect()


def test_second_delivery_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "ranked")
    for run, n in (("2024-01-30", 3), ("2024-01-31", 5), ("2024-01-31", 4)):
        tables.export_ranked(spark.range(n), path, run)
    counts = {str(r.run_date): r["count"] for r in spark.read.parquet(path).groupBy("run_date").count().collect()}
    assert counts == {"2024-01-30": 3, "2024-01-31": 4}


def test_stage_tables_lie_in_the_named_folder(spark):
    folder = shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") in folder
    stage = materialise(spark.range(10).withColumn("x", F.col("id") * 2), "ten")
    assert all(folder.removeprefix("file:") in f for f in stage.inputFiles())
    assert stage.select("x").agg(F.sum("x")).first()[0] == 90


def test_filters_and_columns_reach_the_parquet_scan(spark, small):
    text = plan_text(roles.role(spark, small, "policy_order").select("policy_no"))
    assert "EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_stage_tables_are_cleared_by_name(spark):
    from leadwright.session import clear_stages, materialise

    kept, gone = materialise(spark.range(3), "kept"), materialise(spark.range(3), "passing")
    clear_stages(spark, "passing-")
    assert kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FAILED_READ_FILE|not exist"):
        gone.collect()


def test_changes_between_deliveries(spark, tmp_path):
    schema = "user long, task long, score int"
    old = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (None, 3, 30), (4, 4, 40), (5, 5, 50)], schema)
    new = spark.createDataFrame([(1, 1, 10), (1, 2, 25), (None, 3, 31), (5, 5, 51), (6, 6, 60)], schema)
    found = lambda by: {(r["user"], r["task"], r["change"], r["before"], r["after"]) for r in tables.delivery_changes(
        old, new, ["user", "task"], "score", by).collect()}
    both = {(4, 4, "dropped", 40, None), (6, 6, "new", None, 60), (1, 2, "moved", 20, 25)}
    assert found(0) == both | {(None, 3, "moved", 30, 31), (5, 5, "moved", 50, 51)}
    assert found(1) == both


def test_repeated_delivery_changes_nothing(spark, tmp_path):
    path, changes = str(tmp_path / "ranked"), str(tmp_path / "changes")
    for day, n in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-02", 5), ("2024-01-01", 3)):
        tables.export_ranked(spark.range(n).withColumn("score", F.col("id") * n), path, day)
        before = tables.deliver_changes(path, changes, spark, day, ["id"], "score")
        assert before == (None if day == "2024-01-01" else "2024-01-01")
    got = {(str(r["run_date"]), r["id"], r["change"]) for r in spark.read.parquet(changes).collect()}
    first = {("2024-01-01", i, "new") for i in range(3)}
    assert got == first | {("2024-01-02", 1, "moved"), ("2024-01-02", 2, "moved"), ("2024-01-02", 3, "new"), ("2024-01-02", 4, "new")}


def test_extracted_events_give_the_same_roles(spark, small):
    """The JSON field is read once per event, whatever the number of roles and of its uses in a role."""
    events = materialise(roles.extracted_events(spark, small), "events")
    extracted, given = roles.load_roles(spark, small, events), roles.load_roles(spark, small)
    for name in roles.ROLES:
        assert extracted[name].dtypes == given[name].dtypes
        assert sorted(map(str, extracted[name].collect())) == sorted(map(str, given[name].collect())), name
        assert "get_json_object" not in plan_text(extracted[name])
