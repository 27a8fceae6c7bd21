"""Copies are resolved from the run date, read alone, and give the result of single copies."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from leadwright.plans import features as ft
from leadwright.plans.registry import SPAN, TIERS
from leadwright.sources import roles, snapshots

D = datetime.date


@pytest.fixture(scope="module")
def store(spark, small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("store"))
    return snapshots.Catalogue(roles.write_store(spark, small, folder), ft.source_rules(SPAN))


def test_rules():
    days = [D(2024, 1, d) for d in (1, 2, 3, 5)]
    pick = lambda rule, run: rule.choose(D.fromisoformat(run), days)
    assert pick(snapshots.rolling(), "2024-01-04") == [D(2024, 1, 3)]
    assert pick(snapshots.rolling(), "2024-01-05") == []
    assert pick(snapshots.rolling(late=1), "2024-01-05") == [D(2024, 1, 3)]
    assert pick(snapshots.rolling(late=1), "2024-01-06") == [D(2024, 1, 5)]
    assert pick(snapshots.fixed("2024-01-02"), "2030-01-01") == [D(2024, 1, 2)]
    assert pick(snapshots.fixed("2024-01-04"), "2030-01-01") == []
    assert pick(snapshots.between("2024-01-02", "2024-01-04"), "2030-01-01") == days[1:3]


def test_stamps_count_only_folders_with_data(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_copy(spark.range(3).withColumn("dt", F.lit("x")), path, "2024-01-02")
    snapshots.write_copy(spark.range(2), path, "2024-01-03")
    (tmp_path / "t" / "dt=2024-01-04").mkdir()
    (tmp_path / "t" / "dt=2024-01-04" / "_temporary").mkdir()
    (tmp_path / "t" / "other").mkdir()
    assert snapshots.stamps_of(spark, path) == [D(2024, 1, 2), D(2024, 1, 3)]
    snapshots.write_copy(spark.range(7), path, "2024-01-03")
    rows = snapshots.open_stamps(spark, path, [D(2024, 1, 3)])
    assert rows.count() == 7 and rows.select("dt").distinct().first()[0] == D(2024, 1, 3)
    assert snapshots.open_stamps(spark, path, []).count() == 0


def test_missing_copy_stops_the_run_at_once(spark, store):
    with pytest.raises(LookupError, match="crm_task"):
        store.resolve(spark, "2025-01-01")
    with pytest.raises(LookupError, match="clue"):
        snapshots.Catalogue(store.paths, ft.source_rules(SPAN, late=0)).resolve(spark, "2024-01-31")


def test_one_copy_per_role_is_read(spark, store):
    chosen = store.resolve(spark, "2024-01-31")
    assert chosen["crm_task"] == [D(2024, 1, 30)] and chosen["clue"] == [D(2024, 1, 29)]
    for role, df in store.open(spark, "2024-01-31").items():
        read = {f.rsplit("/dt=", 1)[1][:10] for f in df.inputFiles() if "/dt=" in f}
        if role in roles.copied_roles():
            assert read == {chosen[role][0].isoformat()}, role
            assert "dt=" + chosen[role][0].isoformat() in plan_text(df) or "1 paths" in plan_text(df)


def test_stamped_copies_give_the_result_of_single_copies(spark, small, store):
    got = ft.feature_table_of(spark, store, SPAN, "2024-01-31", TIERS)
    cut = {}
    for role, df in roles.load_roles(spark, small).items():
        if role in roles.copied_roles():
            stamp = "2024-01-29" if role == "clue" else "2024-01-30"
            known = F.expr("date_add(date '2023-12-25', cast(user_id % 40 as int))") if role in ("user_ua", "user_tag") else F.col("dt")
            df = df.where(known <= F.lit(stamp).cast("date"))
        cut[role] = df
    want = ft.feature_table(cut, SPAN, TIERS)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0


def test_copies_of_several_days_are_written_in_one_pass(spark, tmp_path):
    """Each copy holds the rows up to its day, a day before all rows has an empty copy, and the rows are read once."""
    rows = spark.range(100).select("id", F.expr("date_add(date '2024-01-02', int(id % 5))").alias("dt"), F.col("id").alias("v"))
    read = spark.sparkContext.accumulator(0)
    seen = rows.rdd.map(lambda r: (read.add(1), (r.id, r.dt, r.v))[1]).toDF(rows.schema)
    path, days = str(tmp_path / "t"), ["2024-01-01", "2024-01-03", "2024-01-06"]
    snapshots.write_copies(seen, F.col("dt"), path, days)
    assert read.value == 100 and snapshots.stamps_of(spark, path) == [D.fromisoformat(d) for d in days]
    for day, want in zip(days, (0, 40, 100)):
        copy = snapshots.open_stamps(spark, path, [D.fromisoformat(day)])
        assert copy.columns == ["id", "v", "dt"] and copy.where(F.col("dt") == day).count() == want
