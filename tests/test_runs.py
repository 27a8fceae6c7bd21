"""A broken run goes on where it stopped, and never reads what is half written."""

import os

import pytest
from pyspark.sql import functions as F

from leadwright.plans import features as ft
from leadwright.plans.registry import SPAN, TIERS
from leadwright.plans.runs import Stage, run_stages, sweep
from leadwright.sources import roles


class Power(Exception):
    pass


def stages(log, broken=None, version="1"):
    def build(name, make):
        def run(src, parameters):
            if name == broken:
                raise Power
            log.append(name)
            return make(src, parameters)
        return run

    return [
        Stage("one", ("rows",), build("one", lambda src, p: src["rows"].where(F.col("id") < p["n"]))),
        Stage("two", ("one",), build("two", lambda src, p: src["one"].withColumn("double", F.col("id") * 2)), version),
        Stage("three", ("one", "two"), build("three", lambda src, p: src["two"].join(src["one"], "id"))),
    ]


@pytest.fixture
def rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20).write.parquet(path)
    return path


def test_broken_run_resumes(spark, rows, tmp_path):
    folder, source = str(tmp_path / "run"), lambda: {"rows": spark.read.parquet(rows)}
    log = []
    with pytest.raises(Power):
        run_stages(spark, folder, stages(log, "three"), source(), {"n": 10})
    assert log == ["one", "two"]
    done = run_stages(spark, folder, stages(log), source(), {"n": 10})
    assert log == ["one", "two", "three"] and done["three"].count() == 10
    run_stages(spark, folder, stages(log), source(), {"n": 10})
    assert log == ["one", "two", "three"]
    clean = run_stages(spark, str(tmp_path / "clean"), stages([]), source(), {"n": 10})
    assert sorted(clean["three"].collect()) == sorted(done["three"].collect())


def test_change_of_version_parameter_or_input_rebuilds_what_follows(spark, rows, tmp_path):
    folder, source = str(tmp_path / "run"), lambda: {"rows": spark.read.parquet(rows)}
    run_stages(spark, folder, stages([]), source(), {"n": 10})
    log = []
    run_stages(spark, folder, stages(log, version="2"), source(), {"n": 10})
    assert log == ["two", "three"]
    log.clear()
    assert run_stages(spark, folder, stages(log, version="2"), source(), {"n": 5})["three"].count() == 5
    assert log == ["one", "two", "three"]
    log.clear()
    spark.range(3).write.mode("append").parquet(rows)
    assert run_stages(spark, folder, stages(log, version="2"), source(), {"n": 5})["one"].count() == 8
    assert log == ["one", "two", "three"]


def test_half_written_result_is_not_read(spark, rows, tmp_path):
    folder, source = str(tmp_path / "run"), lambda: {"rows": spark.read.parquet(rows)}
    run_stages(spark, folder, stages([]), source(), {"n": 10})
    data = [n for n in os.listdir(folder) if n.startswith("two-")][0]
    os.remove(f"{folder}/{data}/_SUCCESS")  # as after a crash of the committer
    log = []
    run_stages(spark, folder, stages(log), source(), {"n": 10})
    assert log == ["two"]  # its inputs are the same, so what follows still holds
    with open(f"{folder}/two.json", "w") as f:
        f.write('{"fingerp')
    run_stages(spark, folder, stages(log), source(), {"n": 10})
    assert log == ["two", "two"]
    os.makedirs(f"{folder}/three-left-by-a-crash")
    gone = sweep(spark, folder)
    assert "three-left-by-a-crash" in gone and data in gone
    assert run_stages(spark, folder, stages([]), source(), {"n": 10})["three"].count() == 10


def test_unknown_input(spark, tmp_path):
    with pytest.raises(KeyError, match="nothing"):
        run_stages(spark, str(tmp_path / "run"), [Stage("a", ("b",), lambda s, p: s["b"])], {}, {})


def test_feature_build_broken_after_each_stage(spark, small, tmp_path):
    src = roles.load_roles(spark, small)
    whole = ft.feature_stages(SPAN, TIERS)
    folder = str(tmp_path / "run")
    for k in range(1, len(whole)):
        broken = [s if i < k else Stage(s.name, s.reads, lambda *_: (_ for _ in ()).throw(Power())) for i, s in enumerate(whole)]
        with pytest.raises(Power):
            run_stages(spark, folder, broken, src, {"run": "x"})
    got = run_stages(spark, folder, whole, src, {"run": "x"})["features"]
    assert len([n for n in os.listdir(folder) if n.startswith("lead_base-")]) == 1
    want = ft.feature_table(src, SPAN, TIERS)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
