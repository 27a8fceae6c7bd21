"""Readers and writers: dated snapshots and increments, CSV extracts, stage tables, deliveries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def day(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def snapshot_on(df: DataFrame, stamp: str, dt: str = "dt") -> DataFrame:
    """The full copy stamped with one day: an equality on the partition column, so other days are not read."""
    return df.where(F.col(dt) == day(stamp))


def snapshot_before(df: DataFrame, as_of: str, dt: str = "dt") -> DataFrame:
    """Yesterday's full copy, seen from the run date ``as_of``."""
    return df.where(F.col(dt) == F.date_sub(day(as_of), 1))


def increments(df: DataFrame, start: str, end: str, dt: str = "dt") -> DataFrame:
    """Daily increments from ``start`` to ``end``, both included."""
    return df.where(F.col(dt).between(day(start), day(end)))


def write_dated(df: DataFrame, path: str, dt: str = "dt") -> str:
    """Write a table partitioned by day; only the days present in ``df`` are replaced."""
    # The hint groups each day's rows into files of sensible size and splits a heavy day.
    (df.hint("rebalance", dt).write.mode("overwrite").partitionBy(dt)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


# CSV text keeps microseconds; the default format would cut them to milliseconds.
CSV_OPTIONS = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema: inferring types costs a pass and mistakes all-NULL columns."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, mode="FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def export_rules(rules: DataFrame, path: str) -> str:
    """Rule table as one CSV file; it has a few rows per variable, so one file is enough. Categories are a JSON list."""
    flat = rules.select("variable", "bin_id", "bin", "kind", "lo", "hi", F.to_json("categories").alias("categories"), "points")
    write_csv(flat.coalesce(1), path)
    return path


RULE_CSV = "variable string, bin_id int, bin string, kind string, lo double, hi double, categories string, points int"


def import_rules(spark: SparkSession, path: str) -> DataFrame:
    flat = read_csv(spark, path, RULE_CSV)
    return flat.withColumn("categories", F.from_json("categories", "array<string>"))


def export_ranked(ranked: DataFrame, path: str, run_date: str) -> str:
    """Deliver the ranked leads of one run; a repeated run replaces only its own day."""
    dated = ranked.withColumn("run_date", day(run_date))
    (dated.write.mode("overwrite").partitionBy("run_date")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


def delivery_changes(before: DataFrame, after: DataFrame, keys: list[str], value: str, by: float = 0) -> DataFrame:
    """What changed between two deliveries, by lead key: ``new``, ``dropped`` or ``moved`` leads with ``value`` before and after.

    A lead has moved when its value differs by more than ``by``; leads that stay as they were are left out. Keys are compared with
    NULL as a value like any other; a key must be unique in each delivery.
    """
    old = before.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("before"), F.lit(1).alias("_old"))
    new = after.select(*keys, F.col(value).alias("after"), F.lit(1).alias("_new"))
    same = reduce(lambda a, b: a & b, [new[k].eqNullSafe(old[f"_{k}"]) for k in keys])
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "dropped").when(
        F.abs(F.col("after") - F.col("before")) > by, "moved")
    return new.join(old, same, "full_outer").select(
        *[F.when(F.col("_new").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys], change.alias("change"), "before", "after",
    ).where(F.col("change").isNotNull())


def deliver_changes(path: str, changes_path: str, spark: SparkSession, run_date: str, keys: list[str], value: str) -> str | None:
    """Write the changes of a run against the delivery before it, and return that run's date (None: there is none, all leads are new).

    The changes carry the run date as their key and replace only their own, so a repeated delivery is harmless.
    """
    deliveries = spark.read.parquet(path)
    earlier = deliveries.where(F.col("run_date") < day(run_date)).agg(F.max("run_date")).first()[0]
    own = deliveries.where(F.col("run_date") == day(run_date)).drop("run_date")
    last = deliveries.where(F.col("run_date") == F.lit(earlier)).drop("run_date") if earlier else own.limit(0)
    changes = delivery_changes(last, own, keys, value).withColumn("run_date", day(run_date))
    changes.write.mode("overwrite").partitionBy("run_date").option("partitionOverwriteMode", "dynamic").parquet(changes_path)
    return str(earlier) if earlier else None
