"""Stamped copies: a build names a rule per source, and the copies are resolved from the run date before any plan is made.

A stamped table is a folder with one sub-folder ``dt=<day>`` per full copy or daily increment. The stamps are read off the folder
names, so resolving costs one listing per table and no job; only the folders chosen are handed to the reader, so a plan over a
table of a thousand copies lists and scans one.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Day = datetime.date


def _day(text: str | Day) -> Day:
    return text if isinstance(text, Day) else Day.fromisoformat(text)


@dataclass(frozen=True)
class Rule:
    """Which stamps a build reads: ``choose`` takes the run date and all stamps, ``says`` tells the rule in words."""

    says: str
    choose: Callable[[Day, list[Day]], list[Day]] = field(compare=False)


def rolling(days_back: int = 1, late: int = 0) -> Rule:
    """The copy of ``days_back`` days before the run; where it is late, the newest of the ``late`` days before it."""
    def choose(run: Day, stamps: list[Day]) -> list[Day]:
        wanted = run - datetime.timedelta(days=days_back)
        able = [s for s in stamps if wanted - datetime.timedelta(days=late) <= s <= wanted]
        return able[-1:]
    return Rule(f"copy of {days_back} days before the run, up to {late} days older", choose)


def fixed(stamp: str) -> Rule:
    """The copy stamped with one named day, whatever the run date."""
    return Rule(f"copy of {stamp}", lambda run, stamps: [s for s in stamps if s == _day(stamp)])


def between(start: str, end: str) -> Rule:
    """The daily increments from ``start`` to ``end``, both included; days without one add nothing."""
    return Rule(f"increments {start} to {end}", lambda run, stamps: [s for s in stamps if _day(start) <= s <= _day(end)])


def stamps_of(spark: SparkSession, path: str, dt: str = "dt") -> list[Day]:
    """The stamps of a table, oldest first: the sub-folders that hold at least one file of data."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith(f"{dt}="):
            if any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(entry.getPath())):
                out.append(_day(name.removeprefix(f"{dt}=")))
    return sorted(out)


@dataclass(frozen=True)
class Catalogue:
    """Where each role lies and by which rule it is read; roles without a rule have no stamps and are read whole."""

    paths: dict[str, str]
    rules: dict[str, Rule]

    def resolve(self, spark: SparkSession, run_date: str) -> dict[str, list[Day]]:
        """The stamps each ruled role is read from. A role without any is an error, but for increments."""
        found = {}
        for role, rule in self.rules.items():
            stamps = stamps_of(spark, self.paths[role])
            found[role] = rule.choose(_day(run_date), stamps)
            if not found[role] and not rule.says.startswith("increments"):
                raise LookupError(f"{role}: no {rule.says} for the run of {run_date}; newest is {max(stamps, default=None)}")
        return found

    def open(self, spark: SparkSession, run_date: str) -> dict[str, DataFrame]:
        """All roles for one run. Every stamp is resolved first, so a missing copy stops the run before it starts."""
        chosen = self.resolve(spark, run_date)
        return {role: open_stamps(spark, path, chosen[role]) if role in chosen else spark.read.parquet(path)
                for role, path in self.paths.items()}


def open_stamps(spark: SparkSession, path: str, stamps: list[Day], dt: str = "dt") -> DataFrame:
    """The copies with these stamps, from their folders alone."""
    if not stamps:
        return spark.read.parquet(path).limit(0)
    return spark.read.option("basePath", path).parquet(*[f"{path}/{dt}={s.isoformat()}" for s in stamps])


def write_copy(rows: DataFrame, path: str, stamp: str, dt: str = "dt") -> None:
    """Write one full copy; a repeated run replaces only its own copy."""
    rows.drop(dt).write.mode("overwrite").parquet(f"{path}/{dt}={_day(stamp).isoformat()}")


def write_copies(rows: DataFrame, known: Column, path: str, stamps: list[str], dt: str = "dt") -> None:
    """Write the full copies of several days in one pass: every row goes into each copy from its day ``known`` on. Replaces what lay there; a day
    before all rows gets an empty copy."""
    days = F.array(*[F.lit(_day(s)) for s in stamps])
    copies = rows.withColumn(dt, F.explode(F.filter(days, lambda day: known <= day)))
    copies.write.mode("overwrite").partitionBy(dt).parquet(path)
    written = stamps_of(rows.sparkSession, path, dt)
    for stamp in stamps:
        if _day(stamp) not in written:
            write_copy(rows.limit(0), path, stamp, dt)


def copies_read(sources: dict[str, DataFrame], chosen: dict[str, list[Day]]) -> DataFrame:
    """role, stamp and rows of every copy a run reads."""
    counted = None
    for role, stamps in chosen.items():
        rows = sources[role].groupBy(F.lit(role).alias("role"), F.col("dt").alias("stamp")).agg(F.count(F.lit(1)).alias("rows"))
        counted = rows if counted is None else counted.unionByName(rows)
    return counted
