"""Monitoring from a kept state: histograms of scores and features per day, updated day by day.

The state is two tables partitioned by day, ``scores`` (score, n, pos) and ``features`` (variable, bin, n), and beside them the frozen
distribution of the training rows (``expected``). An update replaces the days it holds and no others, so repeating one changes
nothing, and days whose labels have matured are simply updated again. AUC, KS and PSI are read from the state;
the scored leads are never read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators.evaluate import counted_auc_ks, score_counts
from leadwright.operators.monitor import bin_cells, stability
from leadwright.operators.woe import Bin
from leadwright.sources.tables import write_dated


@dataclass(frozen=True)
class MonitorState:
    folder: str
    bins: list[Bin]

    def _counted(self, rows: DataFrame, by: list[str]) -> DataFrame:
        cells = rows.select(*by, F.explode(bin_cells(self.bins)).alias("_c"))
        return cells.groupBy(*by, "_c.variable", "_c.bin").agg(F.count(F.lit(1)).alias("n"))

    def freeze(self, training: DataFrame) -> None:
        """Keep the training rows' distribution as the expected one."""
        self._counted(training, []).write.mode("overwrite").parquet(f"{self.folder}/expected")

    def update(self, scored: DataFrame, day: str, score: str, target: str) -> None:
        """Replace the days of ``scored`` in the state. A day must come whole; rows without a day are left out."""
        dated = scored.withColumn("dt", F.col(day).cast("date")).where(F.col("dt").isNotNull())
        write_dated(score_counts(dated, score, target, ["dt"]).withColumnRenamed(score, "score"), f"{self.folder}/scores")
        write_dated(self._counted(dated, ["dt"]), f"{self.folder}/features")

    def weekly_performance(self, spark: SparkSession) -> DataFrame:
        """AUC and KS per calendar week (starting Monday)."""
        week = F.date_trunc("week", "dt").cast("date")
        rows = spark.read.parquet(f"{self.folder}/scores").groupBy(week.alias("week"), "score").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        return counted_auc_ks(rows, "score", ["week"])

    def stability(self, spark: SparkSession, days: Column, ceiling: float = fx.PSI_CEILING) -> DataFrame:
        """PSI of the days chosen by a condition on ``dt`` against the frozen distribution."""
        actual = spark.read.parquet(f"{self.folder}/features").where(days).groupBy("variable", "bin").agg(F.sum("n").alias("n"))
        return stability(spark.read.parquet(f"{self.folder}/expected"), actual, ceiling)
