"""Session settings and the shared folder for stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Run-time settings every job relies on. AQE splits skewed join partitions even when the
# split costs one more exchange further up, because a chain of enrichment joins on one key
# is the normal shape of a feature build.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "leadwright", master: str | None = None, **conf) -> SparkSession:
    """Create a session; ``conf`` keys use underscores for dots (``spark_sql_shuffle_partitions=8``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings to a session made elsewhere."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for stage tables: the one named in ``spark.checkpoint.dir``; only where driver and executors are one
    process (master ``local`` or ``local[...]``) and nothing is named, a new one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="leadwright-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def clear_stages(spark: SparkSession, name: str = "") -> None:
    """Delete this session's stage tables whose name begins with ``name``; frames that read them are of no use then."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark), f"{name}*")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(folder):
        files.delete(found.getPath(), True)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a stage table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps Parquet column pruning for the readers.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
