"""Spark session settings for the sales cube jobs.

On a cluster the session is created by the platform; ``configure`` only sets
the SQL options the jobs rely on (UTC dates, AQE) and leaves resource settings
alone. ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Options every job in this package assumes.
SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # a value that doesn't fit its contract raises
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillroll", scratch: str | None = None,
                  event_log: str | None = None) -> SparkSession:
    """A local session with the UI off and the scratch dirs under ``scratch``;
    ``event_log`` names a folder for Spark's event log (stage and task times)."""
    scratch = scratch or tempfile.mkdtemp(prefix="tillroll-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # many distinct plans in one session: keep their generated code
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true") \
            .config("spark.eventLog.dir", event_log)
    for key, value in SQL_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's ``spark.checkpoint.dir``; set ``fallback`` only when unset."""
    current = checkpoint_dir(spark)
    if current:
        return current
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which all executors share.
    A local session without that setting gets a temporary folder; elsewhere its absence
    raises, since a folder of the driver's machine is no use to other hosts."""
    current = checkpoint_dir(spark)
    if not current:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tillroll-"))
    return f"{current.rstrip('/')}/tillroll/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    It cuts the lineage (a lost executor only repeats its own tasks), and the planner knows
    the size of what comes next. Each call has a folder of its own; ``remove_stored`` removes
    them when the results that read them have been written.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, location: str):
    """(Hadoop's file system of a location, its path)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_stored(spark: SparkSession, folder: str | None = None) -> None:
    """Remove ``folder``, by default all stored tables of this application."""
    fs, path = file_system(spark, folder or shared_folder(spark))
    fs.delete(path, True)
