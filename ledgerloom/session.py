"""Session defaults and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "ledgerloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written by a job, in the application's own part of the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/ledgerloom/{application}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder, by the file system it is in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's tables in the shared folder; for jobs, once their results are written."""
    delete_path(spark, f"{shared_dir(spark).rstrip('/')}/ledgerloom/{spark.sparkContext.applicationId}")


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside lose their shuffle files at their end, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written_table(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back, which cuts the lineage.

    Lost executors then neither change nor lose the rows. ``codec`` is another than the session's, for tables of many wide rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
