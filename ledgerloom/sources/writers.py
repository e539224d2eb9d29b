"""Writers: conform, create, append, overwrite by partition, versions, audit, JSON text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns, in its order and types; a missing one becomes a typed NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Write a new parquet table (fails if it exists) and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_select(df: DataFrame, path: str, target: T.StructType) -> DataFrame:
    """Append rows conformed to the target."""
    conform(df, target).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(target).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``.

    Rows are rebalanced by the partition columns, so a hot partition is written by several
    tasks and small ones are merged, instead of a fixed number of files.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def publish_if_any(stage: DataFrame, publish: Callable[[DataFrame], None]) -> bool:
    """Run ``publish`` only when the stage holds a row."""
    if stage.isEmpty():
        return False
    publish(stage)
    return True


def write_version(df: DataFrame, root: str, version: int) -> None:
    """Write one immutable version of a table."""
    df.write.mode("errorifexists").parquet(f"{root}/v={version}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Read a pinned version; later versions are not seen."""
    return spark.read.parquet(f"{root}/v={version}")


def append_with_audit(df: DataFrame, path: str, audit_path: str, load_id: str) -> DataFrame:
    """Append and record the number of rows, counted while they are written."""
    seen = Observation(f"load-{load_id}")
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("append").parquet(path)
    spark = df.sparkSession
    record = spark.range(1).select(
        F.lit(load_id).alias("load_id"), F.lit(path).alias("path"), F.lit(seen.get["n_rows"]).cast("bigint").alias("n_rows")
    )
    record.write.mode("append").parquet(audit_path)
    return spark.read.schema(record.schema).parquet(audit_path)


def rows_to_json(df: DataFrame, columns: Sequence[str], fragments: Sequence[str] = (), out: str = "doc") -> DataFrame:
    """One JSON object per row; columns in ``fragments`` hold JSON already and are not escaped again."""
    fields = [F.parse_json(F.col(c)).alias(c) if c in fragments else F.col(c) for c in columns]
    return df.select(*df.columns, F.to_json(F.struct(*fields)).alias(out))
