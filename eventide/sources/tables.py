"""The driver's parquet tables. Reads project only the needed columns so
the scan's ReadSchema stays narrow; filters placed after the read are
pushed into the parquet scan by Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``events`` with ``ts`` as an instant (``TIMESTAMP``, UTC)."""
    use_utc(spark)
    df = table(spark, sf_dir, "events", *columns)
    if "ts" in df.columns:
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df
