"""Sinks: overwrite a path, register it as a table, metric files.

Paths come from the cluster's shared folder (``session.scratch_path``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_SCHEMA = "name string, value double"


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace those partitions of ``path`` that ``df`` has rows of; the others keep their files.  A
    partition is written in balanced pieces, however its rows are spread."""
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def register_external(spark: SparkSession, table: str, path: str, fmt: str = "PARQUET") -> None:
    """Replace a catalog table that points at ``path``."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")


def overwrite_table(df: DataFrame, table: str, bucket_by=None, buckets: int = 0, sort_by=None,
                    path: str | None = None) -> None:
    """Replace a catalog table; optionally bucketed (and sorted) by key.

    A series table bucketed by its series key is read back already
    hash-partitioned by that key, so every later series window or per-series
    aggregate on it runs without an exchange.
    """
    writer = df.write.mode("overwrite")
    if path:  # where the table's files go; the warehouse by default
        writer = writer.option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)


def build_or_reuse(spark: SparkSession, table: str, path: str, build, reset: bool = False) -> DataFrame:
    """Rebuild the table when asked or when it does not exist, else reuse it."""
    if reset or not spark.catalog.tableExists(table):
        overwrite_parquet(build(), path)
        register_external(spark, table, path)
    return spark.table(table)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """All metrics (name, value) in one CSV write.  Names must be quote-free:
    a bad one fails its write task, so the input is planned and run once."""
    bad = F.col("name").contains('"') | F.col("name").contains("'")
    name = F.when(bad, F.raise_error(F.lit("metric names must not contain quotes"))).otherwise(F.col("name"))
    metrics.select(name.alias("name"), "value").write.mode("overwrite").csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).csv(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, wherever it is stored."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
