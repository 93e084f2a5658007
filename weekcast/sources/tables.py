"""Table access: a Parquet path per table, or a catalog table.

Every reader takes the column list it needs so the scan's ``ReadSchema`` is
pruned at the source; filters written afterwards are pushed into the scan by
Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None,
               fmt: str = "parquet") -> DataFrame:
    """Read one table of ``sf_dir``; ``fmt`` is the storage format of the path."""
    df = spark.read.format(fmt).load(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_catalog_table(spark: SparkSession, name: str, columns=None) -> DataFrame:
    df = spark.read.table(name)
    return df.select(*columns) if columns else df
