"""Data checks as ordinary DataFrames (one row per check)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_row(name: str, expected: Column, actual: Column, source: DataFrame) -> DataFrame:
    """One check row from a one-row aggregate ``source``."""
    return source.select(F.lit(name).alias("check_name"), expected.cast("bigint").alias("expected"),
                         actual.cast("bigint").alias("actual")) \
                 .withColumn("ok", F.col("expected") == F.col("actual"))


def schema_rows(df: DataFrame, name: str, expected: T.StructType) -> DataFrame:
    """One row per expected column of a table: type found (null if missing),
    whether it is the expected one, and how many values the rows hold.  One
    aggregate over the table."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    one = df.agg(*[(F.count(f.name) if f.name in have else F.lit(0).cast("bigint")).alias(f.name) for f in expected.fields])
    rows = [F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("expected"), F.lit(have.get(f.name)).cast("string").alias("actual"),
                     F.lit(have.get(f.name) == f.dataType.simpleString()).alias("ok"), F.col(f.name).alias("n_values"))
            for f in expected.fields]
    return one.select(F.inline(F.array(*rows)))


def compose_schema(*parts) -> T.StructType:
    """Concatenate StructTypes / lists of StructFields into one schema."""
    fields = []
    for p in parts:
        fields.extend(p.fields if isinstance(p, T.StructType) else p)
    return T.StructType(fields)
