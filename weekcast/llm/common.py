"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.session import scratch_path, ship_package

#: ASCII letters, the only ones that the word contracts lower-case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space that separates words.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a batch that a worker holds as Python texts at once.
SLICE = 256


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, gap: str = GAP) -> Column:
    """Words of a text in order; null and empty texts have none."""
    return F.coalesce(F.array_remove(F.split(text, gap), ""), F.array().cast("array<string>"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back: cuts the lineage, survives a lost
    executor, and gives later joins a measured size to choose a broadcast by."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, f"llm-{name}", unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def one_row(df: DataFrame):
    """The only row of a global aggregate."""
    return df.first()


def sliced(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """A batch in views of ``rows`` rows: a worker's memory then holds the batch and one view's texts."""
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that never cut a group of equal keys, with the row number where each group starts.

    Input is sorted by ``keys`` (non-null longs) inside the partition; only the last group of a
    batch waits for the next one, so memory holds one batch and one group.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        rest = now if rest is None else pa.concat_tables([rest, now])
        starts = _starts(rest, keys)
        if len(starts) > 1:
            cut = int(starts[-1])
            yield rest.slice(0, cut).combine_chunks(), starts[:-1]
            rest = rest.slice(cut)
    if rest is not None:
        yield rest.combine_chunks(), _starts(rest, keys)


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in keys:
        v = rows.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)
