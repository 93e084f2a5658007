"""Deterministic sampling and splitting.

``randomSplit``/``sample`` draw per partition, so the same seed gives other
rows when the input is partitioned differently.  These operators decide per
row from its key instead, so results survive re-partitioning and task retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.functions.scalar import mix_bucket


def bernoulli(df: DataFrame, key_cols, per_mille: int, seed: int = 0) -> DataFrame:
    """Keep a row when its key's bucket in 0..999 is below ``per_mille``."""
    return df.filter(mix_bucket(key_cols, 1000, seed) < F.lit(per_mille))


def bucket_split_label(key, weights=(6, 2, 2), names=("train", "val", "test")):
    """Split label from ``key % 10`` against cumulative weights in tenths."""
    assert sum(weights) == 10
    bucket = F.pmod(F.col(key), F.lit(10))
    out, upper = None, 0
    for w, name in zip(weights[:-1], names[:-1]):
        upper += w
        out = F.when(bucket < upper, F.lit(name)) if out is None else out.when(bucket < upper, F.lit(name))
    return out.otherwise(F.lit(names[-1]))


def bucket_split(df: DataFrame, key: str, weights=(6, 2, 2)):
    """Three DataFrames (train, val, test) split by key bucket."""
    lab = bucket_split_label(key, weights)
    return tuple(df.filter(lab == F.lit(n)) for n in ("train", "val", "test"))


def pick_one_series(df: DataFrame, keys, order_col: str = "wk") -> DataFrame:
    """The series with the most rows, ties by the smallest key (one row).

    ``orderBy().limit(1)`` is a distributed top-1 (TakeOrdered), never empty
    when the input is not.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), *keys).limit(1).select(*keys)
