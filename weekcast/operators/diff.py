"""Compare two tables by their keys: signatures first, rows only where signatures differ.

A signature is a tree of buckets of the keys' hash.  A bucket's digest adds up the hashes of its rows, so it does
not depend on order, partitioning or retries, and it counts repeated rows.  Two signatures are walked from the
root: a level looks only below the buckets that differ on the level above.  The rows of the last level's
differing buckets are compared by key.  A signature can be stored with its table; a comparison with an unchanged
table then reads two short tables and no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.session import checkpoint

#: Children of a bucket as a power of two, and levels below the root (16 ** 4 = 65,536 leaves).
BITS, LEVELS = 4, 4

_SIGNED = "decimal(38,0)"


def _hashable(df: DataFrame, name: str):
    """A value's hash input.  Nested values are spelled as JSON with their nulls, since hashes skip nulls;
    entries of a map are put in order."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        col = F.array_sort(F.map_entries(col))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
    return col


def _hash(df: DataFrame, names, salt: int):
    """64-bit hash of some columns; a null is told from every value and every other place."""
    parts = [e for n in names for e in (_hashable(df, n), F.col(f"`{n}`").isNull())]
    return F.xxhash64(F.lit(salt), *parts)


def hashed(df: DataFrame, keys, values=None) -> DataFrame:
    """(_k0, _k1, ..., _leaf, _h1, _h2): a row's key, the leaf bucket of the key and two hashes of the whole row."""
    keys = list(keys)
    whole = keys + (list(values) if values is not None else [c for c in sorted(df.columns) if c not in keys])
    leaf = F.shiftrightunsigned(_hash(df, keys, 0), 64 - BITS * LEVELS)
    return df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], leaf.alias("_leaf"), _hash(df, whole, 1).alias("_h1"), _hash(df, whole, 2).alias("_h2"))


def _sums():
    return [F.sum("n").cast("bigint").alias("n"), F.sum("d1").cast(_SIGNED).alias("d1"), F.sum("d2").cast(_SIGNED).alias("d2")]


def _single(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"n": F.lit(1).cast("bigint"), "d1": F.col("_h1").cast("decimal(20,0)"), "d2": F.col("_h2").cast("decimal(20,0)")})


def signature(df: DataFrame, keys, values=None) -> DataFrame:
    """(level, bucket, n, d1, d2): the signature of a table, root at level 0.  Buckets without rows have no row.

    One scan and one aggregate with map-side sums; the levels above come from the leaves, of which there are at
    most 65,536 at any size.  An empty table has an empty signature.
    """
    leaves = checkpoint(_single(hashed(df, keys, values)).groupBy(F.col("_leaf").alias("bucket")).agg(*_sums()))
    out = None
    for level in range(LEVELS + 1):
        up = leaves.groupBy(F.shiftrightunsigned("bucket", BITS * (LEVELS - level)).alias("bucket")).agg(*_sums())
        one = up.select(F.lit(level).alias("level"), "bucket", "n", "d1", "d2")
        out = one if out is None else out.unionByName(one)
    return out


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(bucket): leaves in which two signatures differ, found level by level from the root.

    A level is looked at only below buckets that differ above; a level without any ends the search.
    """
    below = None
    for level in range(LEVELS + 1):
        sides = [s.where(F.col("level") == level).select("bucket", F.struct("n", "d1", "d2").alias(f"_{i}")) for i, s in enumerate((left, right))]
        if below is not None:
            parent = F.shiftrightunsigned("bucket", BITS).alias("_parent")
            sides = [s.select("*", parent).join(below.withColumnRenamed("bucket", "_parent"), "_parent", "left_semi").drop("_parent") for s in sides]
        both = sides[0].join(sides[1], "bucket", "full_outer")
        below = checkpoint(both.where(~F.col("_0").eqNullSafe(F.col("_1"))).select("bucket"))
        if level < LEVELS and below.isEmpty():
            break
    return below


def table_diff(left: DataFrame, right: DataFrame, keys, values=None, left_signature: DataFrame | None = None,
               right_signature: DataFrame | None = None) -> DataFrame:
    """Keys whose rows differ: (keys, change, n_left, n_right); ``change`` is added, removed or changed.

    ``values`` are the columns to compare besides the keys, all by default; both tables need them, in any
    order.  The columns' types must be the same on both sides; an extra or missing column is an error.  Rows of
    one key are compared as a multiset, so repeated rows count.  Null keys are keys like any other.  Only rows in
    buckets that differ are sent on, as sums per key made before the shuffle: a key that holds a third of all
    rows is one row per task.  Two equal tables, empty ones too, give no row.  A key must not be named like a
    column of the result.
    """
    keys = list(keys)
    named = [*keys, *(values or ())]
    if {"change", "n_left", "n_right"} & set(keys):
        raise ValueError("keys must not be named change, n_left or n_right")
    shapes = [{f.name: f.dataType for f in d.schema.fields if values is None or f.name in named} for d in (left, right)]
    if shapes[0] != shapes[1]:
        raise ValueError(f"tables differ in their columns: {sorted(set(shapes[0]) ^ set(shapes[1])) or 'types'}")
    a = left_signature if left_signature is not None else signature(left, keys, values)
    b = right_signature if right_signature is not None else signature(right, keys, values)
    where = differing(checkpoint(a), checkpoint(b)).withColumnRenamed("bucket", "_leaf")
    parts = [_single(hashed(d, keys, values).join(where, "_leaf", "left_semi")).withColumn("_side", F.lit(i)) for i, d in enumerate((left, right))]
    sums = []
    for i in (0, 1):
        at = F.col("_side") == i
        sums += [F.count(F.when(at, F.lit(1))).alias(f"n{i}"),
                 *[F.sum(F.when(at, F.col(c))).cast(_SIGNED).alias(f"{c}_{i}") for c in ("d1", "d2")]]
    per_key = parts[0].unionByName(parts[1]).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(*sums)
    change = F.when(F.col("n0") == 0, "added").when(F.col("n1") == 0, "removed").otherwise("changed")
    same = (F.col("n0") == F.col("n1")) & F.col("d1_0").eqNullSafe(F.col("d1_1")) & F.col("d2_0").eqNullSafe(F.col("d2_1"))
    return per_key.where(~same).select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], change.alias("change"), F.col("n0").alias("n_left"), F.col("n1").alias("n_right"))
