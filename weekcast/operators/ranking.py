"""Global row numbers without funnelling all rows through one task.

``row_number().over(Window.orderBy(...))`` puts every row in one partition.
Instead: range-partition and sort (distributed), count rows per partition
(one tiny row per partition), turn the counts into start offsets with a
window over that tiny table, and add each row's index inside its partition.
The index comes from ``monotonically_increasing_id``, whose lower 33 bits
are the record number inside the partition.

The sorted frame is checkpointed (reliably, to the cluster's checkpoint
folder) before it is read twice: range-partition boundaries come from a
sample seeded by the RDD id, so two independent evaluations of the sort could
split the rows differently, and the offsets would no longer fit the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.session import checkpoint

_LOW_BITS = 33


def global_row_number(df: DataFrame, order_cols, name: str = "row_id") -> DataFrame:
    """1-based rank of each row in ``order_cols`` order (ties in arbitrary order)."""
    ordered = checkpoint(df.orderBy(*order_cols))
    tagged = ordered.select("*", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mid"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # prefix sums over one row per partition (a few thousand rows at most)
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _LOW_BITS)
    # one row per partition of ``ordered``: bounded by the partition count
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + local + F.lit(1))
                  .drop("_pid", "_mid", "_off"))


def zip_by_rank(left: DataFrame, left_order, right: DataFrame, right_order) -> DataFrame:
    """Append the columns of ``right`` to ``left`` row by row in rank order.

    Inner join on the rank, so the result has min(len(left), len(right)) rows.
    """
    a = global_row_number(left, left_order, "_row")
    b = global_row_number(right, right_order, "_row")
    return a.join(b, "_row").drop("_row")
