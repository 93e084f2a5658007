"""Run log as a table: latest run per device, newest runs overall, and an
append-only writer for new runs (one distributed write, no calls from tasks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.session import checkpoint


def _device():
    return F.col("tags").getItem("device")


def with_device(log: DataFrame) -> DataFrame:
    return log.filter(_device().isNotNull()).withColumn("device", _device())


def latest_per_device(log: DataFrame) -> DataFrame:
    """Newest run of every device.  ``max_by`` aggregates partially, so a
    device owning a third of all runs is never sorted in one task."""
    newest = F.max_by(F.struct("run_id", "end_time", "metric"), F.struct("end_time", "run_id"))
    return (with_device(log).groupBy("device").agg(newest.alias("_r"))
                            .select("device", "_r.run_id", "_r.end_time", "_r.metric"))


def newest_runs(log: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by end time (distributed TakeOrdered), ties by run id."""
    return (with_device(log).orderBy(F.col("end_time").desc(), F.col("run_id").desc())
                            .limit(k).select("device", "run_id", "end_time"))


RUN_SCHEMA = ("run_id string, parent_run_id string, end_time timestamp_ntz, "
              "tags map<string,string>, params map<string,string>, metrics map<string,double>")
RUN_COLUMNS = ("run_id", "parent_run_id", "end_time", "tags", "params", "metrics")


def append_runs(runs: DataFrame, path: str) -> None:
    """Add finished runs in one distributed write; nothing is logged from
    inside tasks, so a retried task cannot log twice."""
    runs.select(*RUN_COLUMNS).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log with its declared schema (no inference pass)."""
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def _text_map(columns) -> F.Column:
    pairs = []
    for name, col in columns.items():
        pairs += [F.lit(name), col.cast("string")]
    return F.create_map(*pairs)


def device_runs(log: DataFrame) -> DataFrame:
    """A parent run per device: when its last child ended, how many there are."""
    by = with_device(log).groupBy("device").agg(F.max("end_time").alias("end_time"), F.count(F.lit(1)).alias("n"))
    return by.select(F.concat(F.lit("device-"), "device").alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"),
                     _text_map({"device": F.col("device")}).alias("tags"), _text_map({"children": F.col("n")}).alias("params"),
                     F.create_map(F.lit("n"), F.col("n").cast("double")).alias("metrics"))


def child_runs(log: DataFrame) -> DataFrame:
    """The log's own runs under their devices' parents; ids follow from parent and run."""
    rows = with_device(log)
    parent = F.concat(F.lit("device-"), F.col("device"))
    return rows.select(F.concat_ws("/", parent, F.col("run_id").cast("string")).alias("run_id"), parent.alias("parent_run_id"),
                       F.col("end_time").cast("timestamp_ntz").alias("end_time"), "tags",
                       _text_map({"run": F.col("run_id")}).alias("params"),
                       F.create_map(F.lit("metric"), F.col("metric")).alias("metrics"))


def trial_runs(trials: DataFrame, parent_run_id: str) -> DataFrame:
    """Run-log rows for a tuning result (stage, max_depth, num_trees, rmse).  The id is made of the
    parent's and the trial's parameters, so logging again gives the same ids."""
    return trials.select(
        F.concat_ws("/", F.lit(parent_run_id), "stage", F.concat(F.lit("depth-"), "max_depth"),
                    F.concat(F.lit("trees-"), "num_trees")).alias("run_id"),
        F.lit(parent_run_id).alias("parent_run_id"),
        F.localtimestamp().cast("timestamp_ntz").alias("end_time"),
        _text_map({"stage": F.col("stage")}).alias("tags"),
        _text_map({"maxDepth": F.col("max_depth"), "numTrees": F.col("num_trees")}).alias("params"),
        F.create_map(F.lit("rmse"), F.col("rmse")).alias("metrics"))


def children_by_parent(runs: DataFrame) -> DataFrame:
    """Nested runs read back: per parent, its declared number of children and what was logged under it."""
    kids = runs.filter(F.col("parent_run_id").isNotNull()).groupBy("parent_run_id").agg(
        F.count(F.lit(1)).alias("n_logged"), F.max("end_time").alias("last_end"),
        F.max(F.col("metrics")["metric"]).alias("best_metric"))
    parents = runs.filter(F.col("parent_run_id").isNull()).select(
        F.col("run_id").alias("parent_run_id"), F.col("params")["children"].cast("bigint").alias("n_declared"))
    return parents.join(kids, "parent_run_id", "left")


def run_tree(runs: DataFrame, run: str = "run_id", parent: str = "parent_run_id") -> DataFrame:
    """Every run with its root, how deep it lies below it and its number of children:
    (run_id, root_run_id, depth, n_children, status), for trees of any depth.

    A run without a parent, or whose parent is not in the log (``orphan``), is a root.  Each round a run
    hands its link to its ancestor's ancestor, so a chain of d runs takes about log2(d) rounds, and only runs that
    have not met their root are joined.  Runs on or below a loop have status ``cycle``, no root and no
    depth.  Repeated rows are one run; a run logged with two parents belongs to the smaller one; a null run id is left out.
    Rounds are checkpointed: a lost executor repeats one, and joins know their sizes, so that a run with a
    third of all runs below it is split by the adaptive plan.
    """
    own = checkpoint(runs.where(F.col(run).isNotNull()).groupBy(F.col(run).alias("run_id")).agg(F.min(parent).alias("up")))
    known = own.select(F.col("run_id").alias("up"), F.lit(True).alias("there"))
    kids = checkpoint(own.where("up is not null").groupBy("up").agg(F.count(F.lit(1)).alias("n_children")))
    links = checkpoint(own.join(known, "up", "left").select("run_id", "up", F.coalesce("there", F.lit(False)).alias("there")))
    at_root = F.col("there") == F.lit(False)
    done = links.where(at_root).select("run_id", F.col("run_id").alias("root_run_id"), F.lit(0).cast("bigint").alias("depth"),
                                       F.when(F.col("up").isNull(), "root").otherwise("orphan").alias("status"))
    done = checkpoint(done)
    open_ = checkpoint(links.where("there").select("run_id", "up", F.lit(1).cast("bigint").alias("depth")))
    rounds, limit = 0, links.count().bit_length() + 1
    while rounds < limit and open_.limit(1).count():
        # an ancestor that is a root ends the search; any other one hands on its own ancestor
        roots = done.select(F.col("run_id").alias("up"), F.col("root_run_id").alias("top"), F.col("depth").alias("above"))
        met = checkpoint(open_.join(roots, "up", "left"))
        done = checkpoint(done.unionByName(met.where("top is not null").select(
            "run_id", F.col("top").alias("root_run_id"), (F.col("depth") + F.col("above")).alias("depth"), F.lit("nested").alias("status"))))
        left = met.where("top is null").select("run_id", "up", "depth")
        hop = open_.select(F.col("run_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("above"))
        open_ = checkpoint(left.join(hop, "up").select("run_id", F.col("next").alias("up"), (F.col("depth") + F.col("above")).alias("depth")))
        rounds += 1
    loops = open_.select("run_id", F.lit(None).cast(done.schema["root_run_id"].dataType).alias("root_run_id"),
                         F.lit(None).cast("bigint").alias("depth"), F.lit("cycle").alias("status"))
    return done.unionByName(loops).join(kids.withColumnRenamed("up", "run_id"), "run_id", "left").select(
        "run_id", "root_run_id", "depth", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "status")


def nested(log: DataFrame, width: int = 8) -> DataFrame:
    """The log as nested runs: a run lies below the run whose id is its own divided by ``width``; runs
    without a device tag (failed ones) are not in the log, so what lies below them is orphaned."""
    own = F.col("run_id")
    return with_device(log).select("run_id", F.when(own > 0, F.floor(own / width).cast("bigint")).alias("parent_run_id"))
