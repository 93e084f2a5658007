"""Tune random forests over one indexed feature frame.

Rows are split by key bucket (60/20/20, stable under re-partitioning).  The
roles of the columns come from the schema.  Labels are indexed and features
assembled once, from the train rows; the indexed frames are what every
candidate forest is fitted and scored on, so a trial costs its forest alone.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.operators.ranking import global_row_number
from weekcast.operators.sampling import bucket_split, bucket_split_label
from weekcast.session import checkpoint, scratch_path
from weekcast.sources.sinks import remove_path

LABEL = "price"
KEY = "p_partkey"
# Search space: max depth 2..5, number of trees 10..100 (4 evaluations).
TRIALS = ((2, 10), (3, 40), (4, 70), (5, 100))
# Fixed value: bins per feature.  More are used where a column has more labels.
BINS = 40
SEED = 42
# Depth of the one-tree forest that is read as a table, and bins enough for every distinct size.
TABLE_DEPTH, TABLE_BINS = 3, 64
# Rows that one task bags and scans at most: with 100 trees about 450 bytes each are held between the levels.
TASK_ROWS = 50_000
# Train rows that fits running side by side hold in all; more than that fill a cluster one fit at a time.
FIT_ROWS = 3_000_000


def dealt(rows: DataFrame, task_rows: int | None = None) -> DataFrame:
    """The rows in partitions of about ``task_rows``, by a hash of the whole row and sorted inside.

    A forest bags its rows by partition and holds a count per row and tree, and a small file is one partition
    however many rows it has.  Dealt by the rows alone, the same rows give the same forest from any files.
    Rows that one task may hold stay as they are.
    """
    parts = -(-rows.count() // (task_rows or TASK_ROWS))
    return rows if parts < 2 else rows.repartition(parts, *rows.columns).sortWithinPartitions(*rows.columns)


class FeatureStep:
    """Label indexing and assembly, fitted once on the train rows."""

    def __init__(self, train: DataFrame, key: str = KEY, target: str = LABEL):
        self.key, self.target = key, target
        roles = {f.name: f.dataType for f in train.schema.fields if f.name not in (key, target)}
        self.labels = [n for n, t in roles.items() if isinstance(t, T.StringType)]
        self.numbers = [n for n, t in roles.items() if isinstance(t, T.DoubleType)]
        self.codes = [f"{n}_code" for n in self.labels]
        steps = []
        if self.labels:  # rows with a label that train has not seen are skipped
            steps.append(StringIndexer(inputCols=self.labels, outputCols=self.codes, handleInvalid="skip"))
        steps.append(VectorAssembler(inputCols=self.codes + self.numbers, outputCol="features"))
        self.model = Pipeline(stages=steps).fit(train)

    def label_lists(self) -> list[list[str]]:
        return [list(x) for x in self.model.stages[0].labelsArray] if self.labels else []

    def bins(self) -> int:
        return max([BINS, *(len(x) for x in self.label_lists())])

    def indexed(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows).select(self.key, *self.codes, "features", self.target)

    def fittable(self, rows: DataFrame) -> DataFrame:
        """Indexed rows, dealt so that every task of a fit has a bounded share."""
        return self.indexed(dealt(rows))

    def forest(self, depth: int = 5, trees: int = 20) -> RandomForestRegressor:
        """Each row's node per tree is kept from level to level: walked from the root again, it costs most of a fit."""
        return RandomForestRegressor(featuresCol="features", labelCol=self.target, maxBins=self.bins(),
                                     maxDepth=depth, numTrees=trees, seed=SEED, cacheNodeIds=True)

    def with_forest(self, forest) -> PipelineModel:
        """One model from raw rows to predictions, to be saved and loaded as a whole."""
        return PipelineModel(stages=[*self.model.stages, forest])


def metrics(predictions: DataFrame, target: str = LABEL) -> DataFrame:
    """rmse, r2 and the number of rows scored, in one aggregate."""
    y, p = F.col(target), F.col("prediction")
    one = predictions.agg(F.avg(F.pow(y - p, F.lit(2))).alias("mse"), F.var_pop(y).alias("var"), F.count(F.lit(1)).alias("n"))
    rows = [("rmse", F.sqrt("mse")), ("r2", F.lit(1.0) - F.try_divide(F.col("mse"), F.col("var"))),
            ("n_scored", F.col("n").cast("double"))]
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in rows])))


def string_index_labels(df: DataFrame, columns) -> DataFrame:
    """StringIndexer's label order as a table: frequency desc, then label asc.

    One scan emits a row per column and label; counts are a grouped
    aggregate; the ranks come from one distributed global row number over
    (column, count desc, label) minus each column's first rank, so a column
    with very many distinct labels is never sorted in a single task and the
    label list never passes through the driver.
    """
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in columns]))) \
        .filter(F.col("label").isNotNull())
    counts = stacked.groupBy("column", "label").agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_row_number(counts, [F.col("column"), F.col("_n").desc(), F.col("label")], "_g")
    # one row per indexed column: a size bound known from the call itself
    starts = ranked.groupBy("column").agg(F.min("_g").alias("_s"))
    return ranked.join(F.broadcast(starts), "column").select(
        "column", "label", (F.col("_g") - F.col("_s")).cast("double").alias("idx"))


def indexed_listing(listing: DataFrame) -> DataFrame:
    """Key and label index per string column for every listing row whose labels the train rows hold."""
    train, _, _ = bucket_split(listing, KEY)
    step = FeatureStep(train)
    return step.indexed(listing).select(KEY, *step.codes)


def forest_checks(listing: DataFrame) -> DataFrame:
    """Per split: rows, rows skipped for unseen labels, rows that a forest scores."""
    splits = dict(zip(("train", "val", "test"), bucket_split(listing, KEY)))
    step = FeatureStep(splits["train"])
    forest = step.forest(depth=2, trees=2).fit(step.fittable(splits["train"]))
    out = None
    for name, rows in splits.items():
        scored = forest.transform(step.indexed(rows)).agg(F.count("prediction").alias("n_scored"))
        one = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("split"), "n_rows", scored.select("n_scored").scalar().alias("n_scored"))
        one = one.select("split", "n_rows", (F.col("n_rows") - F.col("n_scored")).alias("n_skipped"), "n_scored")
        out = one if out is None else out.unionByName(one)
    return out


def rf_pipeline(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """A forest fitted on train, saved with its feature step, loaded again and scored on validation."""
    train, val, _ = bucket_split(listing, KEY)
    step = FeatureStep(train)
    path = scratch_path(spark, "forest", unique=True)
    step.with_forest(step.forest().fit(step.fittable(train))).write().overwrite().save(path)
    return metrics(PipelineModel.load(path).transform(val))


def rf_tuned(spark: SparkSession, listing: DataFrame, trials=TRIALS, parallelism: int = 4) -> DataFrame:
    """One row per trial (validation RMSE) and a final row (test RMSE).

    The candidates are fixed up front, so their fits are submitted as
    concurrent Spark jobs on the same indexed frames, as many at a time as
    their rows allow (``FIT_ROWS``).  The best trial is chosen by RMSE, ties
    by the smaller model, and refitted on train and validation rows.
    """
    train, val, test = bucket_split(listing, KEY)
    step = FeatureStep(train)
    seen, judged, held = (checkpoint(step.fittable(d)) for d in (train, val, test))

    def rmse(depth, trees, fit_on, score_on):
        scored = step.forest(depth, trees).fit(fit_on).transform(score_on)
        return metrics(scored, step.target).where("metric = 'rmse'").first()["value"]

    at_once = min(parallelism, len(trials), FIT_ROWS // max(1, seen.count()))
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        losses = list(pool.map(lambda t: rmse(*t, seen, judged), trials))
    best = min(zip(losses, trials))[1]
    rows = [("trial", *t, loss) for t, loss in zip(trials, losses)]
    rows.append(("final", *best, rmse(*best, seen.union(judged), held)))
    return spark.createDataFrame(rows, "stage string, max_depth int, num_trees int, rmse double")


# --- a fitted forest as a table ---------------------------------------------------------------

def forest_nodes(spark: SparkSession, path: str, depth: int) -> DataFrame:
    """The nodes of a saved forest: (tree, node, feature, threshold, left, n, value).

    Node 1 is a tree's root, the children of node i are 2 i and 2 i + 1.  A row goes left if its value of
    ``feature`` is at most ``threshold``, or, for an indexed label, if it is one of ``left``; leaves have no
    feature.  ``n`` counts the rows that the node was fitted on, ``value`` is their mean label.  The saved form
    links nodes by number, so the places are found level by level: ``depth`` joins of a table that grows with
    the forest and not with the rows.
    """
    d = F.col("nodeData")
    inner = d["split"]["featureIndex"] >= 0
    many, cut = d["split"]["numCategories"], d["split"]["leftCategoriesOrThreshold"]
    saved = checkpoint(spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), d["id"].alias("id"), d["leftChild"].alias("_l"), d["rightChild"].alias("_r"),
        F.when(inner, d["split"]["featureIndex"]).alias("feature"),
        F.when(inner & (many < 0), F.get(cut, F.lit(0))).alias("threshold"),
        F.when(inner & (many >= 0), F.array_sort(cut)).alias("left"),
        d["rawCount"].alias("n"), d["prediction"].alias("value")))
    level = saved.where("id = 0").select("tree", "id", F.lit(1).alias("node"), "_l", "_r")
    places = level
    for _ in range(depth):
        ids = F.array(*[F.struct(F.col(c).alias("id"), (2 * F.col("node") + i).alias("node")) for i, c in enumerate(("_l", "_r"))])
        below = level.where("_l >= 0").select("tree", F.inline(ids))
        level = below.join(saved.select("tree", "id", "_l", "_r"), ["tree", "id"])
        places = places.unionByName(level)
    return places.select("tree", "id", "node").join(saved, ["tree", "id"]) \
        .select("tree", "node", "feature", "threshold", "left", "n", "value")


def packed_forest(nodes: DataFrame) -> DataFrame:
    """One row: an array of trees, each an array of nodes by their number.  Its size is set by number and
    depth of the trees."""
    entry = F.struct("node", F.struct("feature", "threshold", "left", "value"))
    by_tree = nodes.groupBy("tree").agg(F.map_from_entries(F.collect_list(entry)).alias("m"), F.max("node").alias("last"))
    by_tree = by_tree.select("tree", F.expr("transform(sequence(0, last), i -> m[i])").alias("nodes"))
    return by_tree.agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "nodes"))), lambda t: t["nodes"]).alias("trees"))


def walk_forest(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features") -> DataFrame:
    """Rows with ``prediction``, the mean of the leaves that they reach: column expressions over the packed
    forest, no join and no shuffle of the rows.  Null for a row without features or a forest without nodes."""
    x = vector_to_array(F.col(features))

    def leaf(tree):
        def step(node, _):
            n = F.get(tree, node)
            value = F.get(x, n["feature"])
            goes_left = F.when(n["threshold"].isNotNull(), value <= n["threshold"]).otherwise(F.array_contains(n["left"], value))
            return F.when(n["feature"].isNull(), node).otherwise(2 * node + F.when(goes_left, 0).otherwise(1))
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step, lambda node: F.get(tree, node)["value"])
    leaves = F.transform("_trees", leaf)
    mean = F.aggregate(leaves, F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
                       lambda a, v: F.struct((a["s"] + v).alias("s"), (a["n"] + 1).alias("n")),
                       lambda a: F.try_divide(a["s"], a["n"]))
    scored = rows.withColumn("_trees", packed_forest(nodes).scalar())
    return scored.withColumn("prediction", F.when(F.col(features).isNotNull(), mean)).drop("_trees")


def exact_label(listing: DataFrame) -> DataFrame:
    """Prices in cents: sums of whole numbers do not depend on their order, so the same tree grows each time."""
    return listing.withColumn(LABEL, F.round(F.col(LABEL) * 100))


def one_tree_nodes(spark: SparkSession, step: FeatureStep, rows: DataFrame, depth: int = TABLE_DEPTH) -> DataFrame:
    """The nodes of a forest of one tree, fitted on all indexed ``rows``, saved with its feature step and loaded."""
    forest = step.forest(depth, trees=1).setBootstrap(False).setMaxBins(max(TABLE_BINS, step.bins()))
    path = scratch_path(spark, "forest", unique=True)
    step.with_forest(forest.fit(rows)).write().save(path)
    uid = PipelineModel.load(path).stages[-1].uid
    nodes = checkpoint(forest_nodes(spark, f"{path}/stages/*_{uid}", depth))
    remove_path(spark, path)
    return nodes


def table_forest(spark: SparkSession, listing: DataFrame):
    """The feature step and the nodes of a forest of one tree, fitted on all train rows."""
    train, _, _ = bucket_split(listing, KEY)
    step = FeatureStep(train)
    return step, one_tree_nodes(spark, step, step.fittable(train))


def forest_search(spark: SparkSession, listing: DataFrame, depths=(1, 2, 3)) -> DataFrame:
    """(stage, max_depth, rmse, n_scored): one-tree forests of every depth on validation rows, and the best one (ties:
    the least deep), fitted again on train and validation rows, on test rows.  Scored by their tables; errors that
    agree to five places are ties.
    """
    train, val, test = bucket_split(listing, KEY)
    step = FeatureStep(train)
    seen, judged, held = (checkpoint(step.fittable(d)) for d in (train, val, test))

    def judge(stage, depth, fit_on, score_on):
        error = F.pow((F.col(LABEL) - F.col("prediction")) / 100, F.lit(2))
        r = walk_forest(score_on, one_tree_nodes(spark, step, fit_on, depth), depth).agg(
            F.round(F.sqrt(F.avg(error)), 5).alias("rmse"), F.count("prediction").alias("n")).first()
        return stage, depth, r["rmse"], r["n"]
    trials = [judge("trial", d, seen, judged) for d in depths]
    best = min(trials, key=lambda t: (t[2] is None, t[2], t[1]))[1]
    rows = [*trials, judge("final", best, seen.union(judged), held)]
    return spark.createDataFrame(rows, "stage string, max_depth int, rmse double, n_scored bigint")


def forest_table_scores(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Per split: rows scored by the forest's table, their mean prediction and error."""
    step, nodes = table_forest(spark, listing)
    scored = walk_forest(step.indexed(listing), nodes, TABLE_DEPTH)
    error = F.pow((F.col(LABEL) - F.col("prediction")) / 100, F.lit(2))
    return scored.groupBy(bucket_split_label(KEY).alias("split")).agg(
        F.count("prediction").alias("n_scored"), F.round(F.avg("prediction"), 3).alias("mean_pred"),
        F.round(F.sqrt(F.avg(error)), 5).alias("rmse"))
