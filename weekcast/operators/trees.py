"""Regression forests for very many groups at once, grown level by level from histograms.

Rows are binned and collapsed to cells (group, fold, bins) with their count and sum, so a group that
holds a third of all rows is a third of a small table.  Each level is one aggregate over (group, tree,
node, feature, bin) for all trees of all groups; the best split per node is an arg-max over running
sums.  The model is a table of nodes, and rows are scored by walking it in column expressions.

Targets are counted in units, so all sums are exact: trees do not depend on partitioning or retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.session import checkpoint

#: Depth, bins per feature, trees per group, and the fewest rows of a child.
DEPTH, BINS, TREES, LEAST = 3, 16, 4, 20


def bounds(rows: DataFrame, features) -> list[tuple[float, float]]:
    """Smallest and largest value of each feature: one row."""
    aggs = [f(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))) for c in features for f in (F.min, F.max)]
    r = rows.agg(*[a.alias(f"_{i}") for i, a in enumerate(aggs)]).first()
    return [(r[2 * i] or 0.0, r[2 * i + 1] or 0.0) for i in range(len(features))]


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin of a value, ends included; everything is in bin 0 if there is no width."""
    if not high > low:
        return F.lit(0)
    at = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    return F.greatest(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int")


def cells(rows: DataFrame, group: str, fold: Column, features, label: str, edges, unit: float, bins: int) -> DataFrame:
    """(group, fold, bin per feature, n, s): rows collapsed to their bins; incomplete rows are left out."""
    for c in [*features, label]:
        rows = rows.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    at = [bin_of(F.col(c).cast("double"), lo, hi, bins).alias(f"_b{i}") for i, (c, (lo, hi)) in enumerate(zip(features, edges))]
    y = F.round(F.col(label) / F.lit(unit)).cast("decimal(20,0)")
    keys = [f"_b{i}" for i in range(len(features))]
    return rows.select(F.col(group).alias("_g"), fold.alias("_fold"), *at, y.alias("_y")) \
        .groupBy("_g", "_fold", *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("decimal(38,0)").alias("s"))


def _splits(placed: DataFrame, k: int, level: int, least: int) -> DataFrame:
    """(group, tree, node, feature, bin): the split that lowers the squared error of each node most."""
    long = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"_b{i}").alias("bin")) for i in range(k)])
    hist = placed.where(F.col("node") >= 1 << level).select("_g", "tree", "node", "n", "s", F.inline(long)) \
        .groupBy("_g", "tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))
    of = Window.partitionBy("_g", "tree", "node", "feature")  # at most BINS rows
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.select("_g", "tree", "node", "feature", "bin", F.sum("n").over(upto).alias("nl"), F.sum("n").over(of).alias("nt"),
                    F.sum("s").over(upto).cast("double").alias("sl"), F.sum("s").over(of).cast("double").alias("st"),
                    (F.sum("s").over(of) - F.sum("s").over(upto)).cast("double").alias("sr"))
    nr = F.col("nt") - F.col("nl")
    h = h.where((F.col("nl") >= least) & (nr >= least))
    gain = F.col("sl") * F.col("sl") / F.col("nl") + F.col("sr") * F.col("sr") / nr - F.col("st") * F.col("st") / F.col("nt")
    best = h.withColumn("gain", gain).where("gain > 0").groupBy("_g", "tree", "node") \
        .agg(F.min_by(F.struct("feature", "bin"), F.struct((-F.col("gain")).alias("g"), "feature", "bin")).alias("b"))
    return best.select("_g", "tree", "node", "b.feature", "b.bin")


def fit(rows: DataFrame, group: str, fold: Column, features, label: str, trees: int = TREES, depth: int = DEPTH,
        bins: int = BINS, least: int = LEAST, unit: float = 0.01) -> DataFrame:
    """The node table of all groups' forests: (group, tree, node, feature, bin, low, high, n, value).

    Tree t learns from the rows whose ``fold`` (0 to trees - 1) is not t; with one tree, from all.  Node 1 is
    a tree's root, the children of node i are 2 i (bins of ``feature`` up to ``bin``) and 2 i + 1; leaves have no
    feature.  ``low`` and ``high`` bound the feature's ``bins`` bins of equal width.
    ``value`` is the mean label of the node's rows.  Rows with a null or NaN are left out; a group without
    complete rows has no nodes.
    """
    features = list(features)
    edges, k = bounds(rows, features), len(features)
    small = checkpoint(cells(rows, group, fold, features, label, edges, unit, bins))
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    placed = small.select("*", tree, F.lit(1).alias("node"))
    if trees > 1:
        placed = placed.where(F.col("_fold") != F.col("tree"))
    placed, inner = checkpoint(placed.groupBy("_g", "tree", "node", *[f"_b{i}" for i in range(k)])
                               .agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))), None
    stats = []
    for level in range(depth + 1):
        here = placed.where(F.col("node") >= 1 << level).groupBy("_g", "tree", "node") \
            .agg(F.sum("n").alias("n"), F.sum("s").cast("double").alias("s"))
        stats.append(here)
        if level == depth:
            break
        split = checkpoint(_splits(placed, k, level, least))
        inner = split if inner is None else inner.unionByName(split)
        at = F.coalesce(*[F.when(F.col("feature") == i, F.col(f"_b{i}")) for i in range(k)])
        step = F.when(F.col("feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + (at > F.col("bin")).cast("int"))
        placed = checkpoint(placed.join(split, ["_g", "tree", "node"], "left")
                            .select("_g", "tree", step.alias("node"), *[f"_b{i}" for i in range(k)], "n", "s"))
    nodes = stats[0]
    for s in stats[1:]:
        nodes = nodes.unionByName(s)
    low, high = (F.get(F.array(*[F.lit(e[i]) for e in edges]), F.col("feature")) for i in range(2))
    return nodes.join(inner, ["_g", "tree", "node"], "left").select(
        F.col("_g").alias(group), "tree", "node", "feature", "bin", low.alias("low"), high.alias("high"),
        F.col("n"), (F.col("s") / F.col("n") * unit).alias("value"))


def packed(nodes: DataFrame, group: str) -> DataFrame:
    """One row per group: an array of trees, each an array of nodes by their number; its size is set by the
    number and depth of the trees, not by the rows."""
    entry = F.struct("node", F.struct("feature", "bin", "low", "high", "value"))
    by_tree = nodes.groupBy(group, "tree").agg(F.map_from_entries(F.collect_list(entry)).alias("m"), F.max("node").alias("last"))
    by_tree = by_tree.select(group, "tree", F.expr("transform(sequence(0, last), i -> m[i])").alias("nodes"))
    return by_tree.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "nodes"))),
                                                  lambda t: t["nodes"]).alias("_trees"))


def score(rows: DataFrame, nodes: DataFrame, group: str, features, depth: int = DEPTH, bins: int = BINS) -> DataFrame:
    """Rows with ``prediction``, the mean over the trees of their group; null without a forest or with a null
    or NaN among the features.  One equi-join with one row per group, the rest is column expressions."""
    x = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features]
    known = x[0].isNotNull()
    for c in x[1:]:
        known = known & c.isNotNull()

    def walk(tree):
        def step(node, _):
            n = F.get(tree, node)
            place = F.floor((F.get(F.col("_x"), n["feature"]) - n["low"]) / (n["high"] - n["low"]) * F.lit(float(bins)))
            return F.when(n["feature"].isNull(), node).otherwise(2 * node + (place > n["bin"]).cast("int"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step, lambda node: F.get(tree, node)["value"])
    mean = F.aggregate(F.transform(F.col("_trees"), walk), F.lit(0.0), lambda a, v: a + v, lambda a: a / F.size("_trees"))
    joined = rows.withColumn("_x", F.when(known, F.array(*x))).join(packed(nodes, group), group, "left")
    return joined.withColumn("prediction", F.when(F.col("_x").isNotNull(), mean)).drop("_x", "_trees")
