"""Merkle manifest of a dataset: one tree per source, and one tree over the sources' roots.

Leaves are put in order by one range sort and numbered without a single task.  FAN consecutive nodes
become one node, level by level; FAN ** DEPTH consecutive leaves of a source are a superblock.  A first pass
reduces each superblock to its top node; the few nodes above are reduced in tables, and every
superblock's path to the root, the runs of outer nodes that it needs, is handed down level by level.
Then leaves and outer nodes are cogrouped by superblock: one Python call reduces the block again, joins
local and outer siblings to proofs, and folds each presented leaf up to the root.

A source of any size is cut into superblocks, and superblocks that start within the same FAN ** DEPTH row
numbers share a group: at most twice as many leaves, and no group a small source of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import one_row, staged, unstage
from weekcast.operators.ranking import global_row_number
from weekcast.session import ship_package

FAN = 16
#: Levels inside a superblock of FAN ** DEPTH leaves.
DEPTH = 3
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field's UTF-8 byte count, a colon and its value, or a dash if it is null."""
    def one(c):
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(F.concat(*[one(c) for c in fields]))


def _h(digests) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _runs(nodes: DataFrame) -> DataFrame:
    """(tree, n, parent, digests): the nodes of a level, FAN to a run."""
    return nodes.groupBy("tree", "n", F.expr(f"pos div {FAN}").alias("parent")) \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "node"))), lambda s: s["node"]).alias("digests"))


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels of runs above ``nodes`` (tree, pos, node, n), n the nodes of the tree at this level, and
    (tree, node) of the trees' tops.  A tree ends at the level where it has one node."""
    levels, top = [], nodes.where("n = 1").select("tree", "node")
    while True:
        runs = staged(_runs(nodes.where("n > 1")), name)
        if runs.isEmpty():
            unstage(runs)
            return levels, top
        levels.append(runs)
        nodes = runs.select("tree", F.col("parent").alias("pos"), digest(F.array_join("digests", "")).alias("node"),
                            F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"))
        top = top.unionByName(nodes.where("n = 1").select("tree", "node"))


def _descend(levels: list[DataFrame], top: DataFrame, name: str) -> DataFrame:
    """(tree, pos, path) of every node of the lowest level: the runs on its way up, its own place in
    each, and at the end the path that ``top`` (tree, path) has.  A run meets its parent's path only,
    which no more than FAN runs share, so no key of these joins is hot."""
    above = None
    for runs in reversed(levels):
        ends = runs.where(f"n <= {FAN}").join(top, "tree").select("tree", "parent", "digests", "path")
        if above is not None:
            ends = ends.unionByName(runs.where(f"n > {FAN}").join(above.withColumnRenamed("pos", "parent"), ["tree", "parent"])
                                    .select("tree", "parent", "digests", "path"))
        step = F.array(F.struct(F.col("own"), F.col("digests")))
        above = staged(ends.select("tree", "parent", "digests", "path", F.posexplode("digests").alias("own", "node"))
                       .select("tree", (F.col("parent") * FAN + F.col("own")).alias("pos"),
                               F.concat(step, "path").cast(_PATH).alias("path")), name)
    return above


_PATH = "array<struct<own:int,digests:array<string>>>"


def _height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


def _block(rows: pd.DataFrame, depth: int) -> list[list[str]]:
    """Levels of a superblock (rows in order), its leaves first, up to its top node."""
    levels = [rows["leaf"].tolist()]
    for _ in range(min(depth, _height(int(rows["n"].iloc[0])))):
        low = levels[-1]
        levels.append([_h(low[i:i + FAN]) for i in range(0, len(low), FAN)])
    return levels


def _tops(depth: int):
    """The top node of every superblock of a group."""
    size = FAN ** depth

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(tree, block, _block(r, depth)[-1][0], -(-int(r["n"].iloc[0]) // size))
               for (tree, block), r in rows.sort_values("pos").groupby(["tree", "block"])]
        return pd.DataFrame(out, columns=["tree", "pos", "node", "n"])
    return run


def _prove(depth: int):
    """Local reduction, proofs and folds of the superblocks of one group."""
    columns = ["key", "leaf", "subroot", "proof", "places", "sizes", "folded_root"]

    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        ways = {(t, p): (path, subroot) for t, p, path, subroot
                in zip(outer["tree"], outer["pos"], outer["path"], outer["subroot"])}
        out = []
        for (tree, block), r in leaves.sort_values("pos").groupby(["tree", "block"]):
            levels = _block(r, depth)[:-1]
            path, subroot = ways[tree, block]
            steps = [(int(s["own"]), list(s["digests"])) for s in path]
            tail = "".join("".join(d[:own] + d[own + 1:]) for own, d in steps)
            for i, (key, leaf_, node) in enumerate(zip(r["key"], r["leaf"], r["presented"])):
                at, proof, places, sizes = i, [], [], []
                for level in levels:
                    lo = at - at % FAN
                    before, after = level[lo:at], level[at + 1:lo + FAN]
                    node, at = _h([*before, node, *after]), at // FAN
                    proof += before + after
                    places.append(len(before))
                    sizes.append(len(before) + 1 + len(after))
                for own, digests in steps:
                    node = _h([*digests[:own], node, *digests[own + 1:]])
                out.append((key, leaf_, subroot, "".join(proof) + tail, places + [own for own, _ in steps],
                            sizes + [len(d) for _, d in steps], node))
        return pd.DataFrame(out, columns=columns)
    return run


_ANSWER = "key string, leaf string, subroot string, proof string, places array<int>, sizes array<int>, folded_root string"


def fold(node: str, proof: str, places: Sequence[int], sizes: Sequence[int]) -> str:
    """The root that a leaf and its proof lead to: per level the own place in a run, and the run's size."""
    at = 0
    for own, size in zip(places, sizes):
        cut, end = at + 64 * own, at + 64 * (size - 1)
        node, at = _h([proof[at:cut], node, proof[cut:end]]), end
    return node


def audit(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id",
          presented: dict[str, Column] | None = None, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: (key, leaf, subroot, root, proof, places, sizes, folded_root, verified).

    ``presented`` replaces fields by expressions over ``docs``: the manifest is built from the rows as
    they are, then each row is presented with these values, its leaf is folded with the siblings of the
    manifest, and ``verified`` tells whether that gives the root.  ``proof`` holds the siblings' digests
    (64 hex digits each) from the leaf up, left to right; ``places`` and ``sizes`` the own place in each
    run and the run's size (see ``fold``).  ``depth`` levels are reduced inside a superblock; it changes no result.

    Leaves of a source ascend by key, null keys first; rows that share a key are ordered by their digest,
    so repeated rows have equal leaves and proofs of their own.  The null source comes first.  Null fields
    are dashes, empty texts values of no bytes.  A table of one row is its own root with an empty proof; an
    empty table gives no rows.  Only the named columns are read, so other names cannot clash.
    """
    ship_package(docs.sparkSession)
    size = FAN ** depth
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("grp"),
                       leaf([F.col(c) for c in fields]).alias("leaf"),
                       leaf([(presented or {}).get(c, F.col(c)) for c in fields]).alias("presented"))
    rows = staged(rows, "leaves")  # each text is hashed once, though a range sort reads its input twice
    order = [F.col("grp").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf")]
    ranked = staged(global_row_number(rows, order, "row"), "ranked")
    unstage(rows)

    # sources come in the order of their first rows
    trees = ranked.groupBy("grp").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = staged(global_row_number(trees, ["first"], "tree").withColumnRenamed("grp", "name"), "sources")
    pack = F.expr(f"(first + block * {size}) div {size}")
    placed = ranked.join(trees, ranked["grp"].eqNullSafe(trees["name"])) \
        .select(F.col("key").cast("string").alias("key"), "leaf", "presented", "tree", "n", "first",
                (F.col("row") - F.col("first")).alias("pos")) \
        .withColumn("block", F.expr(f"pos div {size}")).withColumn("pack", pack).drop("first")
    placed = staged(placed, "placed")
    unstage(ranked)

    tops = staged(placed.select("pack", "tree", "block", "pos", "n", "leaf").groupBy("pack")
                  .applyInPandas(_tops(depth), "tree long, pos long, node string, n long"), "tops")
    levels, subroots = _climb(tops, "runs")
    subroots = staged(subroots, "subroots")
    sources = one_row(subroots.agg(F.count(F.lit(1))))[0]
    forest = subroots.select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("pos"), "node",
                             F.lit(sources).cast("long").alias("n"))
    above, top = _climb(forest, "forest")
    root = top.first()
    here = F.expr(f"cast(array() as {_PATH})").alias("path")
    ways = subroots.select("tree", here)
    if above:  # more than one source
        ways = _descend(above, top.select("tree", here), "ways").select((F.col("pos") + 1).alias("tree"), "path")
    outer = tops.where("n = 1").join(ways, "tree").select("tree", "pos", "path")
    if levels:
        outer = outer.unionByName(_descend(levels, ways, "outer"))
    outer = outer.withColumnRenamed("pos", "block") \
        .join(subroots.withColumnRenamed("node", "subroot"), "tree").join(trees.select("tree", "first"), "tree") \
        .select(pack.alias("pack"), "tree", F.col("block").alias("pos"), "path", "subroot")
    got = placed.groupBy("pack").cogroup(outer.groupBy("pack")).applyInPandas(_prove(depth), _ANSWER)
    root = F.lit(root["node"] if root else None).cast("string")
    return got.select(F.col("key").cast(kind).alias(key), "leaf", "subroot", root.alias("root"), "proof", "places", "sizes",
                      "folded_root", (F.col("folded_root") == root).alias("verified"))
