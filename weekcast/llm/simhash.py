"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are summed inside Spark (exploded shingles, map-side combine).  The bit masks of the
covering family come from the non-zero vectors of a binary space of ``radius + 1`` dimensions: bit
``i`` has a vector m(i), mask v keeps the bits whose m(i) has an odd product with v.  Any ``radius``
bits leave some v with an even product on all of them, so two fingerprints within the radius agree
under that mask: every such pair meets in some table, with certainty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import ascii_lower, staged, whole_groups, words
from weekcast.llm.components import components

#: Fingerprints of one bucket compared in one task; larger buckets go block pair by block pair.
BLOCK = 2048
#: Up to this size a bucket reports each link; above it a spanning forest of its links.
SMALL = 32
#: A bucket beyond this many blocks is dealt again by masks over the bits that its own mask leaves free.
WIDE = 31


def fingerprints(docs: DataFrame, k: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, th, fp long, copies): one row per distinct (key, text) with the number of its rows; ``th``
    is a hash of the text.

    Null, empty and blank texts have no words and fingerprint 0.  Texts of fewer than ``k`` words
    are one shingle.  Repeated rows raise ``copies`` and leave the fingerprint as it is.
    """
    src = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"),
                      words(ascii_lower(F.col(text))).alias("w"))
    zipped = F.arrays_zip(*[F.col("w") if i == 0 else F.slice("w", i + 1, 2**31 - 1) for i in range(k)])
    rows = src.select("key", "th", F.size("w").alias("n_words"), F.posexplode_outer(zipped).alias("pos", "g")) \
        .where(F.col("pos").isNull() | (F.col("pos") <= F.greatest(F.col("n_words") - k, F.lit(0))))
    h = F.when(F.col("pos").isNotNull(),
               F.xxhash64(F.concat_ws(" ", *[F.col("g")[F.lit("w" if i == 0 else str(i))] for i in range(k)])))
    rows = rows.select("key", "th", "pos", h.alias("h"))
    two = F.lit(0x100000001)  # a counter in each half of a long
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(two)).alias(f"s{i}") for i in range(32)]
    agg = rows.groupBy("key", "th").agg(*sums, F.count("h").alias("n"),
                                        F.count(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, 1)).alias("copies"))
    fp = F.lit(0).cast("long")
    for i in range(64):
        c = F.col(f"s{i % 32}")
        count = c.bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftrightunsigned(c, 32)
        fp = fp.bitwiseOR(F.when(count * 2 > F.col("n"), F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0)))
    return agg.select("key", "th", fp.alias("fp"), "copies")


def masks(radius: int, among: int = (1 << 64) - 1) -> list[int]:
    """Structured masks of the bits ``among``: any two words that differ in at most ``radius`` of those bits
    agree under at least one of them."""
    space = (1 << (radius + 1)) - 1
    bits = [i for i in range(64) if among >> i & 1]
    vector = {b: 1 + i % space for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, space + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fp: np.ndarray, radius: int) -> list[np.ndarray]:
    """Spanning forest of the links inside one block: each row is compared with those not yet
    reached, so what is emitted is less than the rows."""
    out, left = [], np.arange(len(fp))
    while len(left):
        queue, left = left[:1], left[1:]
        while len(queue) and len(left):
            node, queue = queue[0], queue[1:]
            hit = np.bitwise_count(fp[left] ^ fp[node]) <= radius
            if hit.any():
                new = left[hit]
                out.append(np.stack([np.full(len(new), fp[node]), fp[new]]))
                left, queue = left[~hit], np.concatenate([queue, new])
    return out


def _verify(radius: int, keys: list[str]):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for rows, starts in whole_groups(batches, keys):
            fp = rows.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            sizes = np.diff(np.append(starts, len(fp)))
            found = []
            group = np.repeat(np.arange(len(starts)), sizes)
            small = np.repeat(sizes <= SMALL, sizes)
            f, g = fp[small], group[small]
            for d in range(1, min(SMALL, len(f))):
                near = (g[d:] == g[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= radius)
                if near.any():
                    found.append(np.stack([f[:-d][near], f[d:][near]]))
            for i in np.flatnonzero(sizes > SMALL):
                found += _forest(fp[starts[i]:starts[i] + sizes[i]], radius)
            if found:
                a, b = np.concatenate(found, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
    return run


def _buckets(keyed: DataFrame) -> DataFrame:
    """(t, k, n): buckets of two or more fingerprints."""
    return staged(keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")


def _dealt_again(keyed: DataFrame, radius: int) -> DataFrame:
    """Rows (t, k, fp) in tables of two masks each: the row's own, and one of a covering family over the bits
    that it leaves free.  Two fingerprints of a bucket differ in free bits only, so a pair within the radius
    still meets."""
    first = masks(radius)
    both = F.array(*[F.array(*[F.lit(_signed(a | b)) for b in masks(radius, ~a)]) for a in first])
    again = keyed.select("fp", "t", F.posexplode(F.get(both, F.col("t"))).alias("u", "m"))
    return again.select(((F.col("t") + 1) * len(first) + F.col("u")).alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("k"), "fp")


def links(fps: DataFrame, radius: int = 4, block: int = BLOCK, wide: int = WIDE) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fps`` (column fp) just as all pairs
    within ``radius`` bits do.  Buckets of one are left out by a count; a bucket beyond ``block``
    is cut into blocks, and each pair of blocks is a group of its own, so no task holds more than
    two blocks and no pair is missed.  A bucket of more than ``wide`` blocks, whose rows would meet more
    than ``wide`` blocks each, is dealt again by a second mask.  At a radius of 4 two masks fix 48 bits or
    more, which bounds a bucket by 2 ** 16 fingerprints and 32 blocks, however many there are in all."""
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m)))
                                                    for m in masks(radius)])).alias("t", "k"))
    shared = _buckets(keyed)
    hot = F.col("n") > block * wide
    sized = keyed.join(shared, ["t", "k"])
    if not shared.where(hot).isEmpty():
        again = _dealt_again(keyed.join(shared.where(hot).select("t", "k"), ["t", "k"]), radius)
        sized = sized.where(~hot).unionByName(again.join(_buckets(again), ["t", "k"]))
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = sized.withColumn("parts", parts).withColumn("own", own) \
        .select("t", "k", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")) \
        .select("t", "k", "fp", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"))
    keys = ["t", "k", "b1", "b2"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_verify(radius, keys), "a long, b long")


def groups(docs: DataFrame, k: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, th, fp, copies, root, component_id) for every distinct (key, text): ``root`` names the
    component, ``component_id`` is its smallest key.  Equal fingerprints meet in one table row before
    any pair is sought, so copies cost one row each."""
    fp = staged(fingerprints(docs, k, text, key), "fingerprints")
    distinct = staged(fp.groupBy("fp").agg(F.min("key").alias("first")), "distinct-fp")
    comp = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = staged(distinct.join(comp, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root")),
                    "rooted")
    least = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = staged(rooted.join(least, "root").select("fp", "root", "component_id"), "named")
    return fp.join(named, "fp")


def near_duplicates(docs: DataFrame, k: int = 4, radius: int = 4, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id) for every row: component_id is the smallest key reachable over
    links of at most ``radius`` differing bits.

    An empty table gives an empty result; null keys are kept, and only a component without any
    other key is null.
    """
    return groups(docs, k, radius, text, key).select(
        F.col("key").alias(key), "fp", "component_id",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).drop("_copy")


def keep_one(docs: DataFrame, k: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, columns as given: the smallest key (null last), then the smallest
    hash of the text; of rows that repeat key and text one stays."""
    found = staged(groups(docs, k, radius, text, key), "groups")
    order = F.struct(F.col("key").isNull().alias("last"), "key", "th")
    first = staged(found.groupBy("root").agg(F.min(order).alias("first")), "firsts")
    kept = (F.col("key").eqNullSafe(F.col("first.key"))) & (F.col("th") == F.col("first.th"))
    judged = staged(found.join(first, "root").select("key", "th", "copies", kept.alias("kept")), "judged")

    def rows(of: str, how: str) -> DataFrame:
        some = judged.where(of).select(F.col("key").alias("_key"), F.col("th").alias("_th"))
        # these grow with the documents: a merge join at every size, which AQE may split
        return docs.join(some.hint("merge"), docs[key].eqNullSafe(some["_key"]) & (F.xxhash64(docs[text]) == some["_th"]), how)
    alone = rows("not kept or copies > 1", "left_anti")
    if judged.where("kept and copies > 1").isEmpty():
        return alone
    return alone.unionByName(rows("kept and copies > 1", "left_semi").dropDuplicates([key, text]))


def fingerprint_text(fp: str = "fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
