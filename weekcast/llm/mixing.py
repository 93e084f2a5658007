"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key -ln(u) / w: u is a uniform drawn from a hash of its id, w its
quality weight.  Inside a source the documents are taken in key order until their sizes fill the
source's budget; whole epochs come first and only the rest is sampled.

No source is ever sorted in one task.  Keys fall into about sqrt(rows) bins per source; prefix sums
over the bins find the one bin in which the budget ends, and only that bin is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.llm.common import WORD, one_row, staged

#: Characters of markup and tables; the quality weight falls with their share of a text.
SYMBOLS = "<>{}[]|#$%^&*_=+~\\/"
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: the squared share of characters outside SYMBOLS; 1 for empty texts."""
    clean = F.length(F.translate(text, SYMBOLS, "")) / F.greatest(F.length(text), F.lit(1))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(1.0)) \
        .otherwise(F.greatest(clean * clean, F.lit(0.05)))


def uniform(key: Column, seed: int) -> Column:
    """Uniform in (0, 1) from the first 52 bits of md5(seed:key): the same on every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def keyed(docs: DataFrame, weight: Column | None = None, size: Column | None = None, seed: int = 7,
          key: str = "doc_id", source: str = "source", text: str = "text", *more: Column) -> DataFrame:
    """(doc_key, source, size, es_key) and ``more``: what the plan needs of each row, computed in the scan.
    Weights that are null or not above zero count as 0.05, so that every row can be drawn."""
    w = quality_weight(F.col(text)) if weight is None else weight
    w = F.when(w > 0, w.cast("double")).otherwise(F.lit(0.05))
    n = word_count(F.col(text)) if size is None else size
    return docs.select(F.col(key).cast("long").alias("doc_key"), F.col(source).alias("source"),
                       F.coalesce(n, F.lit(0)).cast("long").alias("size"),
                       (-F.log(uniform(F.col(key), seed)) / w).alias("es_key"), *more)


def targets(rows: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, weight, source_size, n, target) for each source, one row each.

    Sources weigh 1, 2, 3, repeating, in code-point order with null last, and share the total size;
    a target stops at ``max_epochs`` times its source's size and the excess goes to the others by
    weight.  The loop raises one level for all open sources; the driver sees three sums a round.
    """
    src = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")),
                 "source-sizes")
    # one row per source: a summary, not the documents
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    src = staged(src.withColumn("weight", ((rank - 1) % 3 + 1).cast("long")), "source-weights")
    cap = F.col("source_size") * max_epochs
    total, weights = one_row(src.agg(F.sum("source_size"), F.sum("weight")))
    level, full = 0.0, (0, 0, -1)
    while total and full[1] < weights:
        level = (total - full[0]) / (weights - full[1])
        now = one_row(src.where(cap < F.lit(level) * F.col("weight"))
                      .agg(F.coalesce(F.sum(cap), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count(F.lit(1))))
        if tuple(now) == full or not now[2]:
            break
        full = tuple(now)
    return src.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _order(rows: DataFrame) -> DataFrame:
    """Adds the bin of each row's key.  1 - exp(-key * scale) is monotone in the key; the scale is the
    reciprocal of the source's mean key, which spreads the rows over the bins."""
    part = F.lit(1.0) - F.exp(-F.col("es_key") / F.greatest(F.col("mean_key"), F.lit(1e-300)))
    bins = F.ceil(F.sqrt(F.col("n")))
    return rows.withColumn("bin", F.least(F.floor(part * bins), bins - 1).cast("long"))


def plan(rows: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, epochs, and the cut (cut_bin, cut_key, cut_doc,
    cut_size) up to which the partial epoch takes documents.

    A document belongs to the partial epoch if the middle of its size lies within the budget, so the
    words taken are within half a document of the target.  Ties in the key go by id, then size;
    identical rows go together.
    """
    src = targets(rows, max_epochs)
    means = rows.groupBy("source").agg(F.avg("es_key").alias("mean_key"))
    src = src.join(means, src["source"].eqNullSafe(means["source"])).drop(means["source"])
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")),
                                                      F.lit(max_epochs))).otherwise(F.lit(0)).cast("long")
    src = staged(src.withColumn("epochs", epochs)
                 .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "source-plan")
    binned = _order(rows.alias("r").join(src.select("source", "n", "mean_key").alias("s"),
                                         F.col("r.source").eqNullSafe(F.col("s.source")))
                    .select("r.*", "s.n", "s.mean_key"))
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    w = Window.partitionBy("source").orderBy("bin")
    sums = sums.withColumn("before", F.sum("bin_size").over(w) - F.col("bin_size"))
    # the first bin that the budget does not fill: at most one per source
    edge = sums.alias("b").join(src.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))) \
        .where("b.before + b.bin_size > s.rest and b.before <= s.rest") \
        .select("b.source", "b.bin", "b.before", "s.rest")
    edge = staged(edge, "edge-bins")
    inside = binned.alias("r").join(edge.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source"))
                                    & (F.col("r.bin") == F.col("e.bin"))) \
        .groupBy("r.source", "es_key", "doc_key", "size", "before", "rest").agg(F.sum("size").alias("both"))
    order = Window.partitionBy("source").orderBy("es_key", F.col("doc_key").asc_nulls_first(), "size")
    upto = F.sum("both").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = inside.withColumn("middle", F.col("before") + upto - F.col("both") / 2).where("middle <= rest") \
        .groupBy("source").agg(F.max(F.struct("es_key", F.coalesce("doc_key", F.lit(-(1 << 63))).alias("doc"),
                                              "size")).alias("cut"))
    return staged(src.alias("s").join(edge.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")), "left")
                  .join(cut.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left")
                  .select("s.*", F.col("e.bin").alias("cut_bin"), "c.cut"), "mix-plan")


def copies(rows: DataFrame, plan_: DataFrame) -> DataFrame:
    """``rows`` (with source, size, es_key and doc_key) plus source_size, target and ``copies``: the
    whole epochs of the source and one more for documents inside the cut."""
    mine = F.struct("es_key", F.coalesce("doc_key", F.lit(-(1 << 63))).alias("doc"), "size")
    p = plan_.withColumnRenamed("source", "_source")
    got = _order(rows.join(p, F.col("source").eqNullSafe(F.col("_source"))))
    taken = F.when(F.col("cut_bin").isNull(), F.col("rest") >= F.col("source_size")) \
        .otherwise((F.col("bin") < F.col("cut_bin"))
                   | ((F.col("bin") == F.col("cut_bin")) & F.coalesce(mine <= F.col("cut"), F.lit(False))))
    taken = F.coalesce(taken & (F.col("rest") > 0), F.lit(False))
    return got.withColumn("copies", F.col("epochs") + taken.cast("long"))


def mix(docs: DataFrame, weight: Column | None = None, max_epochs: int = MAX_EPOCHS, seed: int = 7,
        key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: key, size, source, source_size, target, copies, taken (size x copies).

    Empty tables give no rows; documents without words have size 0 and taken 0; a null source is a
    source of its own; rows that repeat an id are drawn together.
    """
    rows = staged(keyed(docs, weight, None, seed, key, source, text), "mix-keys")
    out = copies(rows, plan(rows, max_epochs))
    return out.select(F.col("doc_key").alias(key), "size", F.col("source").alias(source), "source_size",
                      "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = 7, key: str = "doc_id",
                    source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it.  The keys are computed
    again beside the texts and meet the per-source plan there, so no text is shuffled."""
    p = plan(staged(keyed(docs, None, None, seed, key, source, text), "mix-keys"), max_epochs)
    rows = keyed(docs, None, None, seed, key, source, text, F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    out = copies(rows, p).where("copies > 0") \
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_n"))
    return out.select("row.*")
