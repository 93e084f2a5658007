"""Benchmark decontamination with DataFrame functions alone.

Benchmark items become a set of word windows.  Every word position of every document probes the
hashes of the windows' first words (the anchors) inside the scan's own stage; the positions that
survive are verified word by word against the whole window.  Only verified hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import ascii_lower, one_row, staged, words

#: Runs of ASCII characters that are neither letter nor digit part the words of a raw text.  Upper
#: case letters are word characters here; words are lower-cased after the split.
PART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows that may be broadcast: about 150 bytes each, so 75 MB at most.  More are joined by shuffle.
BROADCAST_WINDOWS = 500_000
ANCHOR = 3


def _anchor(parts: list[Column]) -> Column:
    # lower() folds more than A-Z, the same on both sides: equal words stay equal
    return F.xxhash64(*[F.lower(p) for p in parts])


def windows(benchmark: DataFrame, n: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """(window text, len, width, anchor, items): the distinct windows of ``n`` words with the sorted
    distinct ids of their items.  Items of fewer words are one window; items without words have none."""
    own = benchmark.select(F.col(item).alias("item"), words(ascii_lower(F.col(text)), PART).alias("w")) \
        .where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    cut = own.select("item", size.alias("len"), F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))),
        lambda i: F.slice("w", i, size))).alias("p"))
    cut = cut.groupBy(F.concat_ws(" ", "p").alias("window"), "p", "len") \
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    width = F.least(F.col("len"), F.lit(ANCHOR))
    anchor = F.lit(None).cast("long")
    for a in range(1, ANCHOR + 1):
        anchor = F.when(width == a, _anchor([F.get("p", F.lit(i)) for i in range(a)])).otherwise(anchor)
    return cut.select("window", "len", width.alias("width"), anchor.alias("anchor"), "items")


def hits(docs: DataFrame, wins: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, th, pos, len, items): each occurrence of a window, by the position of its first word.
    ``th`` hashes the text, so rows that share a key are told apart."""
    wins = staged(wins, "windows")
    widths = sorted(r[0] for r in wins.select("width").distinct().collect())  # at most ANCHOR values
    n, longest = one_row(wins.agg(F.count(F.lit(1)), F.max("len")))
    probed = n <= BROADCAST_WINDOWS
    side = F.broadcast(wins) if probed else wins
    src = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), words(F.col(text), PART).alias("w"))
    found = None
    for a in widths:
        zipped = F.arrays_zip(*[F.col("w") if i == 0 else F.slice("w", i + 1, 2**31 - 1) for i in range(a)])
        rows = src.where(F.size("w") >= a).select("key", "th", "w", F.posexplode(zipped).alias("pos", "g"))
        rows = rows.select("key", "th", "w", "pos", _anchor(
            [F.col("g")[F.lit("w" if i == 0 else str(i))] for i in range(a)]).alias("anchor"))
        at = F.slice("w", F.col("pos") + 1, F.col("len"))
        if not probed:
            # a shuffled position takes the words of the longest window along, not the whole text's
            rows = rows.withColumn("w", F.slice("w", F.col("pos") + 1, longest))
            at = F.slice("w", 1, F.col("len"))
        # named columns, not slices of the hash table: the check of the whole window runs in the probe
        met = rows.join(side.where(F.col("width") == a), "anchor") \
            .where(ascii_lower(F.concat_ws(" ", at)) == F.col("window")) \
            .select("key", "th", "pos", "len", "items")
        found = met if found is None else found.unionByName(met)
    if found is None:
        found = src.limit(0).select("key", "th", F.lit(0).alias("pos"), F.lit(0).alias("len"),
                                    F.lit(None).cast(wins.schema["items"].dataType).alias("items"))
    return found


def _covered(spans: Column) -> Column:
    """Words under a sorted array of (pos, end) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = F.aggregate(spans, zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(s["end"] - F.greatest(s["pos"], a["end"]), F.lit(0))).alias("n")))
    return step["n"].cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id",
                  text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per distinct contaminated (key, th): n_hit words under windows, the sorted spans and
    the item ids.  What is gathered per document is bounded by its own words."""
    got = hits(docs, windows(benchmark, n, item), key, text)
    # the same text under the same key occurs once here, however many rows repeat it
    by = got.groupBy("key", "th").agg(
        F.array_sort(F.collect_set(F.struct("pos", (F.col("pos") + F.col("len")).alias("end")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return by.select("key", "th", _covered(F.col("spans")).alias("n_hit"), "spans", "items")


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id",
           text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per document: key, n_words, n_hit, items (null if clean).  Null and empty texts have
    no words and no hits; repeated rows get equal results; an empty benchmark hits nothing."""
    base = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), _n_words(F.col(text)).alias("n_words"))
    got = staged(contamination(docs, benchmark, n, key, text, item).select("key", "th", "n_hit", "items"), "hits")
    join = base["key"].eqNullSafe(got["key"]) & (base["th"] == got["th"])
    return base.join(got, join, "left").select(
        base["key"].alias(key), F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items")


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PART.replace("[", "[^", 1)))


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id",
                     text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents without any window of the benchmark, columns as given.  Null and empty texts have no
    window and stay; repeated rows stay or go together; an empty table stays empty."""
    got = staged(contamination(docs, benchmark, n, key, text, item).select("key", "th"), "hits")
    return docs.join(got, docs[key].eqNullSafe(got["key"]) & (F.xxhash64(docs[text]) == got["th"]), "left_anti")


def _places(spans: Column, first: int) -> Column:
    """Distinct places under the spans, from the ``first``-th word of each on."""
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.when(
        s["end"] - s["pos"] > first, F.sequence(s["pos"] + first, s["end"] - 1)).otherwise(F.array().cast("array<int>")))))


def _without(x: Column, mark: str) -> Column:
    """The pieces of ``x`` outside its spans, and a mark for each span that does not start inside another:
    places are sorted with the kind in the last bit, which costs a text no more than sorting its words."""
    every = F.when(F.size(x["pieces"]) > 0, F.sequence(F.lit(0), F.size(x["pieces"]) - 1)).otherwise(F.array().cast("array<int>"))
    rest = F.transform(F.array_except(every, _places(x["spans"], 0)), lambda i: i.cast("long") * 2)
    starts = F.array_distinct(F.transform(x["spans"], lambda s: s["pos"]))
    marks = F.transform(F.array_except(starts, _places(x["spans"], 1)), lambda i: i.cast("long") * 2 + 1)
    return F.transform(F.array_sort(F.concat(rest, marks)), lambda c: F.when(c % 2 == 1, F.lit(mark))
                       .otherwise(F.get(x["pieces"], F.shiftright(c, 1).cast("int"))))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id",
                 text: str = "text", item: str = "item_id", mark: str = " ") -> DataFrame:
    """The documents with their hit words cut out of contaminated texts, columns as given.

    A contaminated text is rebuilt from its words and the runs between them; hit words and the runs
    that follow them become one ``mark``.  Clean texts stay as they are, byte for byte; null and empty texts are clean,
    repeated rows get equal texts, an empty table stays empty.
    """
    got = staged(contamination(docs, benchmark, n, key, text, item).select("key", "th", "spans"), "hits")
    t, spans = docs[text], got["spans"]
    joined = docs.join(got, docs[key].eqNullSafe(got["key"]) & (F.xxhash64(t) == got["th"]), "left")
    # word and the gap behind it, in order; a leading gap stays in front
    pieces = F.regexp_extract_all(t, F.lit(PART.replace("[", "[^", 1) + PART.replace("+", "*")), F.lit(0))
    lead = F.regexp_extract(t, "^" + PART.replace("+", "*"), 0)
    kept = F.flatten(F.transform(F.array(F.struct(pieces.alias("pieces"), spans.alias("spans"))), lambda x: _without(x, mark)))
    cut = F.when(spans.isNull(), t).otherwise(F.concat(lead, F.array_join(kept, "")))
    return joined.select(*[cut.alias(c) if c == text else docs[c] for c in docs.columns])
