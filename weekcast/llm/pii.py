"""Personal data: base expressions, then bootstrapped contextual extraction.

The base finds seed entities.  The one and two words before them are lexical patterns; a pattern is
scored by the share of all its occurrences in the corpus that precede a known entity of one kind.
Identifier-like strings that the base passed over and that stand behind high-confidence patterns
become entities themselves, which changes the scores of further patterns.  The graph of patterns and
instances stays in Spark tables.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import staged, unstage
from weekcast.session import ship_package

KINDS = ("email", "ip", "card", "phone")
#: A pattern counts from this many distinct entities on, if entities follow this share of its
#: occurrences; a new instance needs this score.
SUPPORT = 3
CONFIDENCE = 0.7
INSTANCE = 0.8
#: Bits of the broadcast sieve of patterns; those it lets through are joined exactly.
SIEVE = 1 << 23
#: Context words above this length are named by their hash.
NAMED = 48
#: Distinct words and neighbours that a counting task holds, and words of a text split at once.
HELD = 400_000
WORDS = 1 << 17

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What a seed's context may discover: a name before @ and a host, or seven digits with separators.
_HOST = re.compile(r"[A-Za-z0-9.-]++")
_NUMBER = re.compile(r"(?<![A-Za-z0-9])\+?\(?[0-9](?:[().\x20-]{0,2}[0-9])*+")
_DIGITS = str.maketrans("123456789", "000000000")
#: Where a value may start: a word, behind a character that no address has, a plus, a run of digits.
_STARTS = re.compile(r"(?<!\S)(?=\S)|(?<=[^\sA-Za-z0-9._%+-])(?=[A-Za-z0-9._%+(-])|(?<=\S)(?=\+)|(?<=[^\s0-9])(?=[0-9])")
_WORD = re.compile(r"\S+")
_GLUED = "\x01"
_HASHED = "\x02"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, leftmost and non-overlapping per kind, in order.

    Each search is linear: an address is looked for around its @ sign, and an ip starts where a run
    of digits starts (a match inside the run would match from its start as well).
    """
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            out.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _clean(word: str) -> str:
    return word.casefold().translate(_DIGITS)  # letter by letter, so that a part's clean form is part of the word's


def _hash() -> hashlib.blake2b:
    return hashlib.blake2b(digest_size=16)


def _name(word: str) -> str:
    """A context word as it stands in patterns: its clean form, or the hash of that if it is long."""
    if len(word) <= NAMED:
        return _clean(word)
    h = _hash()
    h.update(_clean(word).encode())
    return _HASHED + h.hexdigest()


def _glued(word: str, places: list[int]) -> list[str]:
    """Names of the parts of a word before each of the places, ascending: one pass over the word."""
    out, h, at = [], None, 0
    for p in places:
        if p <= NAMED:
            out.append(_clean(word[:p]) + _GLUED)
        else:
            h = h or _hash()
            h.update(_clean(word[at:p]).encode())
            at = p
            out.append(_HASHED + h.hexdigest() + _GLUED)
    return out


def _contexts(text: str, places: list[int]) -> list[list[str]]:
    """Per place (ascending): the last word and the last two words before it, if a value may start there;
    the part of a word that the value is glued to counts as a word of its own kind."""
    if not places:
        return []
    spans = [m.span() for m in _WORD.finditer(text, 0, places[-1] + 1)]
    starts = [s for s, _ in spans]
    names: dict[int, str] = {}

    def name(k):
        if k not in names:
            names[k] = _name(text[spans[k][0]:spans[k][1]])
        return names[k]
    inside: dict[int, list[int]] = {}
    at = []
    for p in places:
        k = bisect_right(starts, p) - 1
        at.append(k)
        if starts[k] < p:
            own = inside.setdefault(k, [])
            if not own or own[-1] != p - starts[k]:
                own.append(p - starts[k])
    parts = {(k, p): n for k, own in inside.items()
             for p, n in zip(own, _glued(text[starts[k]:starts[k] + own[-1]], own))}
    out = []
    for k, p in zip(at, places):
        if not _STARTS.match(text, p) or (k == 0 and starts[0] == p):
            out.append([])
            continue
        last, before = (parts[k, p - starts[k]], k - 1) if starts[k] < p else (name(k - 1), k - 2)
        out.append([last] if before < 0 else [last, f"{name(before)} {last}"])
    return out


def _value(found: str) -> str:
    return found.lower() if "@" in found else re.sub(r"[^0-9]", "", found)


def _like(text: str) -> list[tuple[int, int]]:
    """(start, end) of address-like and number-like strings, leftmost and longest, each search linear."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    for m in _NUMBER.finditer(text):
        found, end = m.group(), m.end()
        if text[end:end + 1].isascii() and text[end:end + 1].isalpha():  # what is glued to a letter is cut off
            found = found.rstrip("0123456789").rstrip("(). -")
            end = m.start() + len(found)
        if sum(map(found.count, "0123456789")) >= 7:
            out.append((m.start(), end))
    return out


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """(start, end, kind or -1, value, patterns): base matches and identifier-like strings beside them."""
    starts = [s for s, _, _ in base]
    reach = np.maximum.accumulate([e for _, _, e in base]).tolist() if base else []
    out = [(s, e, k) for s, k, e in base]
    for s, e in _like(text):
        before = bisect_left(starts, e)
        if not before or reach[before - 1] <= s:  # overlaps no base match
            out.append((s, e, -1))
    out.sort()
    return [(s, e, k, _value(text[s:e]), p) for (s, e, k), p in zip(out, _contexts(text, [s for s, _, _ in out]))]


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_INSTANCE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.string()),
                       ("patterns", pa.list_(pa.string()))])
_FOUND = ("row long, key long, base array<struct<start:int,kind:int,end:int>>, "
          "near array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>")


def _find(batches):
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        texts = batch.column(1).to_pylist()
        base, near = [], []
        for t in texts:
            spans = base_spans(t) if t else []
            base.append([dict(zip(("start", "kind", "end"), s)) for s in spans])
            near.append([dict(zip(("start", "end", "kind", "value", "patterns"), i)) for i in instances(t, spans)] if t else [])
        n = len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(range(row, row + n), pa.int64()), batch.column(0),
                                          pa.array(base, pa.list_(_SPAN)), pa.array(near, pa.list_(_INSTANCE))],
                                         names=["row", "key", "base", "near"])
        row += n


class _Counts:
    """How often the patterns that pass the sieve stand before a place.

    A word stands before a place unless it ends its text; places inside a word depend on that word alone.
    A pair is wanted only if its last word is, so each distinct word is looked at once and most pairs are
    passed over by a look at their last word.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.words, self.pairs, self.last, self.last_pairs = Counter(), Counter(), Counter(), Counter()
        self.seen: set[str] = set()
        self.ends: dict[str, tuple[str | None, list[str]]] = {}  # wanted words: name, names of glued parts

    def size(self) -> int:
        return len(self.pairs) + len(self.seen)

    def _passes(self, pattern: str) -> bool:
        return self.bits[zlib.crc32(pattern.encode()) % SIEVE]

    def _look(self, word: str) -> None:
        self.seen.add(word)
        name = _name(word)
        plain = name if self._passes(name) else None
        glued = []
        if not (word.isascii() and word.isalpha()):
            places = [m.start() for m in _STARTS.finditer(word) if m.start()]
            glued = [g for g in _glued(word, places) if self._passes(g)]
        if plain is not None or glued:
            self.ends[word] = plain, glued

    def add(self, text: str) -> None:
        before = a = None
        for words in [text.split()] if len(text) <= 8 * WORDS else self._split(text):
            for w in set(words) - self.seen:
                self._look(w)
            wanted = self.ends
            self.words.update([w for w in words if w in wanted])
            self.pairs.update([p for p in zip(words, words[1:]) if p[1] in wanted])
            if words and before is not None and words[0] in wanted:
                self.pairs[before, words[0]] += 1
            for w in words[-2:]:
                a, before = before, w
        if before in self.ends:
            self.last[before] += 1
            if a is not None:
                self.last_pairs[a, before] += 1

    @staticmethod
    def _split(text):
        words = (m.group() for m in _WORD.finditer(text))
        while part := list(islice(words, WORDS)):
            yield part

    def totals(self) -> Counter:
        out: Counter = Counter()
        for w, n in self.words.items():
            name, glued = self.ends[w]
            if name is not None and n > self.last[w]:
                out[name] += n - self.last[w]
            for g in glued:
                out[g] += n
        named: dict[str, str] = {}
        for (a, b), n in self.pairs.items():
            if a not in named:
                named[a] = _name(a)
            name, glued = self.ends[b]
            inner = n - self.last_pairs[a, b]
            if name is not None and inner and self._passes(p := f"{named[a]} {name}"):
                out[p] += inner
            for g in glued:
                if self._passes(p := f"{named[a]} {g}"):
                    out[p] += n
        return out


def _occurrences(sieve):
    """(pattern, total): how often each pattern that passes the sieve stands before a place, per task."""
    def run(batches):
        held = _Counts(sieve.value)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.add(t or "")
                if held.size() > HELD:
                    yield _totals(held.totals())
                    held.clear()
        yield _totals(held.totals())
    return run


def _totals(seen: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                      names=["pattern", "total"])


def discover(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame | None:
    """(row, spans): identifiers that the patterns add, by row of ``found``; None if no pattern has
    enough values.  Each round scores all patterns by the entities known, then the unknown instances by
    the accepted patterns (noisy-or); the rounds end when nothing is new."""
    spark = found.sparkSession
    near = found.select("row", F.explode("near").alias("i")).select("row", "i.*")
    edges = staged(near.select("value", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n")), "edges")
    # what may become known in any round: patterns of SUPPORT distinct values, known or not
    wanted = staged(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("v")).where(F.col("v") >= SUPPORT).select("pattern"), "wanted")
    # SIEVE numbers at most
    marks = wanted.select((F.crc32(F.encode("pattern", "UTF-8")) % SIEVE).alias("at")).distinct().toArrow().column("at").to_numpy()
    if not len(marks):
        return None
    bits = np.zeros(SIEVE, bool)
    bits[marks] = True
    sieve = spark.sparkContext.broadcast(bits)
    # written out before they are joined: a frequent context or value is then split between tasks
    totals = staged(docs.select(text).mapInArrow(_occurrences(sieve), "pattern string, total long")
                    .groupBy("pattern").agg(F.sum("total").alias("total")).join(wanted, "pattern"), "totals")
    mail = F.col("value").contains("@")
    weights = staged(edges.join(totals, "pattern"), "graph")
    known = staged(near.where("kind >= 0").select("value", "kind").distinct(), "known")
    for old in (edges, wanted, totals):
        unstage(old)
    while True:
        scores = weights.join(known, "value").groupBy("pattern", "kind", "total") \
            .agg(F.sum("n").alias("hits"), F.count(F.lit(1)).alias("v")) \
            .withColumn("confidence", F.least(F.col("hits") / F.col("total"), F.lit(0.999))) \
            .where((F.col("v") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)).select("pattern", "kind", "confidence")
        scores = staged(scores, "patterns")
        new = weights.join(known, "value", "left_anti").join(scores, "pattern") \
            .where(mail == (F.col("kind") == 0)) \
            .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score")) \
            .where(F.col("score") >= INSTANCE) \
            .groupBy("value").agg(F.min_by("kind", F.struct(-F.col("score"), "kind")).alias("kind"))
        new = staged(new, "instances")
        unstage(scores)
        if new.isEmpty():
            break
        known, old = staged(known.unionByName(new), "known"), known
        unstage(old)
        unstage(new)
    final = staged(known.groupBy("value").agg(F.min("kind").alias("kind")), "final")
    added = staged(near.where("kind < 0").select("row", "start", "end", "value").join(final, "value")
                   .groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")), "added")
    for old in (weights, known, new, final):
        unstage(old)
    return added


def spans_text(spans) -> F.Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans) for every row: sorted arrays of (start, kind number, end) in code points.

    ``spans`` holds the base matches and what the patterns add; added spans overlap no base match.
    Null and empty texts have none; repeated rows are searched one by one; an empty table gives no
    rows; null keys are kept.
    """
    ship_package(docs.sparkSession)
    found = staged(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(_find, _FOUND), "found")
    added = discover(found, docs, text)
    if added is None:
        return found.select(F.col("key").alias(key), "base", F.col("base").alias("spans"))
    got = found.select("row", "key", "base").join(added, "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.expr("array()").cast("array<struct<start:int,kind:int,end:int>>"))))
    return got.select(F.col("key").alias(key), "base", spans.alias("spans"))


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans, text): every row's text with its base matches replaced by their kinds in brackets."""
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            out, strings = [], []
            for t in batch.column(1).to_pylist():
                spans = base_spans(t) if t else []
                at, parts = 0, []
                for s, k, e in spans:
                    if s >= at:
                        parts += [t[at:s], f"[{KINDS[k]}]"]
                    at = max(at, e)
                out.append(None if t is None else "".join([*parts, t[at:]]))
                strings.append(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(strings, pa.string()), pa.array(out, pa.string())],
                                             names=["key", "spans", "text"])
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")) \
        .mapInArrow(run, "key long, spans string, text string").withColumnRenamed("key", key)
