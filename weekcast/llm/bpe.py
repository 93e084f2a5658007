"""Byte-level BPE by a local rank file: texts to ids and ids back to bytes, with the tiktoken library.

The library's expression engine backs up through a run of white space on a stack of fixed size and
gives up on very long runs, so a long text is cut first, at places where the split rule always starts
a new piece: before white space that follows something else, and, inside a run of white space, before
its last character.  What follows such a place does not depend on what stands before it, so the ids of
the parts, one after the other, are those of the text.  Ids stand for bytes, not for characters: a
character may be spread over ids of several tokens, so decoding joins bytes and never guesses at text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.session import ship_package

#: Texts longer than this are cut; white-space runs longer than RUN are pieces of their own.
PART = 1 << 17
RUN = 1 << 12
#: Rows of an Arrow batch handled at once.
ROWS = 256

_RUN = regex.compile(r"\s{%d,}" % RUN)
_BREAK = regex.compile(r"(?<=\S)(?=\s)")


@functools.cache
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (lines of base64 bytes and rank) and a split pattern, once per worker."""
    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def parts(text: str) -> list[tuple[str, bool]]:
    """(part, whole): the text cut at safe places; ``whole`` marks a part that is one piece, which the
    expression engine must not see."""
    if len(text) <= RUN:
        return [(text, False)]
    out: list[tuple[str, bool]] = []
    at = 0
    for run in _RUN.finditer(text):
        _cut(text, at, run.start(), out)
        # a word takes the last white-space character if it is a space; at the end the run stays whole
        at = run.end() if run.end() == len(text) else run.end() - 1
        out.append((text[run.start():at], True))
    _cut(text, at, len(text), out)
    return out


def _cut(text: str, start: int, stop: int, out: list[tuple[str, bool]]) -> None:
    while stop - start > PART:
        found = _BREAK.search(text, start + PART, stop)
        if not found:
            break
        out.append((text[start:found.start()], False))
        start = found.start()
    if start < stop:
        out.append((text[start:stop], False))


def encode_text(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of one text, as ``enc.encode_ordinary`` gives them where it can take the text at once."""
    got = [np.array(enc._encode_single_piece(part) if whole else enc.encode_ordinary(part), np.int32)
           for part, whole in parts(text)]
    return got[0] if len(got) == 1 else np.concatenate([np.zeros(0, np.int32), *got])


def encode(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text",
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, ids): the ids of every text, row by row in the scan's own tasks.

    The split rule must keep white space apart as the default does: a piece never holds anything
    followed by white space.  Strings of special tokens are ordinary text.  Null and empty texts have
    no ids; repeated rows and null keys are kept as they are; an empty table gives no rows; other
    columns are not read, so their names cannot clash.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoding(ranks, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                rows = batch.slice(lo, ROWS)
                ids = [encode_text(enc, t) if t else np.zeros(0, np.int32) for t in rows.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids), pa.int32())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)],
                                                 names=["key", "ids"])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(rows: DataFrame, ranks: str, key: str = "doc_id", ids: str = "ids",
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, ids, bytes): the bytes that every row's ids stand for.

    Null and empty arrays give no bytes; ids of the rank file only, without nulls, others fail;
    repeated rows and null keys are kept; an empty table gives no rows.
    """
    ship_package(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoding(ranks, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = [enc.decode_bytes(i) if i else b"" for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())],
                                                 names=["key", "ids", "bytes"])
    return rows.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids")) \
        .mapInArrow(run, f"key {kind}, ids array<int>, bytes binary").withColumnsRenamed({"key": key, "ids": ids})
