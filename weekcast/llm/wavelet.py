"""Token files as wavelet matrices: one compressed file per shard of a corpus.

A shard holds the ids of consecutive documents as bit planes, highest bit first; each plane is kept
in the order that stable partitions by the planes above it give.  The file also holds the number of ones
before every _STEP bytes of a plane: by these samples a token is read, counted or located (access, rank,
select) with a look at a few stretches of each plane, without decoding the shard.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekcast.llm.pieces import encoder
from weekcast.session import scratch_path, ship_package

#: Ids per shard; a shard holds at least one document, whatever its length.
SHARD_TOKENS = 1 << 22
_MAGIC = b"WAV2"
_STEP = 64  # bytes of a plane between two popcount samples


class WaveletMatrix:
    """Sequence of unsigned integers with access, rank, select and decode over bit planes."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ones: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ones = n, planes, zeros, ones

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        v = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros, ones = [], [], []
        for k in range(width - 1, -1, -1):
            bit = ((v >> v.dtype.type(k)) & v.dtype.type(1)).astype(bool)
            planes.append(np.packbits(bit))
            ones.append(_samples(planes[-1]))
            low = v[~bit]
            zeros.append(len(low))
            v = np.concatenate([low, v[bit]])
        return cls(len(ids), planes, zeros, ones)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.planes), *self.zeros], "<u8")
        return _MAGIC + head.tobytes() + b"".join(o.astype("<u4").tobytes() + p.tobytes() for o, p in zip(self.ones, self.planes))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != _MAGIC:
            raise ValueError("not a wavelet shard")
        n, width = (int(x) for x in np.frombuffer(data, "<u8", 2, 4))
        zeros = np.frombuffer(data, "<u8", width, 20).tolist()
        size = (n + 7) // 8
        blocks = -(-size // _STEP) + 1
        at, step = 20 + 8 * width, 4 * blocks + size
        return cls(n, [np.frombuffer(data, np.uint8, size, at + k * step + 4 * blocks) for k in range(width)], zeros,
                   [np.frombuffer(data, "<u4", blocks, at + k * step) for k in range(width)])

    def decode(self) -> np.ndarray:
        """All ids in order: the partitions undone from the last plane to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        v = np.zeros(self.n, kind)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            bit = np.unpackbits(plane, count=self.n).view(bool)
            out = np.empty(self.n, kind)
            out[~bit] = v[:zeros]
            out[bit] = v[zeros:] | kind(1 << k)
            v = out
        return v

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        plane, byte = self.planes[level], i >> 3
        block = byte // _STEP
        n = int(self.ones[level][block]) + int(np.bitwise_count(plane[block * _STEP:byte]).sum())
        return n + (int(plane[byte] >> (8 - (i & 7))).bit_count() if i & 7 else 0)

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1
            ones = self._rank1(level, i)
            value, i = value << 1 | bit, zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among the first ``i`` ids end up after the last plane."""
        lo, hi, width = 0, i, len(self.planes)
        if token >> width:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (width - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int | None = None) -> int:
        """Occurrences of ``token`` among the first ``i`` ids (all by default)."""
        lo, hi = self._range(token, self.n if i is None else i)
        return hi - lo

    def _select(self, level: int, bit: int, at: np.ndarray) -> np.ndarray:
        """Positions of the ``at``-th ones or zeros (from 0) of a plane: the sample before each, then a look
        at its stretch.  Where they are a good part of the plane, it is unpacked once."""
        plane, ones = self.planes[level], self.ones[level].astype(np.int64)
        if len(at) * _STEP * 8 > self.n:
            bits = np.unpackbits(plane, count=self.n)
            return np.flatnonzero(bits == bit)[at]
        before = ones if bit else np.arange(len(ones)) * _STEP * 8 - ones
        block = np.searchsorted(before[:-1], at, side="right") - 1
        rows = block[:, None] * _STEP + np.arange(_STEP)
        bits = np.unpackbits(np.append(plane, np.uint8(0))[np.minimum(rows, len(plane))], axis=1) == bit
        inside = np.argmax(np.cumsum(bits, axis=1) > (at - before[block])[:, None], axis=1)
        return block * _STEP * 8 + inside

    def _back(self, token: int, at: np.ndarray) -> np.ndarray:
        """Positions in the text of places below the last plane, followed back through the planes."""
        width = len(self.planes)
        for level in range(width - 1, -1, -1):
            if not len(at):
                break
            one = token >> (width - 1 - level) & 1
            at = self._select(level, one, at - self.zeros[level] if one else at)
        return at

    def occurrences(self, token: int) -> np.ndarray:
        """Positions of ``token``, ascending."""
        lo, hi = self._range(token, self.n)
        return self._back(token, np.arange(lo, hi))

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of ``token``; -1 if there are fewer."""
        lo, hi = self._range(token, self.n)
        return int(self._back(token, np.array([lo + k]))[0]) if 0 <= k < hi - lo else -1


def _samples(plane: np.ndarray) -> np.ndarray:
    """Ones before every _STEP bytes of a plane, and in all of it."""
    if not len(plane):
        return np.zeros(1, np.int64)
    count = np.bitwise_count(plane)
    return np.append(0, np.cumsum(np.add.reduceat(count, np.arange(0, len(plane), _STEP), dtype=np.int64)))


_SHARD = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("matrix", pa.binary())])
_SHARD_DDL = "part long, shard long, n_tokens long, ids array<long>, sizes array<long>, matrix binary"


def _encode(path: str, end_id: int, shard_tokens: int):
    def run(batches):
        part, shard, keys, parts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            ids = np.concatenate(parts)
            row = {"part": [part], "shard": [shard], "n_tokens": [len(ids)], "ids": [list(keys)],
                   "sizes": [[len(p) for p in parts]], "matrix": [WaveletMatrix.build(ids).to_bytes()]}
            return pa.RecordBatch.from_pydict(row, schema=_SHARD)
        end = np.array([end_id], np.uint32)
        enc = encoder(path)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(docs), 256):
                for key, ids in zip(docs[lo:lo + 256], enc.encode([t or "" for t in texts[lo:lo + 256].to_pylist()])):
                    keys.append(key)
                    parts.append(np.concatenate([ids, end]))
                    held += len(parts[-1])
                    if held >= shard_tokens:
                        yield flush()
                        shard, keys, parts, held = shard + 1, [], [], 0
        if parts:
            yield flush()
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, key: str = "doc_id",
          text: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every text, append ``end_id`` and write the shards, one file each, in ascending key order.

    Rows are dealt by ranges of key, start and hash of the text, so order needs no single task, not even
    for rows that share a key; null keys come first, rows of one key are ordered by the first characters of
    their texts, then by a hash; null and empty texts hold the end id alone.  An empty table writes no shard.  Spark's writer commits the files, so a lost executor only repeats its tasks.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")) \
        .select("*", F.substring("text", 1, 64).alias("head"), F.xxhash64("text").alias("hash"))
    rows = rows.repartitionByRange("key", "head", "hash").sortWithinPartitions("key", "head", "hash").select("key", "text")
    rows.mapInArrow(_encode(tokenizer, end_id, shard_tokens), _SHARD_DDL) \
        .write.option("maxRecordsPerFile", 1).option("compression", "zstd").mode("overwrite").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard files with ``start``, the number of ids before each: sums over the parts, then
    inside each part, so that no task sees more than one part's shards."""
    read = spark.read.schema(_SHARD_DDL).parquet(path)
    sizes = read.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per part written
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    starts = sizes.select("part", "shard", own.alias("own")).join(parts, "part") \
        .select("part", "shard", (F.col("before") + F.col("own")).alias("start"))
    return read.join(starts, ["part", "shard"])


def _documents(batches):
    schema = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("key", pa.int64()), ("own", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in range(batch.num_rows):
            part, shard, keys, sizes, matrix = (batch.column(i)[row] for i in range(5))
            ids = WaveletMatrix.from_bytes(matrix.as_buffer()).decode().astype("<u4")
            size = np.array(sizes.as_py(), np.int64)
            stop = np.cumsum(size)
            crc = [zlib.crc32(ids[b - n:b].tobytes()) for b, n in zip(stop.tolist(), size.tolist())]
            n = len(size)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part.as_py())), pa.array(np.full(n, shard.as_py())), keys.values.cast(pa.int64()),
                pa.array(stop - size), pa.array(size), pa.array(crc, pa.int64())], schema=schema)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, decoded from the shard files."""
    read = spark.read.schema(_SHARD_DDL).parquet(path)
    rows = read.select("part", "shard", "ids", "sizes", "matrix").mapInArrow(
        _documents, "part long, shard long, key long, own long, n_tokens long, ids_crc32 long")
    starts = shards(spark, path).select("part", "shard", "start")
    return rows.join(starts, ["part", "shard"]) \
        .select("key", (F.col("start") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def find(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(position) of every occurrence of a token in the whole corpus, by select on each shard."""
    def run(batches):
        for batch in batches:
            for matrix, start in zip(batch.column(0), batch.column(1).to_pylist()):
                at = WaveletMatrix.from_bytes(matrix.as_buffer()).occurrences(token) + start
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["position"])
    return shards(spark, path).select("matrix", "start").mapInArrow(run, "position long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text",
                shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards of ``docs`` to a new folder and return what the files hold per document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files", unique=True)
    write(docs, path, tokenizer, end_id, key, text, shard_tokens)
    return documents(spark, path).withColumnRenamed("key", key)
