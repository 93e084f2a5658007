"""Merkle manifest: against a plain construction, at several depths, and with odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekcast.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i:i + 16]) for i in range(0, len(low), 16)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        lo = at - at % 16
        yield level[lo:at], level[at + 1:lo + 16]
        at //= 16


def plain(rows, tamper):
    """(doc_id, leaf, subroot, root, proof, folded) of rows (doc_id, source, lang, n_chars, text)."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(((r[0] is not None, r[0] or 0, plain_leaf(r), r) for r in rows if r[1] == s), key=lambda x: x[:3])
        trees.append((own, climb([x[2] for x in own])))
    top = climb([t[1][-1][0] for t in trees])
    out = []
    for k, (own, levels) in enumerate(trees):
        for i, (_, _, leaf, row) in enumerate(own):
            steps = [*siblings(levels, i), *siblings(top, k)]
            node = plain_leaf(tamper(row))
            for before, after in steps:
                node = h(*before, node, *after)
            out.append((row[0], leaf, levels[-1][0], top[-1][0], "".join("".join(b + a) for b, a in steps), node))
    return out


def lowered(row):
    if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
        return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
    return row


def key(r):
    return tuple((v is not None, v if v is not None else "") for v in r)


DDL = "doc_id long, source string, lang string, n_chars long, text string"


def test_op11_equals_the_plain_manifest(spark):
    rows = [tuple(r[c] for c in merkle.FIELDS) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, SF_SMALL).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    want = [(d, leaf, sub, root, h(proof), fold, fold == root) for d, leaf, sub, root, proof, fold in plain(rows, lowered)]
    assert sorted(got) == sorted(want)
    assert {g[-1] for g in got} == {True, False}


@pytest.mark.parametrize("depth", [1, 2])
def test_many_levels_and_sources(spark, depth):
    """A hot source of several levels, sources at the edges of a run, the null source, more than 16 sources."""
    sizes = {"hot": 16 ** 2 * 3 + 5, None: 17, "a": 1, "é": 16, "z": 33, "": 256, "b": 257}
    sizes |= {f"s{i}": 1 + i % 3 for i in range(40)}
    rows = [(i, s, "en", i, f"Text {i} of {s}") for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, DDL)
    tampered = {"text": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lower("text")).otherwise(F.col("text"))}
    got = merkle.audit(df, presented=tampered, depth=depth).collect()
    want = plain(rows, lowered)
    assert sorted((key((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"])) for r in got)) == sorted(map(key, want))
    for r in got[::37]:
        assert merkle.fold(r["leaf"], r["proof"], r["places"], r["sizes"]) == r["root"]


def test_odd_rows(spark):
    """Nulls in every column, repeated rows and ids, empty and long texts, extra columns with the names used inside."""
    rows = [(1, "a", None, 3, "ABC"), (1, "a", None, 3, "ABC"), (1, "a", "x", None, None), (None, "a", "x", 0, ""),
            (None, None, None, None, None), (5, None, "é", 1, "É" * 400_000), (7, "b", "", 1, "\x00\n")]
    df = spark.createDataFrame(rows, DDL)
    for c in ("key", "grp", "leaf", "presented", "row", "tree", "n", "first", "pos", "block", "pack", "node", "proof", "root"):
        df = df.withColumn(c, F.lit("x"))
    got = merkle.audit(df).collect()
    assert sorted(key((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"])) for r in got) \
        == sorted(map(key, plain(rows, lambda r: r)))
    assert all(r["verified"] for r in got)
    one = merkle.audit(df.where("doc_id = 7")).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == ""
    assert merkle.audit(df.limit(0)).count() == 0
