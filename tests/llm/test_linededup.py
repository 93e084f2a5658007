"""Line deduplication: alignments by hand, whole jobs, odd rows."""

import random
import re

from tests.conftest import SF_SMALL
from weekcast.llm import linededup, queries

WHITE = " \t\n\r\x0b\x0c"


def removed(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, gone int, h int")
    return {r["doc_id"]: r for r in linededup.dedup(df, **more).collect()}


def row(i, lines):
    return (i, "\n".join(lines) if lines is not None else None, "x", 1, 2)


def test_alignment_keeps_order():
    # 0..3 stand in order, 5 moved against it
    assert linededup.match([1, 2, 3, 9, 8, 7], [6, 7, 5, 4, 1, 2, 3, 9]) == [(0, 4), (1, 5), (2, 6), (3, 7)]
    assert linededup.match([1, 2], [3, 4]) == [] and linededup.match([], [1]) == []
    assert linededup._increasing([(0, 5), (1, 1), (2, 2), (3, 3)]) == [(1, 1), (2, 2), (3, 3)]


def test_blocks_go_from_the_later_document(spark):
    shared = ["alpha beta gamma", "delta epsilon", "zeta eta theta iota"]
    got = removed(spark, [row(1, ["own one", *shared, "own two"]), row(2, ["other", "", *shared]),
                          row(3, ["  alpha beta gamma ", "mine"]), row(4, None), row(5, []), row(6, ["alone", "alone"])])
    assert got[1]["text"] == "own one\n" + "\n".join(shared) + "\nown two" and got[1]["_n_removed"] == 0
    assert got[2]["text"] == "other\n" and (got[2]["_n_lines"], got[2]["_n_removed"]) == (4, 3)
    assert got[3]["text"] == "mine"
    assert got[4]["text"] is None and got[5]["text"] == "" and got[6]["text"] == "alone\nalone"


def test_frequent_lines_stay_but_passages_and_copies_go(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [row(i, [f"own {i}", "all rights reserved", f"more {i}"]) for i in range(20)]
    rows += [row(100 + i, [f"text {i}", long]) for i in range(20)] + [row(200 + i, ["short copy", "of two lines"]) for i in range(20)]
    got = removed(spark, rows)
    assert all(got[i]["_n_removed"] == 0 for i in range(20))
    assert [got[100 + i]["_n_removed"] for i in range(20)] == [0] + [1] * 19
    assert [got[200 + i]["text"] for i in range(20)] == ["short copy\nof two lines"] + [""] * 19


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [row(7, ["a b c", "d"]), row(7, ["a b c", "d"]), row(None, ["a b c"]), row(7, ["other"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, gone int, h int")
    got = sorted((r["doc_id"] is not None, r["text"], r["_n_removed"]) for r in linededup.dedup(df).collect())
    assert got == [(False, "a b c", 0), (True, "d", 1), (True, "d", 1), (True, "other", 0)]
    assert linededup.dedup(df.limit(0)).count() == 0


def test_repeated_lines_on_either_side(spark):
    part = [" ".join(f"p{i}w{j}" for j in range(6)) for i in range(10)]
    rows = [row(1, ["a", "a"]), row(2, ["a", "a"]), row(3, ["x", *part, "y", *part, "z"])]
    rows += [row(4 + i, [f"own {i}", *part]) for i in range(12)] + [row(20, ["b", *part, "c", *part])]
    got = removed(spark, rows)
    assert got[1]["_n_removed"] == 0 and got[2]["text"] == ""
    assert got[3]["_n_removed"] == 0 and got[20]["text"] == "b\nc"
    assert all(got[4 + i]["text"] == f"own {i}" for i in range(12))
    assert linededup.match([1, 2, 9, 1, 2], [1, 2]) == [(0, 0), (1, 1)]
    assert linededup.match([5, 1, 1, 6, 1], [1, 1, 7, 6]) == [(1, 0), (2, 1), (3, 3)]


def test_a_passage_whose_lines_stand_in_other_documents(spark):
    part = [" ".join(f"p{i}w{j}" for j in range(6)) for i in range(10)]
    rows = [row(i, [f"first {i}", p]) for i, p in enumerate(part)] + [row(50 + i, [f"own {i}", *part]) for i in range(12)]
    # a short document of frequent lines that stands inside a longer one; its lines come first elsewhere
    rows += [row(100 + i, [f"top {i}", "one", f"mid {i}", "two"]) for i in range(9)]
    rows += [row(120, ["head", "one", "two", "tail"]), row(121, ["one", "two"])]
    got = removed(spark, rows)
    assert got[50]["_n_removed"] == 0
    assert all(got[51 + i]["text"] == f"own {1 + i}" for i in range(11))
    assert got[120]["_n_removed"] == 0 and got[121]["text"] == ""


def plain_dedup(texts):
    """{doc: (lines, removed, text)} by comparing every two documents that may overlap, in plain Python."""
    held, own = {}, {}
    for d in sorted(texts):
        own[d] = [(i, x.strip(WHITE)) for i, x in enumerate((texts[d] or "").split("\n")) if x.strip(WHITE)]
        for line in {x for _, x in own[d]}:
            held.setdefault(line, []).append(d)
    gone = {d: set() for d in texts}

    def size(line):
        return len([w for w in re.split(r"[\x20\x09-\x0D]+", line) if w])

    def runs(d):
        """Runs of neighbouring frequent lines; whether one is asked for (just a passage, or all of the document)."""
        h, out = [x for _, x in own[d]], {}
        for i in range(len(h)):
            for step in (1, -1):
                j, words = i, 0
                while 0 <= j < len(h) and len(held[h[j]]) > 8:
                    words += size(h[j])
                    run = tuple(h[min(i, j):max(i, j) + 1])
                    out[run] = out.get(run, False) or words >= 50 or len(run) == len(h)
                    if words >= 50:
                        break
                    j += step
        return out
    all_runs, first = {d: runs(d) for d in texts}, {}
    for d in sorted(texts):
        for run in all_runs[d]:
            first.setdefault(run, d)
    for d in sorted(texts):
        others = {e for _, x in own[d] if len(held[x]) <= 8 for e in held[x] if e < d}
        others |= {first[run] for run, asked in all_runs[d].items() if asked and first[run] < d}
        for e in others:
            # lines held by one document alone cannot be aligned
            a, b = [[(r, i, x) for r, (i, x) in enumerate(own[f]) if x in {y for _, y in own[g]}] for f, g in ((d, e), (e, d))]
            ids = {x: n for n, x in enumerate(dict.fromkeys(x for _, _, x in a + b))}
            block, last = [], None
            for pair in [*linededup.match([ids[x] for *_, x in a], [ids[x] for *_, x in b]), None]:
                here = pair and (a[pair[0]][0], b[pair[1]][0])
                if block and (here is None or here != (last[0] + 1, last[1] + 1)):
                    lines = [x for _, _, x in block]
                    if any(len(held[x]) <= 8 for x in lines) or sum(map(size, lines)) >= 50 or len(block) == len(own[d]):
                        gone[d] |= {i for _, i, _ in block}
                    block = []
                if pair:
                    block.append(a[pair[0]])
                last = here
    return {d: (len(own[d]), len(gone[d]), None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]))
            for d, t in texts.items()}


def test_whole_job_equals_brute_force(spark):
    rng = random.Random(5)
    lines = [" ".join(f"v{rng.randrange(60)}" for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    passages = [lines[i:i + 8] for i in range(0, 40, 8)]
    texts = {}
    for d in range(150):
        parts = [f"own {d} {i}" for i in range(rng.randrange(4))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = rng.choice(passages) if rng.random() < 0.4 else rng.choices(lines, k=rng.randrange(1, 4))
        if d > 20 and rng.random() < 0.2:
            parts = texts[rng.randrange(d)].split("\n")[rng.randrange(3):]
        texts[d] = "\n".join(parts)
    got = {r["doc_id"]: (r["_n_lines"], r["_n_removed"], r["text"]) for r in removed(spark, [(d, t, "x", 1, 2) for d, t in texts.items()]).values()}
    assert got == plain_dedup(texts)
    assert sum(r > 0 for _, r, _ in got.values()) > 50


def test_very_long_texts_and_names_of_the_new_columns(spark):
    shared = [f"line {i} of many" for i in range(100_000)]
    rows = [(1, "\n".join(["first", *shared])), (2, "\n".join(x for i, s in enumerate(shared) for x in ([s, f"mine {i}"] if i % 2 else [s]))),
            (3, "word " * 200_000), (4, "word " * 200_000 + "\nend")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS _n_lines", "doc_id AS _n_removed")
    got = {r["doc_id"]: r for r in linededup.dedup(df).collect()}
    assert list(df.columns) == list(got[1].asDict()) and got[1]["_n_removed"] == 0
    assert got[2]["_n_removed"] == 100_000 and got[2]["text"] == "\n".join(f"mine {i}" for i in range(1, 100_000, 2))
    assert got[3]["_n_removed"] == 0 and got[4]["text"] == "end"


def test_op2_covers_all_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op2_line_dedup(spark, SF_SMALL).collect()}
    assert got.keys() == docs.keys()
    first = {}
    for d in sorted(docs):
        lines = [x.strip(" \t\r\x0b\x0c") for x in docs[d].split("\n")]
        lines = [x for x in lines if x]
        assert got[d]["n_lines"] == len(lines)
        # a text that an earlier document holds word for word is removed whole
        whole = tuple(lines)
        if whole in first and whole:
            assert got[d]["n_removed"] == len(lines)
        first.setdefault(whole, d)
    assert any(r["n_removed"] for r in got.values())
