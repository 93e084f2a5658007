"""Nested runs: chains, loops, orphans, repeated rows."""

from weekcast.plans import runlog


def tree(spark, rows):
    df = spark.createDataFrame(rows, "run_id string, parent_run_id string")
    got = runlog.run_tree(df).collect()
    assert len(got) == len({r["run_id"] for r in got})
    return {r["run_id"]: (r["root_run_id"], r["depth"], r["n_children"], r["status"]) for r in got}


def test_long_chain_and_wide_root(spark):
    chain = [(f"c{i:03d}", f"c{i - 1:03d}" if i else None) for i in range(100)]
    wide = [("w", None), *[(f"w{i}", "w") for i in range(300)], ("leaf", "w7")]
    got = tree(spark, chain + wide)
    assert all(got[f"c{i:03d}"] == ("c000", i, int(i < 99), "nested" if i else "root") for i in range(100))
    assert got["w"] == ("w", 0, 300, "root") and got["leaf"] == ("w", 2, 0, "nested") and got["w7"] == ("w", 1, 1, "nested")


def test_orphans_loops_repeats_and_nulls(spark):
    got = tree(spark, [("a", "gone"), ("b", "a"), ("b", "a"), ("x", "y"), ("y", "z"), ("z", "x"), ("below", "x"), ("self", "self"),
                       (None, "a"), (None, None), ("two", "b"), ("two", "x")])
    assert got == {"a": ("a", 0, 1, "orphan"), "b": ("a", 1, 1, "nested"), "two": ("a", 2, 0, "nested"),
                   **{k: (None, None, n, "cycle") for k, n in (("x", 2), ("y", 1), ("z", 1), ("below", 0), ("self", 1))}}
    assert tree(spark, []) == {}
