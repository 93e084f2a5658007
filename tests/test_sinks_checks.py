"""Catalog, sinks, schema composition and checks (unit tests only)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.operators import checks
from weekcast.plans import tuning
from weekcast.session import scratch_path
from weekcast.sources import sinks


def test_database_lifecycle(spark):
    loc = scratch_path(spark, "db_demo", unique=True)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wc_demo LOCATION '{loc}'")
    spark.sql("USE wc_demo")
    try:
        spark.range(3).write.mode("overwrite").saveAsTable("t")
        assert spark.table("wc_demo.t").count() == 3
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE wc_demo CASCADE")
    assert not spark.catalog.databaseExists("wc_demo")


def test_build_or_reuse(spark):
    path = scratch_path(spark, "reuse_demo", unique=True)
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    sinks.build_or_reuse(spark, "wc_reuse_demo", path, build, reset=True)
    assert sinks.build_or_reuse(spark, "wc_reuse_demo", path, build).count() == 5
    assert len(calls) == 1
    spark.sql("DROP TABLE wc_reuse_demo")


def test_metric_names_must_be_quote_free(spark):
    import pytest
    bad = spark.createDataFrame([('a"b', 1.0)], "name string, value double")
    with pytest.raises(Exception, match="quotes"):
        sinks.write_metrics(bad, scratch_path(spark, "bad_metrics", unique=True))


def test_compose_schema_and_expectations(spark):
    base = T.StructType([T.StructField("a", T.StringType())])
    full = checks.compose_schema([T.StructField("z", T.IntegerType())], base)
    assert full.fieldNames() == ["z", "a"]
    df = spark.createDataFrame([], full)
    want = T.StructType([T.StructField("z", T.LongType()), T.StructField("a", T.StringType()), T.StructField("q", T.IntegerType())])
    got = {r["column_name"]: (r["actual"], r["ok"], r["n_values"]) for r in checks.schema_rows(df, "t", want).collect()}
    assert got == {"z": ("int", False, 0), "a": ("string", True, 0), "q": (None, False, 0)}


def listing(spark, n=60):
    return spark.createDataFrame([(i, "a" if i % 2 else "b", "new" if i == 9 else "c", float(i % 5), float(i)) for i in range(n)],
                                 "p_partkey long, p_brand string, p_type string, p_size double, price double")


def test_forest_saves_with_its_features(spark):
    from pyspark.ml import PipelineModel
    df = listing(spark)
    step = tuning.FeatureStep(df)
    path = scratch_path(spark, "pipeline_model", unique=True)
    step.with_forest(step.forest(2, 3).fit(step.indexed(df))).write().overwrite().save(path)
    assert PipelineModel.load(path).transform(df).count() == 60


def test_unseen_labels_are_skipped_and_counted(spark):
    df = listing(spark)  # the row with key 9 is a test row, its label is in no train row
    got = {r["split"]: tuple(r)[1:] for r in tuning.forest_checks(df).collect()}
    assert got == {"train": (36, 0, 36), "val": (12, 0, 12), "test": (12, 1, 11)}
    assert tuning.indexed_listing(df).where("p_partkey = 9").count() == 0


def test_bins_follow_the_number_of_labels(spark):
    df = spark.range(120).selectExpr("id p_partkey", "concat('b', id) p_brand", "'x' p_type", "cast(id as double) p_size", "cast(id as double) price")
    step = tuning.FeatureStep(df)
    assert step.bins() == 120
    assert step.forest(2, 2).fit(step.indexed(df)).transform(step.indexed(df)).count() == 120


def test_string_index_order_matches_mllib(spark):
    from pyspark.ml.feature import StringIndexer
    df = spark.createDataFrame([(x,) for x in "bbbaaccd"], "c string")
    labels = StringIndexer(inputCol="c", outputCol="ci").fit(df).labels
    got = [r["label"] for r in tuning.string_index_labels(df, ["c"]).orderBy("idx").collect()]
    assert got == labels == ["b", "a", "c", "d"]


def test_pandas_frame_with_array_columns(spark):
    import pandas as pd
    pdf = pd.DataFrame({"id": [1, 2], "ar": [[0.5, 0.2], [0.7]], "ma": [[0.1], [0.3, 0.2, 0.1]]})
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("ar", T.ArrayType(T.DoubleType())),
                           T.StructField("ma", T.ArrayType(T.DoubleType()))])
    df = spark.createDataFrame(pdf, schema=schema)
    got = {r["id"]: r for r in df.select("id", F.concat(F.array(F.lit(1.0)), "ar").alias("ar1"),
                                          F.size("ma").alias("nq")).collect()}
    assert got[1]["ar1"] == [1.0, 0.5, 0.2] and got[2]["nq"] == 3


def test_run_log_append_and_read(spark):
    from weekcast.plans import runlog
    path = scratch_path(spark, "runlog_demo", unique=True)
    trials = spark.createDataFrame([("trial", 2, 10, 3.0), ("trial", 3, 40, 2.5), ("final", 3, 40, 2.4)],
                                   "stage string, max_depth int, num_trees int, rmse double")
    runlog.append_runs(runlog.trial_runs(trials, "parent-1"), path)
    runlog.append_runs(runlog.trial_runs(trials.limit(1), "parent-2"), path)
    log = runlog.read_runs(spark, path)
    assert log.count() == 4
    again = sorted(r[0] for r in runlog.trial_runs(trials.repartition(3), "parent-1").select("run_id").collect())
    assert again == sorted(r[0] for r in log.filter("parent_run_id = 'parent-1'").select("run_id").collect())
    assert log.filter(F.col("parent_run_id") == "parent-1").count() == 3
    best = log.filter(F.col("tags")["stage"] == "trial").orderBy(F.col("metrics")["rmse"]).first()
    assert best["params"]["maxDepth"] == "3"


def test_overwrite_table_and_read_catalog_table(spark):
    from weekcast.sources.tables import read_catalog_table
    sinks.overwrite_table(spark.range(4).withColumn("x", F.col("id") * 2), "wc_catalog_demo")
    sinks.overwrite_table(spark.range(3).withColumn("x", F.col("id") * 3), "wc_catalog_demo")
    got = sorted(r["x"] for r in read_catalog_table(spark, "wc_catalog_demo", ["x"]).collect())
    assert got == [0, 3, 6]
    spark.sql("DROP TABLE wc_catalog_demo")
