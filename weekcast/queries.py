"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the given tables (or data Spark derives from them) in full; the
matching DuckDB SQL for the exact-oracle checks lives in ``weekcast.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.functions import calendar as cal
from weekcast.functions import scalar
from weekcast.operators import arma, checks, diff, ranking, sampling, search, series, smoothing, stationarity, trees
from weekcast.plans import demand, forecast, manymodels, runlog, tuning
from weekcast.session import checkpoint, scratch_path, unique_name
from weekcast.sources import inputs, sinks
from weekcast.sources.tables import read_catalog_table, read_table

KEYS = inputs.SERIES_KEY
H = forecast.HORIZON
EVENT = cal.TEST_EVENT
RUN_ID = "weekcast-run-1"
Query = Callable[[SparkSession, str], DataFrame]


def _weekly(spark, sf):
    return inputs.weekly(spark, sf)


def _dense(spark, sf):
    """Weekly demand on every Monday of each series; weeks without shipments are 0."""
    return forecast.dense(inputs.weekly(spark, sf))


def _weekly_materialised(spark, sf):
    """Weekly demand written once to the shared checkpoint folder, for queries
    that read it more than once (a drill-down needs the key first, then its
    rows).  The table is series x weeks, far smaller than its source scan."""
    return checkpoint(inputs.weekly(spark, sf))


# --- scans, sources, sinks -------------------------------------------------

def weekly_demand(spark, sf):
    """Weekly demand per (product, sku): the standing `weekly` input."""
    return _weekly(spark, sf).select(*KEYS, "wk", "demand")


def row_count(spark, sf):
    """Row count of the weekly table, through the SQL API over a temporary view."""
    view = unique_name("weekly_view")
    _weekly(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT COUNT(*) AS row_count FROM {view}")


def range_rows(spark, sf):
    """Lineitem rows numbered 0..N-1 in key order, with device = number % 10."""
    rows = ranking.global_row_number(read_table(spark, sf, "lineitem", inputs.ROW_KEY), inputs.ROW_KEY, "_row")
    record = F.col("_row") - 1
    return rows.select(*inputs.ROW_KEY, record.alias("record_id"), (record % 10).alias("device_id"))


def rand_columns(spark, sf):
    """Reproducible uniforms per lineitem row: a hash of the row key and a seed
    (partition-seeded ``rand`` would change with the input's partitioning)."""
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = read_table(spark, sf, "lineitem", inputs.ROW_KEY)
    f = [scalar.hash_uniform(key, seed) * float(scale) for seed, scale in ((1, 1), (2, 2), (3, 3))]
    return rows.select(*inputs.ROW_KEY, *[c.alias(f"feature_{i + 1}") for i, c in enumerate(f)],
                       (f[0] + f[1] + f[2] + scalar.hash_uniform(key, 4)).alias("label"))


def write_readback(spark, sf):
    """Weekly table written to a new folder, registered, read back and summed per product; table and
    folder are removed once the sums are kept."""
    table, path = unique_name("weekly_demand"), scratch_path(spark, "weekly_demand", unique=True)
    sinks.overwrite_parquet(_weekly(spark, sf), path)
    sinks.register_external(spark, table, path)
    return _then_remove(spark, _per_product(spark.table(table)), table, path)


def _per_product(weekly):
    return weekly.groupBy("product").agg(F.count(F.lit(1)).alias("n"), F.sum("demand").alias("demand"))


def _then_remove(spark, df, table, path):
    """Keep a small result (one row per group) and remove the table it was read from."""
    kept = checkpoint(df)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    sinks.remove_path(spark, path)
    return kept


def table_roundtrip(spark, sf):
    """Weekly table built once and reused (the second build must not run), then saved again as a
    bucketed catalog table and read from the catalog; sums per product of both.  Both tables live in a
    database of their own, which is dropped with its folder."""
    db, home = unique_name("series"), scratch_path(spark, "series_db", unique=True)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{home}'")
    first, path = f"{db}.built", f"{home}/built_files"
    built = sinks.build_or_reuse(spark, first, path, lambda: _weekly(spark, sf).select(*KEYS, "wk", "demand"))

    def again():
        raise AssertionError("an existing table was built again")
    reused = sinks.build_or_reuse(spark, first, path, again)
    sinks.overwrite_table(built, f"{db}.saved", bucket_by=KEYS, buckets=8, sort_by=[*KEYS, "wk"])
    a = _per_product(reused).withColumn("source", F.lit("built"))
    b = _per_product(read_catalog_table(spark, f"{db}.saved", [*KEYS, "wk", "demand"])).withColumn("source", F.lit("saved"))
    kept = checkpoint(a.unionByName(b))
    spark.sql(f"DROP DATABASE {db} CASCADE")
    sinks.remove_path(spark, home)
    return kept


def metric_csv_roundtrip(spark, sf):
    """Per-product demand written as one CSV metric set and read back with a declared schema."""
    metrics = _weekly(spark, sf).groupBy("product").agg(F.sum("demand").alias("value")) \
        .select(scalar.clean_name(F.col("product")).alias("name"), "value")
    path = scratch_path(spark, "metrics", unique=True)
    sinks.write_metrics(metrics, path)
    kept = checkpoint(sinks.read_metrics(spark, path))
    sinks.remove_path(spark, path)
    return kept


# --- calendar and features -------------------------------------------------

def calendar_q(spark, sf):
    """Every Monday from the first to the last shipment week."""
    return demand.calendar(spark, sf)


def calendar_factors(spark, sf):
    """Calendar with ISO week, weeks-since-event counter, shock and season factors."""
    return demand.calendar_factors(spark, sf, EVENT)


def season_lookup(spark, sf):
    """Season factor of every calendar week, looked up in a table of literal rows."""
    schema = T.StructType([T.StructField("iso_week", T.IntegerType()), T.StructField("factor", T.DoubleType())])
    rows = spark.createDataFrame([(w, f) for w, f in cal.SEASON_FACTORS] + [(53, dict(cal.SEASON_FACTORS)[52])], schema)
    weeks = demand.calendar(spark, sf).withColumn("iso_week", cal.iso_week(F.col("wk")))
    # a handful of literal rows
    return weeks.join(F.broadcast(rows), "iso_week", "left") \
        .select("wk", "iso_week", F.coalesce("factor", F.lit(cal.SEASON_DEFAULT)).alias("season_factor"))


def week_timestamps(spark, sf):
    """Every calendar week as a midnight timestamp, and whether it is at or after the event's."""
    at = F.col("wk").cast("timestamp_ntz")
    return demand.calendar(spark, sf).select("wk", at.alias("at"), (at >= F.lit(EVENT).cast("timestamp_ntz")).alias("after_event"))


def weeks_since_event(spark, sf):
    """Weekly rows with the weeks-since-event counter."""
    return demand.weeks_since_event(_weekly(spark, sf), EVENT)


def series_calendar(spark, sf):
    """Every series paired with every calendar week."""
    return demand.series_calendar(_weekly_materialised(spark, sf))


def adjusted_demand(spark, sf):
    """Weekly demand shaped by the shock, trend and season factors, rounded."""
    return demand.adjusted_demand(_weekly_materialised(spark, sf), EVENT)


def exo_features(spark, sf):
    """Weekly rows with covid, christmas and new_year flags."""
    return demand.exo_features(_weekly(spark, sf), EVENT)


# --- series operators ------------------------------------------------------

def first_series(spark, sf):
    """All rows of the series with the smallest (product, sku) that was shipped.

    The key comes from part and the distinct shipped parts; the weekly
    aggregate then reads the parts of that one series alone.
    """
    part = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_brand"])
    shipped = read_table(spark, sf, "lineitem", ["l_partkey"]).where("l_partkey is not null").distinct()
    first = part.join(shipped, part["p_partkey"] == shipped["l_partkey"], "left_semi") \
        .agg(F.min(F.struct("p_type", "p_brand")).alias("k")).first()["k"]
    if first is None:
        return _weekly(spark, sf).select(*KEYS, "wk", "demand")
    return _weekly(spark, sf).where(F.col("product").eqNullSafe(first["p_type"]) & F.col("sku").eqNullSafe(first["p_brand"])) \
        .select(*KEYS, "wk", "demand")


def series_count(spark, sf):
    """Number of distinct series."""
    return _weekly(spark, sf).select(*KEYS).dropDuplicates().agg(F.count(F.lit(1)).alias("n_series"))


def series_bounds(spark, sf):
    """First/last week, length and first week after the event per series."""
    return series.bounds(_weekly(spark, sf), KEYS, EVENT)


def series_position(spark, sf):
    """Zero-based week position per regular series, warm-up (pos < 10) dropped."""
    w = series.with_position(_dense(spark, sf), KEYS)
    return w.filter(F.col("pos") >= 10).select(*KEYS, "wk", "pos")


def tail_split(spark, sf):
    """Weeks of the regular series flagged as history or hold-out (last 40 weeks)."""
    return series.tail_split(_dense(spark, sf), KEYS, H).select(*KEYS, "wk", "demand", "is_history")


def dense_spine(spark, sf):
    """Supplier series regularised to every Monday, gaps null."""
    return series.regularise(inputs.sparse(spark, sf), ["s_key"], fill="null")


def series_diff(spark, sf):
    """First and second differences per series."""
    return series.differences(_dense(spark, sf), KEYS).select(*KEYS, "wk", "d1", "d2")


def lag_features(spark, sf):
    """Lags 1..4 of demand per series."""
    return series.lags(_dense(spark, sf), KEYS, 4)


def series_packed(spark, sf):
    """Length, first, last and sum read back from each packed series."""
    packed = series.pack(_weekly(spark, sf), KEYS, "wk", ["demand"])
    return series.packed_stats(packed, KEYS)


# --- joins, hierarchy, arrays, sampling, sets, scalars ----------------------

def hierarchy_join(spark, sf):
    """Parts per (type, brand) beside parts per type, both from one scan of part."""
    part = read_table(spark, sf, "part", ["p_type", "p_brand"])
    per_sku = part.groupBy(F.col("p_type").alias("product"), F.col("p_brand").alias("sku")) \
        .agg(F.count(F.lit(1)).alias("n_parts"))
    # one row per sku by now: the sum per product runs over counts, not parts
    total = F.sum("n_parts").over(Window.partitionBy("product"))
    return per_sku.where(F.col("product").isNotNull()).select("product", "sku", "n_parts", total.alias("product_parts"))


def hierarchy_keys(spark, sf):
    """Each product expanded to ten keys product_01..product_10."""
    products = read_table(spark, sf, "part", ["p_type"]).select(F.col("p_type").alias("product")).distinct()
    i = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("i")
    return products.select("product", i).select(
        "product", F.concat_ws("_", "product", F.lpad(F.col("i").cast("string"), 2, "0")).alias("sku_key"))


def column_append(spark, sf):
    """Distinct products zipped with regions by rank."""
    products = read_table(spark, sf, "part", ["p_type"]).select(F.col("p_type").alias("product")).distinct()
    regions = read_table(spark, sf, "region", ["r_name"]).select(F.col("r_name").alias("region"))
    return ranking.zip_by_rank(products, ["product"], regions, ["region"]).select("product", "region")


def array_params(spark, sf):
    """Embedding arrays with a leading 1: size and element access."""
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    arr = F.concat(F.array(F.lit(1.0)), F.transform("embedding", lambda x: x.cast("double")))
    return emb.select(F.col("vec_id").alias("id"), arr.alias("a")).select(
        "id", F.size("a").alias("n"),
        F.round(F.try_element_at("a", F.lit(1)), 6).alias("ar_first"),
        F.round(F.try_element_at("a", F.lit(2)), 6).alias("ar_second"),
        F.round(F.try_element_at("a", F.lit(-1)), 6).alias("ar_last"))


def sample_series(spark, sf):
    """All rows of the longest series (ties by smallest key)."""
    w = _weekly_materialised(spark, sf)
    return w.join(sampling.pick_one_series(w, KEYS), KEYS, "inner").select(*KEYS, "wk", "demand")


def sample_rows(spark, sf):
    """Lineitem row keys kept by a key-hash Bernoulli sample (10 %)."""
    li = read_table(spark, sf, "lineitem", inputs.ROW_KEY)
    return sampling.bernoulli(li, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], 100)


def holdout_split(spark, sf):
    """Listing rows per 60/20/20 key-bucket split with price sums."""
    lst = inputs.listing(spark, sf)
    return lst.groupBy(sampling.bucket_split_label("p_partkey").alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("sum_price"))


def union_train_val(spark, sf):
    """Keys of train and validation splits, appended by position."""
    train, val, _ = sampling.bucket_split(inputs.listing(spark, sf), "p_partkey")
    return train.select("p_partkey").union(val.select("p_partkey"))


def scalar_mix(spark, sf):
    """Scalar functions on part: modulo, floor, abs, format, clean name, null text."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_size", "p_retailprice"])
    size = F.col("p_size")
    return part.select(
        "p_partkey", (F.col("p_partkey") % 10).alias("key_mod"),
        F.greatest(F.col("p_retailprice"), F.lit(1000.0)).alias("floor_price"),
        F.abs(size - F.lit(25)).alias("abs_diff"),
        scalar.run_uri(F.col("p_partkey"), size).alias("run_uri"),
        scalar.clean_name(F.col("p_name")).alias("clean_name"),
        scalar.canonical_text(F.when(size <= 40, size)).alias("null_text"),
        size.cast("string").alias("size_text"))


def value_hash(spark, sf):
    """Canonical text of a value and its non-negative Murmur3 hash."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_size"])
    v = F.when(F.col("p_size") <= 40, F.col("p_size"))
    return part.select("p_partkey", scalar.canonical_text(v).alias("value"), scalar.value_hash(v).alias("h"))


def check_rowcount(spark, sf):
    """Data checks: join keeps rows; calendar length matches its bounds."""
    w = _weekly_materialised(spark, sf)
    bounds = w.agg(F.count(F.lit(1)).alias("before"), F.min("wk").alias("first_wk"), F.max("wk").alias("last_wk"))
    weeks = demand.calendar_from_bounds(bounds.select("first_wk", "last_wk"))
    # the calendar has one row per week of the data span: a proven size bound
    joined_n = w.join(F.broadcast(weeks.select("wk")), "wk").agg(F.count(F.lit(1))).scalar()
    cal_n = weeks.agg(F.count(F.lit(1))).scalar()
    a = checks.check_row("join_keeps_rows", F.col("before"), joined_n, bounds)
    b = checks.check_row("calendar_length",
                         cal.week_index(F.col("last_wk"), F.col("first_wk")) + 1, cal_n, bounds)
    return a.unionByName(b)


def schema_checks(spark, sf):
    """Schema expectations of the tables that the series are built from, one row per column."""
    key = T.StructType([T.StructField("l_partkey", T.LongType())])
    line = checks.compose_schema(key, [T.StructField("l_quantity", T.DoubleType()),
                                       T.StructField("l_shipdate", T.TimestampNTZType())])
    part = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_type", T.StringType()),
                         T.StructField("p_brand", T.StringType()), T.StructField("p_colour", T.StringType())])
    a = checks.schema_rows(read_table(spark, sf, "lineitem"), "lineitem", line)
    return a.unionByName(checks.schema_rows(read_table(spark, sf, "part"), "part", part))


# --- many models ---------------------------------------------------------------

def _index(spark, sf):
    return manymodels.model_index(inputs.devrows(spark, sf), RUN_ID)


def _models(spark, sf):
    return manymodels.model_index_multi(inputs.devrows(spark, sf), RUN_ID)


def model_index(spark, sf):
    """Per-device one-feature OLS: slope, intercept, r2, mse, rows used."""
    m = _index(spark, sf)
    return m.select("device_id", "n_used", F.round("slope", 6).alias("slope"),
                    F.round("intercept", 6).alias("intercept"), F.round("r2", 6).alias("r2"),
                    F.round("mse", 2).alias("mse"), "run_id")


def model_index_multi(spark, sf):
    """Per-device three-feature OLS from grouped moments."""
    m = _models(spark, sf)
    return m.select("device_id", "n_used",
                    *[F.round(F.col("coef")[i], 4).alias(f"coef_{i + 1}") for i in range(3)],
                    F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"),
                    F.round("mse", 2).alias("mse"), "run_id")


def many_model_score(spark, sf):
    """Every device row scored with its own device's three-feature model."""
    rows = inputs.devrows(spark, sf)
    # one row per device, written once: scoring counts it and joins it without training again
    scored = manymodels.many_model_score(rows, checkpoint(_models(spark, sf)))
    return scored.select(*inputs.ROW_KEY, "device_id", F.round("prediction", 4).alias("prediction"),
                         "has_model")


def routed_score(spark, sf):
    """Rows routed through a saved model bundle missing device 0; mean prediction per device."""
    rows = inputs.devrows(spark, sf)
    scored = manymodels.routed_score(spark, rows, _models(spark, sf), drop_device=0)
    return scored.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"),
                                           F.round(F.avg("prediction"), 4).alias("mean_pred"))


# --- search and forecast ---------------------------------------------------------

def mse_by_series(spark, sf):
    """Hold-out MSE of the last-value forecaster per series; too short ones have none."""
    t = search.forecasts(_dense(spark, sf), KEYS, H)
    err = F.when(~F.col("is_history"), F.pow(F.col("demand") - F.col("f_last"), F.lit(2)))
    return t.groupBy(*KEYS).agg(F.max("status").alias("status"), F.round(F.avg(err), 6).alias("mse"))


def rmse_global(spark, sf):
    """Hold-out RMSE of the last-value forecaster over all series, and how many series it covers."""
    t = search.forecasts(_dense(spark, sf), KEYS, H).filter(~F.col("is_history"))
    ok = F.col("status") == "ok"
    per = t.groupBy(*KEYS).agg(F.sum(F.when(ok, F.pow(F.col("demand") - F.col("f_last"), F.lit(2)))).alias("sse"),
                               F.count(F.when(ok, 1)).alias("n"))
    return per.agg(F.round(F.sqrt(F.try_divide(F.sum("sse"), F.sum("n"))), 6).alias("rmse"),
                   F.count(F.lit(1)).alias("n_series"), F.count(F.when(F.col("n") == 0, 1)).alias("n_too_short"))


def candidate_losses(spark, sf):
    """Hold-out loss of five SQL forecasters for every series, with its status."""
    return search.sql_forecaster_losses(_dense(spark, sf), KEYS, H)


def best_candidate(spark, sf):
    """Arg-min forecaster per series, ties by candidate id; none for too short series."""
    best = search.arg_min(candidate_losses(spark, sf), KEYS, "loss", "cand_id", ["status", "cand_id", "loss"])
    return best.withColumn("cand_id", F.when(F.col("status") == "ok", F.col("cand_id")))


def candidate_wins(spark, sf):
    """How many series choose each forecaster; the forecasters come as a pandas frame with arrays."""
    frame = pd.DataFrame({"cand_id": [c for c, _, _ in search.SQL_FORECASTERS],
                          "forecaster": [n for _, n, _ in search.SQL_FORECASTERS],
                          "params": [[float(k)] if k else [] for _, _, k in search.SQL_FORECASTERS]})
    schema = T.StructType([T.StructField("cand_id", T.IntegerType()), T.StructField("forecaster", T.StringType()),
                           T.StructField("params", T.ArrayType(T.DoubleType()))])
    wins = best_candidate(spark, sf).groupBy("cand_id").agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame(frame, schema=schema).join(wins, "cand_id", "left").select(
        "cand_id", "forecaster", F.size("params").alias("n_params"), F.try_element_at("params", F.lit(1)).alias("window"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_series"))


def forecast_frame(spark, sf):
    """Regular weekly frame of every series with hold-out and eligibility flags."""
    return forecast.series_frame(_weekly(spark, sf))


def forecast_best(spark, sf):
    """Search, arg-min, refit: fitted history and forecast tail for every series."""
    return forecast.forecast_best(_weekly(spark, sf))


def exo_gain(spark, sf):
    """Hold-out loss of a per-series regression without and with the event features."""
    return forecast.exo_gain(_weekly(spark, sf), EVENT)


def arma_losses(spark, sf):
    """Hold-out loss of every autoregressive moving-average order for every series."""
    return arma.losses(_dense(spark, sf), KEYS, H)


def arma_forecast(spark, sf):
    """Fitted history and forecast tail of every series by its best order."""
    return arma.forecast(_dense(spark, sf), KEYS, H)


def smoothing_losses(spark, sf):
    """Hold-out loss of every smoothing candidate (level, trend, season) for every series."""
    return smoothing.losses(_dense(spark, sf), KEYS, H)


def smoothing_forecast(spark, sf):
    """Weeks after the end of every series by its best smoothing candidate."""
    return smoothing.forecast(_dense(spark, sf), KEYS, H)


def difference_order(spark, sf):
    """How often every series must be differenced to be level-stationary, with the statistics."""
    return stationarity.difference_order(_dense(spark, sf), KEYS)


def halving_search(spark, sf):
    """Successive halving over the smoothing candidates of every series, round by round."""
    return smoothing.halving(_dense(spark, sf), KEYS, H)


# --- forests per device -----------------------------------------------------------------

def _device_forest(spark, sf):
    rows = inputs.devrows(spark, sf)
    fold = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % trees.TREES
    return rows, trees.fit(rows, manymodels.DEVICE, fold, manymodels.ALL_FEATURES, "label")


def device_trees(spark, sf):
    """A forest per device: the nodes of all trees of all devices, grown together."""
    _, nodes = _device_forest(spark, sf)
    return nodes.select("device_id", "tree", "node", "feature", "bin", "n", F.round("value", 4).alias("value"))


def device_tree_scores(spark, sf):
    """Every row scored by its own device's forest: rows, mean prediction and training error per device."""
    rows, nodes = _device_forest(spark, sf)
    scored = trees.score(rows, checkpoint(nodes), manymodels.DEVICE, manymodels.ALL_FEATURES)
    error = F.pow((F.col("label") - F.col("prediction")) / 1000, F.lit(2))
    return scored.groupBy("device_id").agg(F.count("prediction").alias("n"), F.round(F.avg("prediction"), 2).alias("mean_pred"),
                                           F.round(F.avg(error), 4).alias("mse"))


# --- MLlib -----------------------------------------------------------------------------

def string_index(spark, sf):
    """StringIndexer label order (frequency desc, label asc) per string column."""
    return tuning.string_index_labels(inputs.listing(spark, sf), ["p_brand", "p_type"])


def indexed_listing(spark, sf):
    """Listing rows with their label indices from the train rows; unseen labels skipped."""
    return tuning.indexed_listing(inputs.listing(spark, sf))


def forest_checks(spark, sf):
    """Rows, rows skipped and rows scored per split."""
    return tuning.forest_checks(inputs.listing(spark, sf))


def rf_pipeline(spark, sf):
    """Random-forest pipeline fitted on train, saved, loaded and scored on validation."""
    return tuning.rf_pipeline(spark, inputs.listing(spark, sf))


def rf_tuned(spark, sf):
    """Four forest trials on validation, best refitted on train + val, scored on test."""
    return tuning.rf_tuned(spark, inputs.listing(spark, sf))


def forest_table(spark, sf):
    """The nodes of a saved and loaded one-tree forest over the listing, as a table."""
    _, nodes = tuning.table_forest(spark, tuning.exact_label(inputs.listing(spark, sf)))
    codes = F.array_join(F.transform("left", lambda c: c.cast("int").cast("string")), ",")
    return nodes.select("tree", "node", "feature", "threshold", codes.alias("left_codes"), "n", F.round("value", 4).alias("value"))


def forest_table_scores(spark, sf):
    """All listing rows scored by walking the forest's table: rows, mean prediction and error per split."""
    return tuning.forest_table_scores(spark, tuning.exact_label(inputs.listing(spark, sf)))


def forest_search(spark, sf):
    """Tree depth chosen on validation rows, refitted on train and validation, judged on test, all by node tables."""
    return tuning.forest_search(spark, tuning.exact_label(inputs.listing(spark, sf)))


# --- run log ---------------------------------------------------------------------------

def runlog_latest(spark, sf):
    """Newest run per device from the run log."""
    return runlog.latest_per_device(inputs.runlog(spark, sf))


def topk_runs(spark, sf):
    """Ten newest runs with a device tag."""
    return runlog.newest_runs(inputs.runlog(spark, sf), 10)


def runlog_roundtrip(spark, sf):
    """Parent runs per device and their children appended to a log, read back and matched."""
    log, path = inputs.runlog(spark, sf), scratch_path(spark, "runlog", unique=True)
    runlog.append_runs(runlog.device_runs(log), path)
    runlog.append_runs(runlog.child_runs(log), path)
    kept = checkpoint(runlog.children_by_parent(runlog.read_runs(spark, path)))
    sinks.remove_path(spark, path)
    return kept


def weekly_refresh(spark, sf):
    """Weekly table by year, built from the shipments up to a year before the end, then refreshed with
    all of them: only the last years are read again and written."""
    li = read_table(spark, sf, "lineitem", ["l_partkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_brand"])
    end, path = li.agg(F.date_sub(F.max("l_shipdate"), 365)).first()[0], scratch_path(spark, "weekly_years", unique=True)
    if end is not None:
        demand.refresh_weekly(li.where(F.col("l_shipdate") <= F.lit(end)), part, path)
    kept = checkpoint(demand.refresh_weekly(li, part, path))
    sinks.remove_path(spark, path)
    return kept


def table_diff(spark, sf):
    """Weekly rows that the late orders (every 500th) add or change: tables with and without them compared."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_brand"])
    before, after = (checkpoint(inputs.weekly_of(rows, part)) for rows in (li.where(F.col("l_orderkey") % 500 != 0), li))
    return diff.table_diff(before, after, [*KEYS, "wk"])


def trial_log(spark, sf):
    """The trials of the tuned forest logged under one parent run and read back."""
    path = scratch_path(spark, "trials", unique=True)
    runlog.append_runs(runlog.trial_runs(tuning.rf_tuned(spark, inputs.listing(spark, sf)), RUN_ID), path)
    kept = checkpoint(runlog.read_runs(spark, path).select(
        "run_id", "parent_run_id", F.col("tags")["stage"].alias("stage"), F.col("params")["maxDepth"].alias("max_depth"),
        (F.col("metrics")["rmse"] > 0).alias("has_rmse")))
    sinks.remove_path(spark, path)
    return kept


def run_tree(spark, sf):
    """Nested runs of any depth: root, depth and children of every run."""
    return runlog.run_tree(runlog.nested(inputs.runlog(spark, sf)))


QUERIES: dict[str, Query] = {
    "weekly_demand": weekly_demand, "row_count": row_count, "range_rows": range_rows,
    "rand_columns": rand_columns, "calendar": calendar_q, "calendar_factors": calendar_factors,
    "weeks_since_event": weeks_since_event, "season_lookup": season_lookup, "week_timestamps": week_timestamps,
    "candidate_wins": candidate_wins, "series_calendar": series_calendar,
    "adjusted_demand": adjusted_demand, "exo_features": exo_features,
    "first_series": first_series, "series_count": series_count, "series_bounds": series_bounds,
    "series_position": series_position, "tail_split": tail_split, "dense_spine": dense_spine,
    "series_diff": series_diff, "lag_features": lag_features, "series_packed": series_packed,
    "hierarchy_join": hierarchy_join, "hierarchy_keys": hierarchy_keys,
    "column_append": column_append, "array_params": array_params,
    "sample_series": sample_series, "sample_rows": sample_rows, "holdout_split": holdout_split,
    "union_train_val": union_train_val, "scalar_mix": scalar_mix, "value_hash": value_hash,
    "model_index": model_index, "model_index_multi": model_index_multi,
    "many_model_score": many_model_score, "routed_score": routed_score,
    "mse_by_series": mse_by_series, "rmse_global": rmse_global,
    "candidate_losses": candidate_losses, "best_candidate": best_candidate,
    "arma_losses": arma_losses, "arma_forecast": arma_forecast,
    "smoothing_losses": smoothing_losses, "smoothing_forecast": smoothing_forecast, "halving_search": halving_search,
    "difference_order": difference_order, "weekly_refresh": weekly_refresh, "table_diff": table_diff,
    "device_trees": device_trees, "device_tree_scores": device_tree_scores,
    "exo_gain": exo_gain, "forecast_frame": forecast_frame, "forecast_best": forecast_best,
    "string_index": string_index, "indexed_listing": indexed_listing, "forest_checks": forest_checks,
    "forest_table": forest_table, "forest_table_scores": forest_table_scores, "forest_search": forest_search,
    "rf_pipeline": rf_pipeline, "rf_tuned": rf_tuned,
    "runlog_latest": runlog_latest, "topk_runs": topk_runs, "runlog_roundtrip": runlog_roundtrip, "run_tree": run_tree,
    "trial_log": trial_log, "table_roundtrip": table_roundtrip, "schema_checks": schema_checks, "write_readback": write_readback,
    "metric_csv_roundtrip": metric_csv_roundtrip, "check_rowcount": check_rowcount,
}
