"""Many models: one regression per group, kept as a table, joined to rows.

Training reduces every group to its moments with ordinary (partially
aggregated) aggregates, so a device holding a third of all rows costs the
same as any other; the small linear system is solved by column expressions on
the one row per group.  The model table meets the rows through an equi-join
that is broadcast only behind an explicit row-count check of the table;
larger model tables take a shuffle join with hot groups salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one salt of a hot group may hold in the shuffle join.
ROWS_PER_SALT = 2_000_000


def _complete(df: DataFrame, columns) -> DataFrame:
    """Rows without a null or NaN in any of the columns: all moments come from the same rows."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df


def fit_ols_one(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """OLS of y on one feature per group, closed form, all on the JVM.

    mse = var_pop(y) - covar_pop(x, y)^2 / var_pop(x)  (training error).
    Rows with a null in x or y are left out; a group whose x is constant has
    a null model.
    """
    X, Y = F.col(x), F.col(y)
    return _complete(df, [x, y]).groupBy(group).agg(
        F.count(F.lit(1)).alias("n_used"),
        F.regr_slope(Y, X).alias("slope"),
        F.regr_intercept(Y, X).alias("intercept"),
        F.regr_r2(Y, X).alias("r2"),
        (F.var_pop(Y) - F.try_divide(F.pow(F.covar_pop(X, Y), F.lit(2)), F.var_pop(X))).alias("mse"),
    )


def solve_array(system: Column) -> Column:
    """Solution of a positive semi-definite system, an array of k rows of k coefficients and the right side.

    Elimination, one step per unknown, as a fold over the rows: the expression is of one size at any k.  A
    pivot of no more than 1e-12 of its diagonal entry means that the unknown is a combination of others:
    the system counts as singular and the solution is null.
    """
    size = F.size(system)

    def step(m, i):
        p = F.get(m, i)
        pivot = F.get(p, i)
        pivot = F.when(F.abs(pivot) > F.abs(F.get(F.get(system, i), i)) * F.lit(1e-12), pivot)
        return F.transform(m, lambda row, r: F.when(r == i, F.transform(row, lambda x: F.try_divide(x, pivot))).otherwise(
            F.zip_with(row, p, lambda x, y: x - F.try_divide(F.get(row, i), pivot) * y)))
    done = F.aggregate(F.sequence(F.lit(0), size - 1), system, step)
    x = F.transform(done, lambda row: F.element_at(row, -1))
    return F.when(~F.exists(x, lambda v: v.isNull()), x)


def solve(m, v) -> list[Column]:
    """Solution of a small positive semi-definite system of columns; null if it is singular."""
    x = solve_array(F.array(*[F.array(*[c.cast("double") for c in [*row, right]]) for row, right in zip(m, v)]))
    return [F.get(x, F.lit(i)) for i in range(len(v))]


def fit_ols(df: DataFrame, group: str, features, y: str) -> DataFrame:
    """OLS of y on k features per group from centred moments (partial
    aggregation, numerically stable).  Rows with a null in any column are left
    out; a group whose features are constant or collinear has a null model.
    Output: group, n_used, coef ARRAY<DOUBLE>, intercept, r2, mse.
    """
    features, k = list(features), len(features)
    aggs = [F.count(F.lit(1)).alias("n_used"), F.avg(y).alias("m_y"), F.var_pop(y).alias("v_y")]
    for i, a in enumerate(features):
        aggs += [F.avg(a).alias(f"m_{i}"), F.covar_pop(a, y).alias(f"c_{i}_y")]
        aggs += [F.covar_pop(a, features[j]).alias(f"c_{i}_{j}") for j in range(i, k)]
    moments = _complete(df, [*features, y]).groupBy(group).agg(*aggs)
    cxx = [[F.col(f"c_{min(i, j)}_{max(i, j)}") for j in range(k)] for i in range(k)]
    system = F.array(*[F.array(*[c.cast("double") for c in [*row, F.col(f"c_{i}_y")]]) for i, row in enumerate(cxx)])
    fit = moments.withColumn("_system", system).withColumn("_b", solve_array(F.col("_system")))
    fit = fit.select("*", *[F.get("_b", F.lit(i)).alias(f"b_{i}") for i in range(k)])
    explained, centre = F.lit(0.0), F.lit(0.0)
    for i in range(k):
        explained = explained + F.col(f"b_{i}") * F.col(f"c_{i}_y")
        centre = centre + F.col(f"b_{i}") * F.col(f"m_{i}")
    # greatest() skips nulls: a null model keeps a null error
    mse = F.when(explained.isNotNull(), F.greatest(F.col("v_y") - explained, F.lit(0.0)))
    return fit.select(group, "n_used", F.array(*[F.col(f"b_{i}") for i in range(k)]).alias("coef"),
                      (F.col("m_y") - centre).alias("intercept"),
                      (F.lit(1.0) - F.try_divide(mse, F.col("v_y"))).alias("r2"), mse.alias("mse"))


def linear_prediction(coef: Column, intercept: Column, features) -> Column:
    out = intercept
    for i, f in enumerate(features):
        out = out + coef.getItem(i) * F.col(f)
    return out


def score(rows: DataFrame, models: DataFrame, group: str, features,
          coef: str = "coef", intercept: str = "intercept",
          broadcast_max_rows: int = 200_000, hot_fraction: float = 0.01,
          rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Attach each row's own group model (left join) and predict.

    A group missing from the table gets ``has_model = false`` and a null
    prediction instead of failing; a null model (constant features) is a model
    with a null prediction.

    The join strategy is chosen behind a size check of the model table (one
    row per group; pass a materialised table, counting it is cheap):

    * up to ``broadcast_max_rows`` models (~100 bytes each): broadcast join,
      rows are never shuffled, so a hot group costs nothing extra;
    * beyond it: shuffle join, with groups above ``hot_fraction`` of all
      rows (known from ``n_used``) salted: their rows spread over one join key
      per ``rows_per_salt`` rows by a hash of the row, and only their model
      rows are replicated, once per key.  The hot list has at most
      1 / hot_fraction entries (a proven bound), so it is broadcast.
    """
    m = models.select(group, F.col(coef).alias("_coef"), F.col(intercept).alias("_b0"), F.lit(True).alias("_known"))
    if models.count() <= broadcast_max_rows:
        joined = rows.join(F.broadcast(m), group, "left")
    elif "n_used" in models.columns and hot_fraction:
        total = models.agg(F.sum("n_used")).scalar()
        hot = (models.filter(F.col("n_used") > total * F.lit(hot_fraction))
                     .select(group, F.ceil(F.col("n_used") / rows_per_salt).cast("int").alias("_hot")))
        row_cols = [F.col(c) for c in rows.columns]
        rows_s = (rows.join(F.broadcast(hot), group, "left")
                      .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*row_cols), F.col("_hot")).cast("int"), F.lit(0)))
                      .drop("_hot"))
        last = F.coalesce(F.col("_hot") - 1, F.lit(0))
        m_s = (m.join(F.broadcast(hot), group, "left")
                .select(group, "_coef", "_b0", "_known", F.explode(F.sequence(F.lit(0), last)).alias("_salt")))
        joined = rows_s.join(m_s, [group, "_salt"], "left").drop("_salt")
    else:
        joined = rows.join(m, group, "left")
    return (joined.withColumn("prediction", linear_prediction(F.col("_coef"), F.col("_b0"), features))
                  .withColumn("has_model", F.col("_known").isNotNull())
                  .drop("_coef", "_b0", "_known"))


def save_model_table(models: DataFrame, path: str) -> None:
    """Persist the model bundle (one row per group) where every executor can read it."""
    models.write.mode("overwrite").parquet(path)


def load_model_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
