"""Forecast every series of a weekly demand table and write the result.

    python examples/forecast_every_series.py /root/testdata/sf0.01 /path/to/output

Features, split, search over five forecasters, fitted history and forecast
tail, as one Spark job over all series at once.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from weekcast.functions.calendar import TEST_EVENT  # noqa: E402
from weekcast.plans import demand, forecast  # noqa: E402
from weekcast.session import local_session  # noqa: E402
from weekcast.sources import inputs  # noqa: E402


def main(sf_dir: str, out: str) -> None:
    spark = local_session()
    weekly = inputs.weekly(spark, sf_dir)                         # (product, sku, wk, demand)
    demand.exo_features(weekly, TEST_EVENT).show(5)               # event / season flags, row-wise
    result = forecast.forecast_best(weekly)                        # search, fit, forecast
    result.write.mode("overwrite").parquet(out)
    written = spark.read.parquet(out)
    written.groupBy("status").agg(F.countDistinct("product", "sku").alias("series")).show()
    (written.filter(~F.col("is_history"))
            .agg(F.sqrt(F.avg(F.pow(F.col("demand") - F.col("demand_fitted"), 2))).alias("holdout_rmse"))
            .show())


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
