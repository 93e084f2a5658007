"""weekcast: many-series demand analytics expressed as Spark DataFrame jobs.

Subpackages
-----------
sources    table readers, the standing inputs built from them, and sinks
functions  column-expression builders (calendar, event flags, scalar helpers)
operators  series windows, packing, search/arg-min, per-group models, sampling, checks
plans      composite jobs: demand shaping, many-models, forecasts, MLlib tuning, run log
llm        training-data operators; nothing outside imports it
"""

__all__ = ["queries", "oracle"]
