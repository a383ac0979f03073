"""foldwise: leakage-safe tabular feature engineering and model ensembling on Spark.

Every step is a *fit* that yields a small dimension DataFrame and an *apply*
that is a join or a column expression, so train and test share one code path
and every step scales with Spark's partitioning instead of a driver loop.

Subpackages
-----------
sources    CSV / parquet scans, submission and stage-table sinks, driver-table bindings
functions  column expressions (numeric transforms, row-wise array maths)
operators  folds, imputers, encoders, target encoders, scalers, ranks, metrics, models
plans      out-of-fold stacking, blending, weight / seed / parameter searches
"""

__version__ = "0.1.0"
