"""plinth: Spark-native tabular feature engineering, model evaluation and run-log analytics.

Every operator takes and returns DataFrames.  Fitted statistics come from Spark
aggregations (one aggregate per fit where possible) and are applied with column
expressions or joins, so the same code runs on a laptop sample and on a cluster.
"""

__version__ = "0.1.0"
