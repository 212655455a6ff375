"""tillpanel: weekly store-sales panel analytics on Spark.

Every public function takes and returns DataFrames (or Columns) and keeps the
work inside Spark: DataFrame/SQL for data work, Spark ML for models and
Structured Streaming for the monitoring stream.
"""

__version__ = "0.1.0"
