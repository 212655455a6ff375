"""Serving snapshot: the latest feature row of every store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SNAPSHOT_COLUMNS = ["store_nbr", "temperature", "fuel_price", "cpi", "unemployment",
                    "sales_lag_1", "sales_lag_4", "sales_lag_52",
                    "sales_roll_mean_4", "sales_roll_mean_8", "sales_roll_std_4"]


def latest_per_store(features: DataFrame, with_date: bool = False) -> DataFrame:
    """One row per store: the columns of its most recent week.

    ``max_by`` runs as a partial + final hash aggregate: no sort, and a store
    with a third of all rows is still reduced map-side.
    """
    keep = [c for c in SNAPSHOT_COLUMNS if c != "store_nbr"] + (["date"] if with_date else [])
    agg = (features.filter(F.col("store_nbr").isNotNull())
           .groupBy("store_nbr")
           .agg(F.max_by(F.struct(*keep), F.col("date")).alias("_last")))
    return agg.select("store_nbr", *[F.col(f"_last.{c}").alias(c) for c in keep])


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    snapshot.write.mode("overwrite").parquet(path)


def read_snapshot(spark, path: str) -> DataFrame:
    from tillpanel.sources.panel import _read_or_raise
    return _read_or_raise(spark.read.parquet, path)


def advanced_snapshot(panel: DataFrame) -> DataFrame:
    """Snapshot for scoring the week *after* each store's last week.

    A next-week row (sales unknown) is appended per store and the normal
    feature build runs over it, so its lags/rolling stats use the latest
    week (lag 1 = last week's sales). Indicators are the last known values.
    One extra row per store; same single window exchange as the features.
    """
    from tillpanel.operators.features import with_inputs
    last = panel.groupBy("store_nbr").agg(
        F.max_by(F.struct("date", "temperature", "fuel_price", "cpi", "unemployment"), F.col("date")).alias("_l"))
    nxt = last.select("store_nbr", F.date_add("_l.date", 7).alias("date"), F.lit(None).cast("double").alias("sales"),
                      F.lit(None).cast("int").alias("holiday_flag"),
                      *[F.col(f"_l.{c}").alias(c) for c in ("temperature", "fuel_price", "cpi", "unemployment")])
    rows = panel.select(*nxt.columns).unionByName(nxt.withColumn("_next", F.lit(True)), allowMissingColumns=True)
    feats = with_inputs(rows)
    return feats.filter(F.col("_next")).select(*SNAPSHOT_COLUMNS, F.col("date").alias("target_date"))
