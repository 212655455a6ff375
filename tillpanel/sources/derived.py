"""Tables derived from the driver's data for the serving and ops side.

* scoring requests from ``orders`` (one request per order, batch = customer);
* the prediction log from ``events``;
* model run log and model versions from ``orders``.

All are pure projections: they grow with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.sources.panel import read_table

# Fixed values of the derivations.
N_REQUEST_STORES = 50   # store ids -1..48, so some fall outside 1..45
MODEL_NAME = "tillpanel-gbt"
MODEL_ALIAS = "production"
N_MODELS = 7


def scoring_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request_id, batch_id, store_nbr, date`` + nullable overrides."""
    return requests_from_orders(read_table(spark, sf_dir, "orders"))


def requests_from_orders(o: DataFrame) -> DataFrame:
    """Row-wise projection orders → scoring requests (works on streams too)."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return o.select(
        k.alias("request_id"),
        F.col("o_custkey").alias("batch_id"),
        ((k % N_REQUEST_STORES) - 2).cast("int").alias("store_nbr"),
        F.when(k % 97 != 0, F.to_date("o_orderdate")).alias("date"),
        F.when(k % 5 == 0, (k % 3).cast("int")).alias("holiday_flag"),
        F.when(F.col("o_orderpriority") == "1-URGENT", price / 5000.0).alias("temperature"),
        F.when(k % 7 == 0, price / 100000.0 - 1.0).alias("fuel_price"),
        F.when(k % 11 == 0, price / 1000.0 - 5.0).alias("cpi"),
        F.when(k % 13 == 0, price / 50000.0 - 0.5).alias("unemployment"),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the service counters, one per event.

    ``ts`` is cast to a session-zone TIMESTAMP (watermarks reject NTZ).
    error events → 404 ``unknown_store`` (value ≥ 50) or 500
    ``internal_error``; the rest are served predictions (HTTP 200).
    """
    return derive_prediction_log(read_table(spark, sf_dir, "events"))


def derive_prediction_log(e: DataFrame) -> DataFrame:
    """Row-wise projection events → prediction log (works on streams too)."""
    err = F.col("event_type") == "error"
    return e.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        ((F.col("user_id") % 45) + 1).cast("int").alias("store_nbr"),
        F.when(err & (F.col("value") >= 50), 404).when(err, 500).otherwise(200).alias("http_status"),
        F.when(err & (F.col("value") >= 50), "unknown_store").when(err, "internal_error").alias("reason"),
        (F.col("value") / 1000.0).alias("latency_s"),
        F.when(~err, F.col("value") * 10000.0).alias("predicted_sales"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-run log: one run per order.

    ``metrics`` MAP<STRING,DOUBLE> holds test_rmsle/test_mae/cv_mean_rmsle,
    ``params`` and ``tags`` are MAP<STRING,STRING>.
    """
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return o.select(
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
        F.concat(F.lit("candidate-"), (k % 6).cast("string")).alias("run_name"),
        F.concat(F.lit("model-"), (F.col("o_custkey") % N_MODELS).cast("string")).alias("model_name"),
        F.when(F.col("o_orderstatus") == "F", "gbt_final").otherwise("gbt").alias("model_type"),
        F.create_map(F.lit("max_depth"), (3 + k % 3).cast("string"),
                     F.lit("max_iter"), (50 + 50 * (k % 4)).cast("string")).alias("params"),
        F.create_map(F.lit("test_rmsle"), price / 1000000.0,
                     F.lit("test_mae"), price / 10.0,
                     F.lit("cv_mean_rmsle"), price / 900000.0).alias("metrics"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("tags"),
        F.col("o_orderdate").cast("timestamp").alias("started_at"),
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered versions: one per finished order (status 'F').

    ``version`` is the order key (unique, no global numbering pass);
    ``alias`` is set on urgent-priority versions (an alias move event).
    """
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    k = F.col("o_orderkey")
    created = (F.col("o_orderdate").cast("timestamp")
               + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k % 86400).cast("decimal(18,6)")))
    return o.select(
        F.concat(F.lit("model-"), (F.col("o_custkey") % N_MODELS).cast("string")).alias("model_name"),
        k.alias("version"),
        F.when(F.col("o_orderpriority") == "1-URGENT", MODEL_ALIAS).alias("alias"),
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
        created.alias("created_at"),
    )


PREDICTION_LOG_SCHEMA = ("event_id BIGINT, ts TIMESTAMP, store_nbr INT, http_status INT, reason STRING, "
                         "latency_s DOUBLE, predicted_sales DOUBLE")


def read_prediction_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """A persisted prediction log (parquet), as a batch or a file stream."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(PREDICTION_LOG_SCHEMA).parquet(path)
