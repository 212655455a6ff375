"""Set-based scoring: validate requests, join the store snapshot, build
model features, apply a model, shape the response.

One Spark job replaces the per-item loop of an online service; the same
functions work on a stream of requests (stream–static join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.functions.calendar import is_major_holiday_week
from tillpanel.functions.metrics import invert_forecast
from tillpanel.operators.snapshot import SNAPSHOT_COLUMNS

# Request contract.
MIN_STORE, MAX_STORE = 1, 45
MAX_BATCH = 500
OVERRIDES = ["temperature", "fuel_price", "cpi", "unemployment"]
HISTORY = ["sales_lag_1", "sales_lag_4", "sales_lag_52",
           "sales_roll_mean_4", "sales_roll_mean_8", "sales_roll_std_4"]


class RejectedRequestsError(ValueError):
    """Raised by strict scoring when any request is rejected."""


def request_violations(max_store: int = MAX_STORE) -> F.Column:
    """Array of broken request rules (empty when the request is valid)."""
    c = F.col
    return F.array_compact(F.array(
        F.when(c("store_nbr").isNull(), F.lit("store_nbr_required")),
        F.when((c("store_nbr") < MIN_STORE) | (c("store_nbr") > max_store), F.lit("store_nbr_out_of_range")),
        F.when(c("date").isNull(), F.lit("date_required")),
        F.when(c("holiday_flag").isNotNull() & ~c("holiday_flag").isin(0, 1), F.lit("holiday_flag_invalid")),
        F.when(c("fuel_price") < 0, F.lit("fuel_price_negative")),
        F.when(c("cpi") <= 0, F.lit("cpi_non_positive")),
        F.when(c("unemployment") < 0, F.lit("unemployment_negative")),
    ))


def validate_requests(requests: DataFrame, max_store: int = MAX_STORE) -> tuple[DataFrame, DataFrame]:
    """(ok, rejected): rejected rows carry ``reasons`` (HTTP 422 semantics)."""
    tagged = requests.withColumn("reasons", request_violations(max_store))
    return (tagged.filter(F.size("reasons") == 0).drop("reasons"),
            tagged.filter(F.size("reasons") > 0))


def check_batch_size(requests: DataFrame, max_items: int = MAX_BATCH,
                     batch_col: str = "batch_id") -> DataFrame:
    """Items per batch and whether the count is within 1..max_items."""
    return (requests.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_items"))
            .withColumn("ok", F.col("n_items").between(1, max_items)))


class PreparedSnapshot:
    """A snapshot computed once and cached for repeated scoring calls (one
    request at a time); the planner broadcasts it if its bytes allow."""

    def __init__(self, snapshot: DataFrame):
        self.df = snapshot.select(*SNAPSHOT_COLUMNS).cache()
        self.df.count()


def _lookup(snapshot) -> DataFrame:
    return snapshot.df if isinstance(snapshot, PreparedSnapshot) else snapshot


def _snapshot_df(snapshot) -> DataFrame:
    return snapshot.df if isinstance(snapshot, PreparedSnapshot) else snapshot


def score_features(requests: DataFrame, snapshot) -> DataFrame:
    """Valid requests ⟕ snapshot on store: overrides win over last known
    values, calendar fields come from the requested date, holiday flag from
    the rule unless given. ``status`` = ok | unknown_store.

    The snapshot (one row per store) is broadcast if the planner finds it small.
    """
    base = _snapshot_df(snapshot)
    snap = base.select(*SNAPSHOT_COLUMNS).withColumn("_known", F.lit(True))
    snap = snap.select("store_nbr", "_known", *[F.col(c).alias(f"_snap_{c}") for c in SNAPSHOT_COLUMNS[1:]])
    j = requests.join(snap, "store_nbr", "left")
    d = F.col("date")
    cols = {
        "holiday_flag": F.coalesce(F.col("holiday_flag"), is_major_holiday_week(d)),
        "month": F.month(d), "week_of_year": F.weekofyear(d), "year": F.year(d),
    }
    for c in OVERRIDES:
        cols[c] = F.coalesce(F.col(c), F.col(f"_snap_{c}"))
    for c in HISTORY:
        cols[c] = F.col(f"_snap_{c}")
    cols["status"] = F.when(F.col("_known"), F.lit("ok")).otherwise(F.lit("unknown_store"))
    out = j.withColumns(cols)
    return out.drop("_known", *[f"_snap_{c}" for c in SNAPSHOT_COLUMNS[1:]])


def unknown_stores(requests: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Requests whose store has no snapshot row (HTTP 404 semantics)."""
    return requests.join(_lookup(snapshot).select("store_nbr"), "store_nbr", "left_anti")


def naive_log_model(features: DataFrame) -> DataFrame:
    """Persistence model in log space: log1p(last known week's sales)."""
    return features.withColumn("log_prediction", F.log1p(F.col("sales_lag_1")))


def batch_predict(requests: DataFrame, snapshot: DataFrame, model=None,
                  model_name: str = "naive", model_alias: str = "production",
                  strict: bool = False, cents: bool = True, batch_col: str | None = None,
                  max_items: int = MAX_BATCH) -> DataFrame:
    """validate → join snapshot → features → model → expm1/floor/round, in one pass over the requests.

    With ``batch_col``, all requests of a batch of more than ``max_items`` are
    invalid; the batches' sizes take one more read of that column.

    ``model`` is a fitted Spark ML transformer producing ``log_prediction``
    (default: the persistence model). Every request gets one response row
    with ``status`` ok | invalid | unknown_store; ``strict`` raises instead
    when any request is rejected.
    """
    tagged = requests.withColumn("_invalid", F.size(request_violations()) > 0)
    if batch_col is not None:
        sizes = check_batch_size(requests, max_items, batch_col).filter(~F.col("ok"))
        tagged = tagged.join(sizes.select(F.col(batch_col).alias("_batch"), F.lit(True).alias("_oversized")),
                             F.col(batch_col).eqNullSafe(F.col("_batch")), "left")
        tagged = tagged.withColumn("_invalid", F.col("_invalid") | F.coalesce("_oversized", F.lit(False))).drop("_batch", "_oversized")
    if strict and tagged.filter("_invalid").limit(1).count() > 0:
        raise RejectedRequestsError("batch contains invalid requests")
    feats = score_features(tagged, snapshot)
    scored = model.transform(feats) if model is not None else naive_log_model(feats)
    status = F.when(F.col("_invalid"), F.lit("invalid")).otherwise(F.col("status"))
    pred = F.when(status == "ok", invert_forecast(F.col("log_prediction"), clip=True, cents=cents))
    keep = ["request_id"] if "request_id" in requests.columns else []
    return scored.select(*keep, "store_nbr", "date", pred.alias("predicted_sales"), status.alias("status"),
                         F.lit(model_name).alias("model_name"), F.lit(model_alias).alias("model_alias"))
