"""Forecast-error metrics as aggregate Column expressions.

Pairs where either side is null are skipped by the averages (a missing
value never turns into a zero); ``metric_aggs`` reports how many pairs were
skipped so the caller can tell.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """One missing value: NaN becomes null (Spark orders NaN above +inf)."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def clip_at_zero(c) -> Column:
    """max(c, 0) that keeps null as null (``greatest`` would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c.cast("double"), F.lit(0.0)))


def rmsle(y, p) -> Column:
    diff = F.log1p(clip_at_zero(p)) - F.log1p(clip_at_zero(y))
    return F.sqrt(F.avg(diff * diff))


def mae(y, p) -> Column:
    return F.avg(F.abs(_col(y).cast("double") - _col(p).cast("double")))


def rmse(y, p) -> Column:
    diff = _col(y).cast("double") - _col(p).cast("double")
    return F.sqrt(F.avg(diff * diff))


def metric_aggs(y="sales", p="prediction") -> list[Column]:
    """n (complete pairs), n_missing, rmsle, mae, rmse — one aggregation."""
    y, p = _col(y), _col(p)
    complete = y.isNotNull() & p.isNotNull()
    return [
        F.count_if(complete).alias("n"),
        F.count_if(~complete).alias("n_missing"),
        rmsle(F.when(complete, y), F.when(complete, p)).alias("rmsle"),
        mae(F.when(complete, y), F.when(complete, p)).alias("mae"),
        rmse(F.when(complete, y), F.when(complete, p)).alias("rmse"),
    ]


def log_target(c="sales") -> Column:
    return F.log1p(clip_at_zero(c))


def invert_forecast(log_pred, clip: bool = True, cents: bool = True) -> Column:
    """expm1 of a log forecast, floored at 0 when serving, rounded to cents."""
    v = F.expm1(_col(log_pred))
    if clip:
        v = clip_at_zero(v)
    return F.round(v, 2) if cents else v


EXACT_SUM_TYPE = "decimal(38,8)"


def exact_sum(c) -> Column:
    """Order-independent sum of a money column: DECIMAL sum cast to double."""
    return F.sum(_col(c).cast(EXACT_SUM_TYPE)).cast("double")


def exact_mean(c) -> Column:
    """Mean from an exact DECIMAL sum (same value on any plan or engine)."""
    c = _col(c)
    n = F.count(c)
    return F.when(n > 0, exact_sum(c) / n)
