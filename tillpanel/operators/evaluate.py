"""Metric aggregations and the persistence (previous-week) baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillpanel.functions.metrics import metric_aggs


def evaluate_all(df: DataFrame, y: str = "sales", p: str = "prediction",
                 by: list[str] | None = None) -> DataFrame:
    """n, n_missing, rmsle, mae, rmse — overall or per group (one hash aggregate)."""
    aggs = metric_aggs(y, p)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def naive_baseline(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Persistence forecast: this week's sales predicted by last week's."""
    scored = df.filter(df["sales_lag_1"].isNotNull())
    return evaluate_all(scored, "sales", "sales_lag_1", by)
