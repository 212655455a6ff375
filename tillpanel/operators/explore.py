"""Exploratory aggregates over the panel (store scale, weekly totals,
holiday effect, indicator summaries, binned indicator-vs-sales)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.functions.metrics import exact_mean, exact_sum
from tillpanel.plans.physical import cut_lineage, exact_quantiles, with_row_index

DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def store_avg_sales(df: DataFrame) -> DataFrame:
    """Mean weekly sales per store (every store weighs its own weeks)."""
    return (df.filter(F.col("store_nbr").isNotNull())
            .groupBy("store_nbr").agg(exact_mean("sales").alias("avg_sales")))


def rank_stores(df: DataFrame) -> DataFrame:
    """Stores ranked by mean sales, ascending (no mean first, ties by store id).

    Ranks come from a range-partitioned sort with an offset per partition, so
    no task holds all stores.
    """
    ranked = with_row_index(store_avg_sales(df), ["avg_sales", "store_nbr"], "_at")
    return ranked.select("store_nbr", "avg_sales", (F.col("_at") + 1).cast("int").alias("rank"))


def store_scale_range(df: DataFrame) -> DataFrame:
    return store_avg_sales(df).agg(F.min("avg_sales").alias("smallest_avg"),
                                   F.max("avg_sales").alias("largest_avg"),
                                   F.count(F.lit(1)).alias("n_stores"))


def weekly_total(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(exact_sum("sales").alias("total_sales"),
                                  F.count(F.lit(1)).alias("n_stores"))


def holiday_effect(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("holiday_flag").isNotNull()).groupBy("holiday_flag")
            .agg(exact_mean("sales").alias("mean_sales"), F.count(F.lit(1)).alias("n_weeks")))


def distinct_holiday_weeks(df: DataFrame) -> DataFrame:
    return df.filter(F.col("holiday_flag") == 1).select("date").distinct()


def indicator_by_store(df: DataFrame, cols=("cpi", "unemployment")) -> DataFrame:
    return (df.filter(F.col("store_nbr").isNotNull()).groupBy("store_nbr")
            .agg(*[F.avg(c).alias(c) for c in cols]))


def describe_over_stores(df: DataFrame, cols=("cpi", "unemployment")) -> DataFrame:
    """count/mean/std/min/quartiles/max of per-store means, long form
    ``(stat, <col>...)``; quartiles are exact (linear interpolation), found
    by range refinement, so no task holds the means of all stores."""
    per = cut_lineage(indicator_by_store(df, cols))
    quartiles = exact_quantiles(per, list(cols), [0.25, 0.5, 0.75])
    aggs = []
    for c in cols:
        aggs += [F.count(c).cast("double").alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
                 *[F.lit(v).cast("double").alias(f"{c}__{k}") for k, v in zip(("25%", "50%", "75%"), quartiles[c])]]
    one = per.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(s).alias("stat"), *[F.col(f"`{c}__{s}`").alias(c) for c in cols])
                     for s in DESCRIBE_STATS])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def indicator_vs_sales(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins of an indicator with mean sales and count per bin,
    plus the overall Pearson correlation (a scatter plot as an aggregate).

    The bin bounds are two scalars read back to the driver.
    """
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
               F.corr(col, "sales").alias("corr")).first()
    lo, hi, corr = b["lo"], b["hi"], b["corr"]
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "indicator string, bin int, bin_lo double, bin_hi double, n bigint, mean_sales double, corr double")
    width = (hi - lo) / bins if hi > lo else 1.0
    raw = F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("int")
    bin_ = F.least(raw, F.lit(bins - 1))
    return (df.filter(F.col(col).isNotNull()).groupBy(bin_.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), exact_mean("sales").alias("mean_sales"))
            .select(F.lit(col).alias("indicator"), "bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                    "n", "mean_sales", F.lit(corr).cast("double").alias("corr")))


def evaluation_window(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"),
                  F.count_distinct("date").alias("n_weeks"), F.count(F.lit(1)).alias("n_rows"))
