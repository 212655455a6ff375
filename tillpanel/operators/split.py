"""Chronological splits: last-N-weeks holdout and rolling-origin CV folds.

Splits are by *distinct date*, so every store's rows of a week land on the
same side. Features must be built before splitting so holdout rows keep
lags computed from real history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def holdout_cutoff(df: DataFrame, test_weeks: int):
    """First date of the last ``test_weeks`` distinct dates.

    Reads at most ``test_weeks + 1`` dates back to the driver. Raises
    ``ValueError`` unless 1 ≤ test_weeks ≤ (distinct dates − 1).
    """
    if test_weeks <= 0:
        raise ValueError(f"a holdout needs a positive number of weeks, not {test_weeks}")
    top = (df.select("date").distinct().orderBy(F.desc("date"))
           .limit(test_weeks + 1).collect())
    if len(top) <= test_weeks:
        raise ValueError(
            f"a holdout of {test_weeks} weeks leaves nothing to train on: only {len(top)} weeks of data")
    return top[test_weeks - 1]["date"]


def holdout_split(df: DataFrame, test_weeks: int) -> tuple[DataFrame, DataFrame]:
    """(pool, test): test = the most recent ``test_weeks`` weeks."""
    cutoff = holdout_cutoff(df, test_weeks)
    return df.filter(F.col("date") < F.lit(cutoff)), df.filter(F.col("date") >= F.lit(cutoff))


def rolling_origin_folds(df: DataFrame, n_splits: int = 3) -> DataFrame:
    """Date → (fold, role) table for expanding-window CV.

    With n distinct dates, i the 0-based date index and t = n div (k+1):
    fold j validates dates n−(k−j)·t ≤ i < n−(k−j−1)·t and trains on all
    earlier dates. One row per (date, fold) for dates in train or valid.
    The global window runs on the distinct-date table only (one row per week).
    Raises ``ValueError`` when there are fewer than ``n_splits + 1`` dates.
    """
    check_fold_count(df, n_splits)
    dates = df.select("date").distinct()
    idx = dates.select(
        "date",
        (F.row_number().over(Window.orderBy("date")) - 1).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    ).withColumn("t", F.floor(F.col("n") / F.lit(n_splits + 1)))
    folds = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1)))
    out = idx.select("date", "i", "n", "t", folds.alias("fold"))
    lo = F.col("n") - (F.lit(n_splits) - F.col("fold")) * F.col("t")
    hi = F.col("n") - (F.lit(n_splits - 1) - F.col("fold")) * F.col("t")
    role = (F.when((F.col("i") >= lo) & (F.col("i") < hi), F.lit("valid"))
            .when(F.col("i") < lo, F.lit("train")))
    return (out.withColumn("role", role).filter(F.col("role").isNotNull() & (F.col("t") > 0))
            .select("date", F.col("fold").cast("int").alias("fold"), "role"))


def check_fold_count(df: DataFrame, n_splits: int) -> None:
    """Raise when there are too few dates for ``n_splits`` folds (t = 0)."""
    n = df.select("date").distinct().limit(n_splits + 1).count()
    if n < n_splits + 1:
        raise ValueError(f"{n_splits} folds need at least {n_splits + 1} dates, found {n}")


def assign_folds(df: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows × their (fold, role) memberships, joined on date.

    The fold table has one row per (week, fold): broadcast if the planner finds it small.
    """
    return df.join(folds, "date")


def assert_disjoint(pool: DataFrame, test: DataFrame) -> DataFrame:
    """One-row check: number of dates on both sides, pool max, test min, ordered."""
    tagged = pool.select("date", F.lit(1).alias("in_pool"), F.lit(0).alias("in_test")).unionByName(
        test.select("date", F.lit(0).alias("in_pool"), F.lit(1).alias("in_test")))
    per_date = tagged.groupBy("date").agg(F.max("in_pool").alias("p"), F.max("in_test").alias("t"))
    return per_date.agg(
        F.count_if((F.col("p") == 1) & (F.col("t") == 1)).alias("n_shared"),
        F.max(F.when(F.col("p") == 1, F.col("date"))).alias("pool_max"),
        F.min(F.when(F.col("t") == 1, F.col("date"))).alias("test_min"),
    ).withColumn("ordered", F.coalesce(F.col("pool_max") < F.col("test_min"), F.lit(True)))
