"""Segment (subgroup) error analysis: store-size terciles, unemployment
quartiles, per-store breakdown, disparity ratios.

Segment boundaries come from a *reference* frame (the training pool) and
are applied to the evaluated frame (the holdout), so held-out outcomes never
shape their own groups. All dimensions are aggregated in one pass
(GROUPING SETS: one Expand + one hash aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.functions.metrics import metric_aggs
from tillpanel.operators.explore import rank_stores

# Segment labels and defaults.
SIZE_LABELS = ["small", "medium", "large"]
UNEMPLOYMENT_LABELS = ["Q1_lowest", "Q2", "Q3", "Q4_highest"]
QUARTILES = [0.25, 0.5, 0.75]
DEFAULT_SEGMENT_COLUMNS = ["store_size_bucket", "unemployment_bucket", "store_nbr"]
DISPARITY_THRESHOLD = 1.5


def store_size_buckets(reference: DataFrame) -> DataFrame:
    """Store → small/medium/large by rank of mean sales (ties by store id).

    With r the 1-based rank among n stores: n ≥ 3 → small iff 3(r−1) < n−1,
    medium iff 3(r−1) < 2(n−1), else large; n = 2 → small, large; n = 1 →
    medium. Ranks come from ``rank_stores``, n is one number for the driver.
    """
    ranks = rank_stores(reference)
    ranked = ranks.withColumn("n_stores", F.lit(ranks.count()))
    k = 3 * (F.col("rank") - 1)
    m = F.col("n_stores") - 1
    bucket = (F.when(F.col("n_stores") == 1, F.lit("medium"))
              .when(F.col("n_stores") == 2, F.when(F.col("rank") == 1, F.lit("small")).otherwise(F.lit("large")))
              .when(k < m, F.lit("small"))
              .when(k < 2 * m, F.lit("medium"))
              .otherwise(F.lit("large")))
    return ranked.withColumn("store_size_bucket", bucket)


def unemployment_edges(reference: DataFrame) -> list[float]:
    """Distinct exact quartiles (linear interpolation) of the reference period.

    Found by range refinement: no task holds more than a fixed number of bins, however many values differ.
    Three scalars come back to the driver, so applying them needs no join.
    """
    from tillpanel.plans.physical import exact_quantiles
    q = exact_quantiles(reference, ["unemployment"], QUARTILES)["unemployment"]
    out: list[float] = []
    for v in q:
        if v is not None and v not in out:
            out.append(float(v))
    return out


def unemployment_bucket(edges: list[float], col: str = "unemployment") -> F.Column:
    """Label by the number of edges ≤ value; a null value stays null."""
    c = F.col(col)
    n_le = sum((F.when(c >= F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    labels = F.array(*[F.lit(x) for x in UNEMPLOYMENT_LABELS])
    return F.when(c.isNotNull(), F.element_at(labels, n_le + 1))


def add_segments(df: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Attach ``store_size_bucket`` and ``unemployment_bucket`` (reference
    boundaries; no reference → ``df`` itself). Unseen stores get null."""
    ref = df if reference is None else reference
    sizes = store_size_buckets(ref).select("store_nbr", "store_size_bucket")
    out = df.join(sizes, "store_nbr", "left")
    return out.withColumn("unemployment_bucket", unemployment_bucket(unemployment_edges(ref)))


def segment_report(df: DataFrame, dims=DEFAULT_SEGMENT_COLUMNS, y: str = "sales",
                   p: str = "prediction") -> DataFrame:
    """Long table ``segment_dimension, segment_value, n, n_missing, rmsle,
    mae, rmse`` over every present dimension, one GROUPING SETS pass.
    Rows whose key is null are left out of that dimension."""
    dims = [d for d in dims if d in df.columns]
    grouped = df.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims])
    g = grouped.agg(*metric_aggs(y, p), *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dim = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.lit(d)) for d in dims])
    val = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.col(d).cast("string")) for d in dims])
    return (g.select(dim.alias("segment_dimension"), val.alias("segment_value"),
                     "n", "n_missing", "rmsle", "mae", "rmse")
            .filter(F.col("segment_value").isNotNull()))


def segment_performance(df: DataFrame, segment_col: str, y: str = "sales",
                        p: str = "prediction") -> DataFrame:
    """n + metrics per value of one segment column, worst RMSLE first."""
    return (df.filter(F.col(segment_col).isNotNull()).groupBy(segment_col)
            .agg(*metric_aggs(y, p)).orderBy(F.desc("rmsle")))


def with_disparity(report: DataFrame, threshold: float = DISPARITY_THRESHOLD) -> DataFrame:
    """Add worst/best RMSLE ratio per dimension and its flag.

    Ratio is null when the best segment has RMSLE ≤ 0 (or none exists);
    a null ratio is never flagged. The window runs on the aggregated report.
    """
    w = Window.partitionBy("segment_dimension")
    lo, hi = F.min("rmsle").over(w), F.max("rmsle").over(w)
    ratio = F.when(lo > 0, hi / lo)
    return (report.withColumn("disparity_ratio", ratio)
            .withColumn("flagged", F.coalesce(F.col("disparity_ratio") > F.lit(threshold), F.lit(False))))


def disparity_summary(report: DataFrame, threshold: float = DISPARITY_THRESHOLD) -> DataFrame:
    """One row per dimension: ratio, flagged, segment count."""
    agg = report.groupBy("segment_dimension").agg(
        F.min("rmsle").alias("_lo"), F.max("rmsle").alias("_hi"), F.count(F.lit(1)).alias("n_segments"))
    ratio = F.when(F.col("_lo") > 0, F.col("_hi") / F.col("_lo"))
    return agg.select("segment_dimension", "n_segments", ratio.alias("disparity_ratio")).withColumn(
        "flagged", F.coalesce(F.col("disparity_ratio") > F.lit(threshold), F.lit(False)))


def fairness_report(df: DataFrame, reference: DataFrame | None = None, dims=DEFAULT_SEGMENT_COLUMNS,
                    y: str = "sales", p: str = "prediction",
                    threshold: float = DISPARITY_THRESHOLD) -> DataFrame:
    """add_segments → segment_report → disparity: the flattened report."""
    seg = add_segments(df, reference)
    return with_disparity(segment_report(seg, dims, y, p), threshold)


def worst_segment_row(df: DataFrame, store_metrics: DataFrame) -> DataFrame:
    """The latest row of the store with the highest RMSLE (ties: lower id).

    ``max_by`` picks the store in one aggregate over the per-store table;
    the pick is joined back as a one-row broadcast.
    """
    worst = store_metrics.agg(
        F.max_by(F.col("store_nbr"), F.struct(F.col("rmsle"), -F.col("store_nbr"))).alias("store_nbr"))
    rows = df.join(F.broadcast(worst), "store_nbr")
    cols = [c for c in df.columns if c != "store_nbr"]
    last = rows.groupBy("store_nbr").agg(F.max_by(F.struct(*cols), F.col("date")).alias("_r"))
    return last.select("store_nbr", *[F.col(f"_r.{c}").alias(c) for c in cols])


def log_disparity(run: DataFrame, summary: DataFrame) -> DataFrame:
    """Merge non-null disparity ratios into the run rows' ``metrics`` map.

    The summary has one row per segment dimension (three by default); it is
    read back and applied as a literal map, so the run table is not joined.
    """
    rows = summary.filter(F.col("disparity_ratio").isNotNull()).select(
        "segment_dimension", "disparity_ratio").collect()
    if not rows:
        return run
    kv = []
    for r in rows:
        kv += [F.lit(f"fairness_disparity_ratio_{r['segment_dimension']}"), F.lit(float(r["disparity_ratio"]))]
    return run.withColumn("metrics", F.map_concat("metrics", F.create_map(*kv)))
