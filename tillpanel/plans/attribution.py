"""Model explanations as Spark jobs.

* permutation importance on held-out rows (log-target RMSE increase);
* exact path-dependent attributions of the fitted trees, for any number of rows;
* global (mean |attribution| over a sample) and local explanations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.operators.features import INPUTS, LOG_SALES
from tillpanel.plans.model import feature_of
from tillpanel.plans.physical import cut_lineage, permuted_index, with_row_index
from tillpanel.plans.tree_attribution import contributions

SEED = 42


def model_features(df: DataFrame) -> list[str]:
    return [c for c in INPUTS if c in df.columns]


def sample_rows(df: DataFrame, n: int, seed: int = SEED, keys=("store_nbr", "date")) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, reproducible for a seed: the n smallest
    seeded hashes of the row keys (TakeOrderedAndProject, bounded by n)."""
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


def _rmse_log(df: DataFrame) -> F.Column:
    e = F.col("log_prediction") - F.col(LOG_SALES)
    return F.sqrt(F.avg(e * e))


def permutation_importance(model, df: DataFrame, features: list[str] | None = None,
                           n_repeats: int = 8, seed: int = SEED) -> DataFrame:
    """Mean and population std over repeats of the log-RMSE increase when
    one feature's column is randomly permuted across the rows of ``df``.

    Rows get numbers once. A (feature, repeat) permutation is arithmetic on these numbers, so no copy is
    sorted: each row fetches the feature's value of the row that its number is mapped to, and the model scores
    all permuted copies in a single ``transform``.
    """
    feats = features or model_features(df)
    types = dict(df.dtypes)
    base = with_row_index(df.filter(F.col(LOG_SALES).isNotNull()), ["store_nbr", "date"], "orig_idx")
    n = base.count()
    combo = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.lit(r).alias("r")) for i in range(len(feats)) for r in range(n_repeats)]))
    copies = base.select("*", combo.alias("combo")).select("*", "combo.f", "combo.r").drop("combo")
    donor = permuted_index(F.col("orig_idx"), max(n, 1), F.lit(seed), F.col("f"), F.col("r"))
    values = base.select(F.col("orig_idx").alias("donor"), F.array(*[F.col(f).cast("double") for f in feats]).alias("donor_values"))
    joined = copies.withColumn("donor", donor).join(values, "donor").withColumn("donor_value", F.get("donor_values", F.col("f")))
    swapped = joined.withColumns({
        f: F.when(F.col("f") == i, F.col("donor_value").cast(types[f])).otherwise(F.col(f)) for i, f in enumerate(feats)})
    scored = model.transform(swapped.drop("donor", "donor_value", "donor_values"))
    per = scored.groupBy("f", "r").agg(_rmse_log(scored).alias("rmse"))
    base_rmse = model.transform(base).agg(_rmse_log(base).alias("b")).first()["b"]
    imp = per.withColumn("delta", F.col("rmse") - F.lit(base_rmse))
    names = F.array(*[F.lit(f) for f in feats])
    return imp.groupBy(F.get(names, F.col("f")).alias("feature")).agg(
        F.avg("delta").alias("importance_mean"), F.stddev_pop("delta").alias("importance_std"))


def attributions(model, rows: DataFrame, row_key: str = "row_id") -> DataFrame:
    """Exact path-dependent tree attributions in log space of every row of ``rows``.

    ``row_id, feature, attribution, f_x, base_value``, one row per row and feature; the attributions of a row add
    up to ``f_x - base_value``. The inputs made from one feature count together; a feature that no tree uses has 0.
    """
    feats = model_features(rows)
    keyed = rows if row_key in rows.columns else rows.withColumn(row_key, F.monotonically_increasing_id())
    data = cut_lineage(model.vectors(keyed).withColumnRenamed(row_key, "row_id").select("row_id", "features"))
    found, base = contributions(data, model.boosted)
    feature_of_input = F.array(*[F.lit(feature_of(c)) for c in model.inputs])
    summed = (found.groupBy("row_id", F.get(feature_of_input, F.col("input")).alias("feature"))
              .agg(F.sum("contribution").alias("attribution")))
    f_x = model.boosted.transform(data).select("row_id", F.col("log_prediction").alias("f_x"), F.lit(base).alias("base_value"),
                                               F.explode(F.array(*[F.lit(f) for f in feats])).alias("feature"))
    out = f_x.join(summed, ["row_id", "feature"], "left").select(
        F.col("row_id").alias(row_key), "feature", F.coalesce("attribution", F.lit(0.0)).alias("attribution"), "f_x", "base_value")
    return out


def mean_abs_attribution(attr: DataFrame) -> DataFrame:
    return attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))


def top_features(imp: DataFrame, n: int = 10, col: str = "mean_abs_attribution") -> DataFrame:
    return imp.orderBy(F.desc(col), "feature").limit(n)


def global_attribution(model, df: DataFrame, sample_size: int = 500, seed: int = SEED, top_n: int = 10) -> DataFrame:
    """Mean |attribution| over a sample of ``sample_size`` rows, the ``top_n`` largest."""
    return top_features(mean_abs_attribution(attributions(model, sample_rows(df, sample_size, seed))), top_n)


def local_explanation(model, row: DataFrame) -> DataFrame:
    """JSON record for one row: actual, log and dollar prediction, feature
    values and their attributions (NaN → null, dates ISO)."""
    feats = model_features(row)
    x = row.withColumn("row_id", F.lit(0).cast("long"))
    attr = attributions(model, x)
    amap = attr.groupBy("row_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "attribution")))).alias("attributions"),
        F.first("f_x").alias("f_x"), F.first("base_value").alias("base_value"))
    j = x.join(amap, "row_id")
    fmap = F.map_from_arrays(F.array(*[F.lit(f) for f in feats]),
                             F.array(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in feats]))
    # Names and constants of the record's fields.
    rec = F.struct(
        F.lit("latest_holdout_prediction_for_worst_rmsle_store").alias("selection_reason"),
        F.lit("log1p_weekly_sales").alias("explanation_space"),
        F.col("store_nbr"), F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("sales").alias("actual_sales"), F.col("f_x").alias("predicted_log1p_sales"),
        F.expm1("f_x").alias("predicted_sales"), F.col("base_value"),
        fmap.alias("features"), F.col("attributions"))
    return j.select(F.to_json(rec).alias("json"))
