"""Boosted-tree forecasting with Spark ML.

One global regressor on the log target. Stores enter through their level: a
smoothed mean of the log target over weeks that come before. A training row
sees only earlier weeks of its store (so the target does not leak into it); a
row to be scored sees all training weeks. This holds for any number of stores,
and no two stores share a code.

Spark's trees reject NaN feature vectors, so history features that are null in
a store's first weeks are filled with a sentinel (−1; sales are non-negative)
and paired with ``<feature>_is_missing`` flags.
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from math import prod

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillpanel.functions.metrics import metric_aggs
from tillpanel.operators.features import LOG_SALES, history_inputs, numeric_inputs
from tillpanel.plans.boosting import fit_in_one_task
from tillpanel.plans.physical import cut_lineage
from tillpanel.plans.tree_attribution import staged_predictions

# Search space, its mapping onto Spark's GBT parameters, number of candidates and seed.
SEARCH_SPACE = {
    "num_leaves": [7, 15, 31],
    "learning_rate": [0.03, 0.05, 0.1],
    "n_estimators": [100, 200],
    "min_child_samples": [5, 10, 20],
}
LEAVES_TO_DEPTH = {7: 3, 15: 4, 31: 5}
N_CANDIDATES = 6
SEED = 42
SENTINEL = -1.0
STORE_LEVEL = "store_level"
#: weeks of the overall mean that a store's own mean is smoothed with
PRIOR_WEEKS = 8
LEVEL_TYPE = "decimal(18,9)"
TREES = "n_estimators"
ROWS_PER_PARTITION = 100_000


def candidates(space: dict = SEARCH_SPACE, n: int = N_CANDIDATES, seed: int = SEED) -> list[dict]:
    """``n`` points of the search space, without repeats: a seeded order of the numbers of all points,
    each decoded digit by digit (the last parameter varies fastest)."""
    numbers = list(range(prod(len(v) for v in space.values())))
    random.Random(seed).shuffle(numbers)
    points = []
    for number in numbers[:n]:
        point = {}
        for name, values in reversed(space.items()):
            number, digit = divmod(number, len(values))
            point[name] = values[digit]
        points.append({name: point[name] for name in space})
    return points


def gbt_params(params: dict) -> dict:
    """Translate leaf-count style parameters to Spark GBT parameters."""
    leaves = params.get("num_leaves", 15)
    depth = params.get("max_depth") or LEAVES_TO_DEPTH.get(leaves, max(1, (leaves + 1).bit_length() - 1))
    return {
        "maxDepth": int(depth),
        "maxIter": int(params.get(TREES, params.get("max_iter", 20))),
        "stepSize": float(params.get("learning_rate", 0.1)),
        "minInstancesPerNode": int(params.get("min_child_samples", 1)),
        "maxBins": 64,
        "seed": SEED,
    }


# ---------------------------------------------------------------- store levels


def _smoothed(total, n, prior):
    """Mean of ``n`` values that sum to ``total``, with PRIOR_WEEKS values of ``prior``; 0 where nothing is known."""
    value = (F.coalesce(total.cast("double"), F.lit(0.0)) + PRIOR_WEEKS * prior) / (n + PRIOR_WEEKS)
    return F.coalesce(value, F.lit(0.0))


def with_earlier_level(df: DataFrame) -> DataFrame:
    """Adds the store's level over the weeks before each row's week.

    One window per store, in the order of the lag features; the overall mean of earlier weeks comes from a
    table with one row per week. Sums are exact decimals, so they do not depend on the order of summation.
    """
    log = F.col(LOG_SALES).cast(LEVEL_TYPE)
    weekly = df.groupBy("date").agg(F.sum(log).alias("s"), F.count(log).alias("n"))
    before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    prior = weekly.select(F.col("date").alias("_week"), (F.sum("s").over(before).cast("double") / F.nullif(F.sum("n").over(before), F.lit(0))).alias("_prior"))
    own = Window.partitionBy("store_nbr").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.withColumns({"_s": F.sum(log).over(own), "_n": F.count(log).over(own)})
    return (sums.join(prior, F.col("date") == F.col("_week"), "left")
            .withColumn(STORE_LEVEL, _smoothed(F.col("_s"), F.col("_n"), F.col("_prior"))).drop("_s", "_n", "_week", "_prior"))


def store_levels(df: DataFrame) -> DataFrame:
    """``store_nbr, store_level`` after all weeks of ``df``, and a row of null store with the overall mean."""
    log = F.col(LOG_SALES).cast(LEVEL_TYPE)
    per = df.groupBy("store_nbr").agg(F.sum(log).alias("s"), F.count(log).alias("n"))
    total = per.agg(F.sum("s").cast("double").alias("s"), F.sum("n").alias("n")).first()
    prior = total["s"] / total["n"] if total["n"] else 0.0
    overall = df.sparkSession.createDataFrame([(None, prior)], f"store_nbr {df.schema['store_nbr'].dataType.simpleString()}, {STORE_LEVEL} double")
    return per.filter(F.col("store_nbr").isNotNull()).select(
        "store_nbr", _smoothed(F.col("s"), F.col("n"), F.lit(prior)).alias(STORE_LEVEL)).unionAll(overall)


# ---------------------------------------------------------------- fitting


def model_input(df: DataFrame) -> DataFrame:
    """Sentinel-fill history features and add their missing flags."""
    cols = {}
    for c in history_inputs():
        if c in df.columns:
            cols[f"{c}_is_missing"] = F.col(c).isNull().cast("double")
            cols[f"{c}__filled"] = F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL))
    return df.withColumns(cols)


def input_columns(df: DataFrame) -> list[str]:
    cols = []
    for c in numeric_inputs():
        if c in history_inputs():
            if c in df.columns:
                cols += [f"{c}__filled", f"{c}_is_missing"]
        elif c in df.columns:
            cols.append(c)
    return cols


def feature_of(model_column: str) -> str:
    """The feature that a model input was made from."""
    return "store_nbr" if model_column == STORE_LEVEL else model_column.replace("__filled", "").replace("_is_missing", "")


def build_pipeline(inputs: list[str], params: dict) -> Pipeline:
    """assembler → GBT over prepared rows."""
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=LOG_SALES, predictionCol="log_prediction",
                       **gbt_params(params))
    return Pipeline(stages=[assembler, gbt])


@dataclass
class TrainingRows:
    """Rows that have a log target, with the inputs of a fit and the store levels: made once for all fits on them."""

    levels: DataFrame
    unknown: float
    inputs: list[str]
    data: DataFrame
    n: int
    kept: bool = False

    @classmethod
    def of(cls, train: DataFrame) -> TrainingRows:
        """The rows spread by a hash of (store, date) over as many partitions as they fill."""
        rows = train.filter(F.col(LOG_SALES).isNotNull())
        levels = cut_lineage(store_levels(rows))
        data = model_input(with_earlier_level(rows))
        inputs = [STORE_LEVEL, *input_columns(data)]
        n = rows.count()
        parts = -(-n // ROWS_PER_PARTITION) or 1
        data = data.select(*inputs, LOG_SALES, "store_nbr", "date").repartition(parts, "store_nbr", "date")
        return cls(levels, level_of_unknown(levels), inputs, data, n)

    def written(self) -> TrainingRows:
        """The same rows, read from the checkpoint folder by every fit."""
        return replace(self, data=cut_lineage(self.data), kept=True)


def level_of_unknown(levels: DataFrame) -> float:
    return levels.filter("store_nbr IS NULL").first()[STORE_LEVEL]


class ForecastModel:
    """A fitted pipeline and the store levels it was fitted with; adds ``log_prediction`` to feature rows."""

    def __init__(self, pipeline_model: PipelineModel, levels: DataFrame, unknown: float | None = None):
        self.pipeline_model = pipeline_model
        self.levels = levels
        self.unknown = level_of_unknown(levels) if unknown is None else unknown

    @classmethod
    def fit(cls, train: DataFrame | TrainingRows, params: dict) -> ForecastModel:
        """Fits ``train``. Rows of one partition are fitted in one task. More are fitted by Spark, with small jobs
        for every tree level, so partitions of few rows would only add to its overhead."""
        rows = train if isinstance(train, TrainingRows) else TrainingRows.of(train)
        pipeline = build_pipeline(rows.inputs, params)
        if 0 < rows.n <= ROWS_PER_PARTITION:
            assembler, gbt = pipeline.getStages()
            return cls(PipelineModel([assembler, fit_in_one_task(gbt, rows.data, rows.inputs)]), rows.levels, rows.unknown)
        data = rows.data if rows.kept else rows.data.persist()
        try:
            return cls(pipeline.fit(data), rows.levels, rows.unknown)
        finally:
            if not rows.kept:
                data.unpersist()

    @property
    def boosted(self):
        return self.pipeline_model.stages[-1]

    @property
    def inputs(self) -> list[str]:
        return self.pipeline_model.stages[0].getInputCols()

    def prepared(self, df: DataFrame) -> DataFrame:
        """``df`` with the model's inputs; a store without a level gets the overall mean."""
        known = self.levels.filter("store_nbr IS NOT NULL").select(F.col("store_nbr").alias("_store"), F.col(STORE_LEVEL).alias("_level"))
        joined = df.join(known, F.col("store_nbr") == F.col("_store"), "left")
        return model_input(joined.withColumn(STORE_LEVEL, F.coalesce("_level", F.lit(self.unknown))).drop("_store", "_level"))

    def vectors(self, df: DataFrame) -> DataFrame:
        """``df`` with the model's inputs as one vector ``features``."""
        return self.pipeline_model.stages[0].transform(self.prepared(df))

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.pipeline_model.transform(self.prepared(df))
        drop = [c for c in out.columns if c.endswith("__filled") or c.endswith("_is_missing")]
        return out.drop("features", STORE_LEVEL, *drop)

    def save(self, path: str) -> None:
        self.pipeline_model.write().overwrite().save(f"{path}/pipeline")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, path: str) -> ForecastModel:
        loaded = PipelineModel.load(f"{path}/pipeline")
        return cls(loaded, SparkSession.active().read.parquet(f"{path}/levels"))


def score_in_sales_space(model: ForecastModel, df: DataFrame, clip: bool = False) -> DataFrame:
    """``prediction`` = expm1(log_prediction); unclipped for evaluation."""
    out = model.transform(df).withColumn("prediction", F.expm1("log_prediction"))
    if clip:
        out = out.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))
    return out


# ---------------------------------------------------------------- search


def shared_runs(points: list[dict]) -> list[tuple[dict, list[int]]]:
    """Boosting runs that cover ``points``: points that differ only in their number of trees share the longest
    of their runs, because a shorter run is its beginning. Each run comes with the numbers of its points."""
    runs: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        runs.setdefault(tuple(sorted((k, v) for k, v in p.items() if k != TREES)), []).append(i)
    return [(max((points[i] for i in members), key=lambda p: p.get(TREES, 0)), members) for members in runs.values()]


def staged_scores(model: ForecastModel, valid: DataFrame, lengths: list[int]) -> dict[int, dict]:
    """Metrics in sales space of the first n trees of ``model`` for every n of ``lengths``."""
    full = model.boosted.getNumTrees
    out = {}
    if full in lengths:
        out[full] = score_in_sales_space(model, valid).agg(*metric_aggs("sales", "prediction")).first().asDict()
    shorter = [n for n in lengths if n != full]
    if shorter:
        rows = model.vectors(valid).withColumn("row_id", F.monotonically_increasing_id()).select("row_id", "sales", "features")
        rows = cut_lineage(rows)
        staged = staged_predictions(rows, model.boosted, shorter).join(rows.select("row_id", "sales"), "row_id")
        scored = staged.withColumn("prediction", F.expm1("prediction")).groupBy("trees").agg(*metric_aggs("sales", "prediction"))
        out |= {r["trees"]: r.asDict() for r in scored.collect()}
    return out


def cv_score(df: DataFrame, folds: DataFrame, points: list[dict], parallelism: int = 8, fitter=ForecastModel.fit) -> DataFrame:
    """Fit every candidate on every fold's training weeks, score its validation weeks.

    A fold's weeks are ranges of dates, so its rows are read by a date filter, and what a fit needs of them is made
    once for all candidates. Fits are submitted from a driver thread pool, so several Spark jobs share the cluster.
    Returns ``candidate, fold, n, rmsle, mae, rmse`` (sales space).
    """
    spark = df.sparkSession
    ranges: dict[int, dict] = {}
    for r in folds.groupBy("fold", "role").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect():
        ranges.setdefault(r["fold"], {})[r["role"]] = F.col("date").between(r["lo"], r["hi"])

    def prepared(fold):
        train = df.filter(ranges[fold]["train"])
        return TrainingRows.of(train).written() if fitter == ForecastModel.fit else train

    def run(task):
        (longest, members), fold = task
        valid = df.filter(ranges[fold]["valid"])
        model = fitter(trains[fold], longest)
        if len(members) == 1:
            found = {points[members[0]].get(TREES): score_in_sales_space(model, valid).agg(*metric_aggs("sales", "prediction")).first().asDict()}
        else:
            found = staged_scores(model, valid, sorted({points[i][TREES] for i in members}))
        return [(i, fold, *(found[points[i].get(TREES)][k] for k in ("n", "rmsle", "mae", "rmse"))) for i in members]

    # long runs first, so that the pool does not end on one
    tasks = sorted(((r, f) for r in shared_runs(points) for f in sorted(ranges)), key=lambda t: -t[0][0].get(TREES, 0))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        trains = dict(zip(ranges, pool.map(prepared, ranges), strict=True))
        results = [row for rows in pool.map(run, tasks) for row in rows]
    return spark.createDataFrame(results, "candidate int, fold int, n long, rmsle double, mae double, rmse double")


def best_of(scores: DataFrame) -> tuple[int, float]:
    """Lowest mean RMSLE over folds; NaN never wins; ties → first candidate."""
    mean = scores.groupBy("candidate").agg(F.avg("rmsle").alias("cv_mean_rmsle"))
    ok = mean.filter(F.col("cv_mean_rmsle").isNotNull() & ~F.isnan("cv_mean_rmsle"))
    r = ok.agg(F.min_by(F.struct("candidate", "cv_mean_rmsle"),
                        F.struct("cv_mean_rmsle", "candidate")).alias("b")).first()["b"]
    if r is None:
        raise ValueError("no candidate produced a finite CV score")
    return int(r["candidate"]), float(r["cv_mean_rmsle"])


def gain_importance(model: ForecastModel) -> DataFrame:
    """Split-gain importance per feature (its model inputs together), normalised to sum 1, descending."""
    folded: dict[str, float] = {}
    for name, gain in zip(model.inputs, model.boosted.featureImportances.toArray().tolist(), strict=True):
        folded[feature_of(name)] = folded.get(feature_of(name), 0.0) + float(gain)
    return model.levels.sparkSession.createDataFrame(sorted(folded.items(), key=lambda kv: -kv[1]), "feature string, gain double")
