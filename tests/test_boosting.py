"""The fit in one task against Spark's own fit, on rows made here."""

import datetime as dt
import math
import random
import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressor
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from conftest import toy_panel
from tillpanel.functions.metrics import metric_aggs
from tillpanel.operators.features import with_inputs
from tillpanel.operators.split import rolling_origin_folds
from tillpanel.plans import model as M
from tillpanel.plans.boosting import fit_in_one_task, thresholds_of
from tillpanel.plans.reports import write_report_tables

NAMES = list("abcdef")


def made(spark, n, seed, label=None):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c, d = r.randint(0, 6) + 0.0, r.random(), r.choice([-1.0, 2.5, 9.0]), r.gauss(0, 1)
        rows.append((a, b, c, d, 7.0, float(c < 0), label(a, b, c) if label else a * b + (c > 0) * d + 0.1 * r.random()))
    return spark.createDataFrame(rows, ", ".join(f"{x} double" for x in [*NAMES, "y"])).repartition(1).cache()


def both(spark, df, **params):
    gbt = GBTRegressor(labelCol="y", predictionCol="p", maxBins=64, seed=42, **params)
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    return rows, gbt.fit(rows), fit_in_one_task(gbt, df, NAMES)


def nodes(spark, model, path):
    model.save(path)
    return sorted((r["treeID"], r["nodeData"]["id"], str(r["nodeData"])) for r in spark.read.parquet(f"{path}/data").collect())


@pytest.mark.parametrize("n, seed, label, params", [
    (400, 1, None, {"maxDepth": 4, "maxIter": 10, "stepSize": 0.1, "minInstancesPerNode": 1}),
    (2000, 2, None, {"maxDepth": 5, "maxIter": 6, "stepSize": 0.3, "minInstancesPerNode": 20}),
    (5, 3, None, {"maxDepth": 3, "maxIter": 4, "stepSize": 0.5, "minInstancesPerNode": 1}),
    # leaves without variance, pruned nodes, a label that no feature explains
    (300, 4, lambda a, b, c: float(c > 0), {"maxDepth": 3, "maxIter": 4, "stepSize": 0.1, "minInstancesPerNode": 2}),
    (60, 5, lambda a, b, c: 1.5, {"maxDepth": 3, "maxIter": 3, "stepSize": 0.1, "minInstancesPerNode": 1}),
    (1, 6, None, {"maxDepth": 3, "maxIter": 3, "stepSize": 0.1, "minInstancesPerNode": 1}),
])
def test_one_task_grows_the_trees_that_spark_grows(spark, tmp_dir, n, seed, label, params):
    df = made(spark, n, seed, label)
    rows, spark_s, own = both(spark, df, **params)
    assert nodes(spark, own, f"{tmp_dir}/own") == nodes(spark, spark_s, f"{tmp_dir}/spark")
    assert own.treeWeights == spark_s.treeWeights and own.numFeatures == spark_s.numFeatures
    assert own.featureImportances == spark_s.featureImportances
    assert {p.name: v for p, v in own.extractParamMap().items()} == {p.name: v for p, v in spark_s.extractParamMap().items()}
    assert [t.numNodes for t in own.trees] == [t.numNodes for t in spark_s.trees]
    assert own.transform(rows).select("p").collect() == spark_s.transform(rows).select("p").collect()


def test_null_and_infinite_values_raise(spark):
    for bad in ("cast(null as double)", "cast('nan' as double)", "cast('inf' as double)"):
        df = made(spark, 50, 7).withColumn("b", F.expr(f"case when a > 3 then {bad} else b end"))
        with pytest.raises(Exception, match="must not be null, NaN or infinite"):
            fit_in_one_task(GBTRegressor(labelCol="y", maxIter=2), df, NAMES)


def test_thresholds_between_few_values_and_by_share_of_many():
    assert thresholds_of(np.array([3.0, 1.0, 1.0, 2.0]), 4).tolist() == [1.5, 2.5]
    many = thresholds_of(np.arange(1000.0), 10)
    assert len(many) == 9 and np.allclose(np.diff(many), 100)
    assert thresholds_of(np.full(9, 2.0), 4).tolist() == []


def test_jobs_of_a_fit_do_not_grow_with_its_trees(spark):
    rows = [(s, dt.date(2020, 1, 3) + dt.timedelta(7 * w), math.log1p(100 * s + w % 7), float(s * w % 11)) for s in range(1, 9) for w in range(40)]
    df = spark.createDataFrame(rows, "store_nbr int, date date, log_sales double, temperature double").cache()
    df.count()
    context, jobs = spark.sparkContext, {}
    for trees in (2, 40):
        context.setJobGroup(f"fit-{trees}", "fit")
        fitted = M.ForecastModel.fit(df, {"num_leaves": 7, "n_estimators": trees, "learning_rate": 0.1, "min_child_samples": 5})
        jobs[trees] = len(context.statusTracker().getJobIdsForGroup(f"fit-{trees}"))
        assert fitted.boosted.getNumTrees == trees
    context._jsc.clearJobGroup()
    assert jobs[40] <= jobs[2] + 2 and jobs[40] < 40


def test_rows_of_several_partitions_are_fitted_whole(spark, monkeypatch):
    feats = with_inputs(toy_panel(spark, stores=(1, 2, 3, 4), weeks=30))
    params = {"num_leaves": 7, "n_estimators": 3, "learning_rate": 0.3, "min_child_samples": 2}
    one = M.ForecastModel.fit(feats, params)
    monkeypatch.setattr(M, "ROWS_PER_PARTITION", 50)
    monkeypatch.setattr(M, "fit_in_one_task", lambda *a: pytest.fail("more rows than one partition holds"))
    several = M.ForecastModel.fit(feats, params)
    gap = (one.transform(feats).select("store_nbr", "date", F.col("log_prediction").alias("a"))
           .join(several.transform(feats).select("store_nbr", "date", F.col("log_prediction").alias("b")), ["store_nbr", "date"]))
    assert gap.count() == 120 and gap.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-6


def test_a_model_of_many_trees_gets_its_python_trees_when_asked(spark, monkeypatch):
    made_trees = []
    plain = DecisionTreeRegressionModel.__init__
    monkeypatch.setattr(DecisionTreeRegressionModel, "__init__", lambda self, *a: (made_trees.append(1), plain(self, *a))[1])
    model = fit_in_one_task(GBTRegressor(labelCol="y", maxIter=7, maxDepth=2), made(spark, 80, 8), NAMES)
    assert model.getNumTrees == 7 and model.getMaxIter() == 7 and not made_trees
    assert len(model.trees) == 7 and len(made_trees) == 7


def test_candidates_share_the_rows_of_a_fold(spark, monkeypatch):
    feats = with_inputs(toy_panel(spark, stores=(1, 2, 3), weeks=30))
    seen, plain = [], M.store_levels
    monkeypatch.setattr(M, "store_levels", lambda df: (seen.append(1), plain(df))[1])
    point = {"num_leaves": 7, "n_estimators": 2, "learning_rate": 0.3, "min_child_samples": 2}
    points = [point, point | {"learning_rate": 0.1}, point | {"min_child_samples": 4}]
    folds = rolling_origin_folds(feats, 2)
    found = {(r["candidate"], r["fold"]): r for r in M.cv_score(feats, folds, points).collect()}
    assert len(found) == 6 and len(seen) == 2
    for (i, fold), r in found.items():  # as each candidate fitted by itself
        ends = {x["role"]: x for x in folds.filter(F.col("fold") == fold).groupBy("role").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()}
        train, valid = (feats.filter(F.col("date").between(ends[x]["lo"], ends[x]["hi"])) for x in ("train", "valid"))
        own = M.score_in_sales_space(M.ForecastModel.fit(train, points[i]), valid).agg(*metric_aggs("sales", "prediction")).first()
        assert abs(own["rmsle"] - r["rmsle"]) < 1e-9 and own["n"] == r["n"]


def test_report_files_are_written_side_by_side(spark, tmp_dir, monkeypatch):
    together = threading.Barrier(3, timeout=60)  # passed only by three writes that have all begun
    for kind in ("csv", "text"):
        plain = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda self, path, *a, plain=plain, **k: (together.wait(), plain(self, path, *a, **k))[1])
    report = spark.createDataFrame([("store_nbr", 0.5), ("size", 0.25)], "segment_dimension string, rmsle double")
    gain = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "feature string, gain double")
    paths = write_report_tables(tmp_dir, report, spark.createDataFrame([("{}",)], "json string"), gain=gain)
    assert list(paths) == ["fairness_metrics", "fairness_summary", "native_gain_importance"]
    assert [r["feature"] for r in spark.read.option("header", True).csv(paths["native_gain_importance"]).collect()] == ["b", "a"]
    assert spark.read.text(paths["fairness_summary"]).collect()[0][0] == "{}"
