import math

import pytest
from pyspark.sql import functions as F

from conftest import toy_panel
from tillpanel.functions.metrics import mae, rmse, rmsle
from tillpanel.operators.split import assert_disjoint, holdout_split, rolling_origin_folds


def _m(spark, y, p, fn):
    df = spark.createDataFrame(list(zip(map(float, y), map(float, p))), "y double, p double")
    return df.agg(fn("y", "p").alias("m")).first()["m"]


def test_metric_vectors(spark):
    assert _m(spark, [1, 5, 100, 0], [1, 5, 100, 0], rmsle) == 0.0
    assert abs(_m(spark, [math.e - 1], [math.e ** 2 - 1], rmsle) - 1.0) < 1e-12
    assert math.isfinite(_m(spark, [-5, 10], [-3, 12], rmsle))
    assert _m(spark, [0, 0, 0], [1, 2, 3], mae) == 2.0
    assert abs(_m(spark, [0, 0], [3, 4], rmse) - math.sqrt(12.5)) < 1e-12


def test_holdout_sizes_and_order(spark):
    panel = toy_panel(spark, stores=(1, 2), weeks=20)
    pool, test = holdout_split(panel, 8)
    assert test.select("date").distinct().count() == 8
    assert pool.count() + test.count() == panel.count()
    r = assert_disjoint(pool, test).first()
    assert r["n_shared"] == 0 and r["ordered"]


@pytest.mark.parametrize("weeks", [0, 20, 25])
def test_holdout_bad_n_raises(spark, weeks):
    with pytest.raises(ValueError):
        holdout_split(toy_panel(spark, weeks=20), weeks)


def test_rolling_origin_folds(spark):
    panel = toy_panel(spark, weeks=135)
    f = rolling_origin_folds(panel, 3)
    valid = f.filter("role = 'valid'").groupBy("fold").agg(F.count("*").alias("n"), F.min("date").alias("lo"))
    rows = {r["fold"]: r["n"] for r in valid.collect()}
    assert rows == {0: 33, 1: 33, 2: 33}
    # expanding training window: fold j trains on 36 + 33j dates
    train = {r["fold"]: r["n"] for r in f.filter("role = 'train'").groupBy("fold").count()
             .withColumnRenamed("count", "n").collect()}
    assert train == {0: 36, 1: 69, 2: 102}


def test_clip_keeps_null_and_nan_becomes_null(spark):
    from tillpanel.functions.metrics import clip_at_zero, nan_to_null
    df = spark.createDataFrame([(None,), (-3.0,), (float("nan"),), (2.5,)], "x double")
    out = [r[0] for r in df.select(clip_at_zero(nan_to_null("x"))).collect()]
    assert out == [None, 0.0, None, 2.5]


def test_metrics_skip_incomplete_pairs(spark):
    from tillpanel.functions.metrics import metric_aggs
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (None, 3.0), (4.0, 4.0)], "y double, p double")
    r = df.agg(*metric_aggs("y", "p")).first()
    assert (r["n"], r["n_missing"], r["rmsle"], r["mae"]) == (2, 2, 0.0, 0.0)


def test_sample_rows_exact_and_reproducible(spark):
    from tillpanel.plans.attribution import sample_rows
    panel = toy_panel(spark, stores=(1, 2, 3), weeks=40)
    a = sample_rows(panel, 17, seed=42)
    b = sample_rows(panel.repartition(7), 17, seed=42)
    c = sample_rows(panel, 17, seed=7)
    assert a.count() == 17 and a.exceptAll(b).count() == 0 and a.exceptAll(c).count() > 0
    assert sample_rows(panel, 1000, seed=1).count() == panel.count()
