import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillpanel.functions.metrics import metric_aggs
from tillpanel.operators.features import with_inputs
from tillpanel.operators.split import holdout_split
from tillpanel.plans import attribution as A
from tillpanel.plans.model import ForecastModel, candidates, gain_importance, score_in_sales_space
from tillpanel.sources.panel import weekly_panel

PARAMS = {"num_leaves": 7, "n_estimators": 8, "learning_rate": 0.3, "min_child_samples": 5}


@pytest.fixture(scope="module")
def fitted(spark):
    feats = with_inputs(weekly_panel(spark, SF_SMALL)).cache()
    pool, test = holdout_split(feats, 8)
    return feats, pool, test, ForecastModel.fit(pool, PARAMS)


def test_fit_with_missing_lags_and_sanity(fitted):
    feats, pool, test, model = fitted
    assert pool.filter(F.col("sales_lag_52").isNull()).count() > 0  # first-year rows kept
    m = score_in_sales_space(model, test).agg(*metric_aggs("sales", "prediction")).first()
    assert m["rmsle"] < 1.0 and m["n"] > 0


def test_serving_prediction_non_negative(spark, fitted):
    from tillpanel.operators.scoring import batch_predict
    from tillpanel.operators.snapshot import latest_per_store
    from tillpanel.sources.derived import scoring_requests
    feats, _, _, model = fitted
    out = batch_predict(scoring_requests(spark, SF_SMALL), latest_per_store(feats), model=model)
    assert out.filter("status = 'ok'").count() > 0
    assert out.filter("predicted_sales < 0").count() == 0


def test_save_load_roundtrip(fitted, tmp_dir):
    _, _, test, model = fitted
    model.save(f"{tmp_dir}/m")
    back = ForecastModel.load(f"{tmp_dir}/m")
    a = model.transform(test).select("store_nbr", "date", "log_prediction")
    b = back.transform(test).select("store_nbr", "date", "log_prediction")
    assert a.exceptAll(b).count() == 0


def test_gain_importance_covers_features(fitted):
    _, _, _, model = fitted
    g = gain_importance(model).collect()
    assert {r["feature"] for r in g} >= {"store_nbr", "sales_lag_1", "temperature"}
    assert abs(sum(r["gain"] for r in g) - 1.0) < 1e-9


def test_permutation_unused_feature_is_zero(fitted):
    _, _, test, model = fitted
    imp = {r["feature"]: r for r in A.permutation_importance(model, test, n_repeats=2).collect()}
    unused = {r["feature"] for r in gain_importance(model).collect() if r["gain"] == 0}
    assert unused and all(abs(imp[f]["importance_mean"]) < 1e-12 for f in unused)
    assert len(imp) == 15


def test_permuted_index_is_a_permutation(spark):
    from tillpanel.plans.physical import permuted_index
    for n in (1, 2, 3, 5, 7, 31, 97, 200, 1009):
        df = spark.range(n).select("id", permuted_index(F.col("id"), n, F.lit(42), F.lit(3)).alias("a"),
                                   permuted_index(F.col("id"), n, F.lit(42), F.lit(4)).alias("b"))
        rows = df.collect()
        assert sorted(r["a"] for r in rows) == list(range(n)) == sorted(r["b"] for r in rows)
        if n > 90:
            assert sum(r["a"] == r["id"] for r in rows) < n / 10 and sum(r["a"] == r["b"] for r in rows) < n / 10


def test_permuted_index_mixes_evenly(spark):
    from tillpanel.plans.physical import permuted_index
    # over many keys, where row 3 of 50 lands is close to uniform
    df = spark.range(5000).select(permuted_index(F.lit(3), 50, F.lit(1), F.col("id")).alias("to"))
    counts = [r["count"] for r in df.groupBy("to").count().collect()]
    assert len(counts) == 50 and max(counts) < 160 and min(counts) > 50


def brute_shapley(nodes, weights, x):
    """Sum over all feature subsets of the expected values of trees (dicts id -> row) for one row."""
    from itertools import combinations
    from math import factorial

    def value(tree, node, known):
        if node["left"] < 0:
            return node["value"]
        a, b = tree[node["left"]], tree[node["right"]]
        if node["feature"] in known:
            return value(tree, a if x[node["feature"]] <= node["threshold"] else b, known)
        return (a["cover"] * value(tree, a, known) + b["cover"] * value(tree, b, known)) / node["cover"]

    def game(known):
        return sum(weights[t] * value(tree, tree[0], known) for t, tree in nodes.items())

    d = len(x)
    phi = [sum(factorial(k) * factorial(d - k - 1) / factorial(d) * (game({*s, i}) - game(set(s)))
               for k in range(d) for s in combinations([j for j in range(d) if j != i], k)) for i in range(d)]
    return phi, game(set())


@pytest.fixture(scope="module")
def small_boosting(spark):
    import random as rnd
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    r = rnd.Random(1)
    rows = [[r.randint(0, 6) + 0.0, r.random(), r.choice([-1.0, 2.5, 9.0]), r.gauss(0, 1)] for _ in range(400)]
    df = spark.createDataFrame([(i, *x, x[0] * x[1] + (x[2] > 0) * x[3] + 0.1 * r.random()) for i, x in enumerate(rows)],
                               "row_id long, a double, b double, c double, d double, y double")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df).cache()
    return rows, df, GBTRegressor(labelCol="y", maxIter=6, maxDepth=4, stepSize=0.3, seed=1).fit(df)


def test_tree_attributions_equal_the_sum_over_all_subsets(spark, small_boosting):
    from tillpanel.plans.tree_attribution import contributions, tree_nodes
    rows, df, boosted = small_boosting
    trees, weights = {}, {}
    for n in tree_nodes(spark, boosted).collect():
        trees.setdefault(n["tree"], {})[n["id"]] = n
        weights[n["tree"]] = n["weight"]
    found, base = contributions(df, boosted)
    got = {(r["row_id"], r["input"]): r["contribution"] for r in found.collect()}
    predictions = {r["row_id"]: r["prediction"] for r in boosted.transform(df).select("row_id", "prediction").collect()}
    for i in range(0, 400, 23):
        phi, empty = brute_shapley(trees, weights, rows[i])
        assert abs(empty - base) < 1e-9
        assert all(abs(got.get((i, j), 0.0) - v) < 1e-9 for j, v in enumerate(phi))
    for i in range(400):
        assert abs(sum(got.get((i, j), 0.0) for j in range(4)) + base - predictions[i]) < 1e-9


def test_the_beginning_of_a_run_is_the_shorter_run(spark, small_boosting):
    from pyspark.ml.regression import GBTRegressor
    from tillpanel.plans.tree_attribution import staged_predictions
    _, df, boosted = small_boosting
    staged = staged_predictions(df, boosted, [2, 4])
    for n in (2, 4):
        short = GBTRegressor(labelCol="y", maxIter=n, maxDepth=4, stepSize=0.3, seed=1).fit(df)
        gap = staged.filter(F.col("trees") == n).join(short.transform(df).withColumnRenamed("prediction", "own"), "row_id")
        assert gap.count() == 400 and gap.agg(F.max(F.abs(F.col("prediction") - F.col("own")))).first()[0] < 1e-9


def test_points_that_differ_in_trees_share_a_run(fitted):
    from tillpanel.operators.split import rolling_origin_folds
    from tillpanel.plans.model import cv_score, shared_runs
    _, pool, _, _ = fitted
    points = [PARAMS | {"n_estimators": n} for n in (3, 6)] + [PARAMS | {"num_leaves": 15, "n_estimators": 3}]
    assert [(p["n_estimators"], m) for p, m in shared_runs(points)] == [(6, [0, 1]), (3, [2])]
    folds = rolling_origin_folds(pool, 2)
    shared = {(r["candidate"], r["fold"]): r for r in cv_score(pool, folds, points).collect()}
    assert len(shared) == 6
    alone = {r["fold"]: r for r in cv_score(pool, folds, points[:1]).collect()}
    for fold, r in alone.items():
        assert abs(shared[0, fold]["rmsle"] - r["rmsle"]) < 1e-9 and shared[0, fold]["n"] == r["n"]


def test_attributions_of_every_row_sum_to_prediction(fitted):
    _, _, test, model = fitted
    attr = A.attributions(model, test)
    chk = attr.groupBy("row_id").agg(F.sum("attribution").alias("s"), F.first("f_x").alias("fx"),
                                     F.first("base_value").alias("b"), F.count("*").alias("n")).collect()
    assert len(chk) == test.count() and all(abs(r["s"] - (r["fx"] - r["b"])) < 1e-9 and r["n"] == 15 for r in chk)


def test_local_explanation_of_one_row(fitted):
    import json
    _, _, test, model = fitted
    doc = json.loads(A.local_explanation(model, test.limit(1)).first()["json"])
    assert set(doc["attributions"]) == set(doc["features"]) and len(doc["features"]) == 15
    assert abs(sum(doc["attributions"].values()) + doc["base_value"] - doc["predicted_log1p_sales"]) < 1e-9


def test_candidates_are_reproducible_points_of_the_space():
    space = {"a": [1, 2, 3], "b": [4, 5]}
    assert candidates(space, 4, 42) == candidates(space, 4, 42)
    assert sorted(tuple(p.values()) for p in candidates(space, 100, 1)) == [(a, b) for a in (1, 2, 3) for b in (4, 5)]


def test_row_index_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    idx = A.with_row_index(df, ["k"], "i", n_parts=4)
    assert idx.filter(F.col("i") != F.col("k")).count() == 0


def test_the_six_candidates():
    picks = [tuple(p.values()) for p in candidates()]
    assert picks == [(31, 0.03, 200, 5), (15, 0.03, 200, 5), (31, 0.05, 100, 20), (15, 0.1, 100, 5),
                     (15, 0.03, 100, 10), (31, 0.1, 100, 5)]


def test_store_levels_see_earlier_weeks_only_and_tell_all_stores_apart(spark):
    import datetime as dt
    import math
    from tillpanel.plans.model import PRIOR_WEEKS, store_levels, with_earlier_level
    first = dt.date(2020, 1, 3)
    rows = [(s, first + dt.timedelta(7 * w), None if (s + w) % 11 == 0 else math.log1p(100 * s + w)) for s in range(1, 1001) for w in range(4)]
    df = spark.createDataFrame(rows, "store_nbr int, date date, log_sales double")
    got = {(r["store_nbr"], r["date"]): r["store_level"] for r in with_earlier_level(df).collect()}
    assert len(got) == 4000
    for s in (1, 65, 129, 1000):
        for w in range(4):
            mine = [v for t, d, v in rows if t == s and d < first + dt.timedelta(7 * w) and v is not None]
            every = [v for _, d, v in rows if d < first + dt.timedelta(7 * w) and v is not None]
            want = (sum(mine) + PRIOR_WEEKS * sum(every) / len(every)) / (len(mine) + PRIOR_WEEKS) if every else 0.0
            assert abs(got[s, first + dt.timedelta(7 * w)] - want) < 1e-8
    levels = {r["store_nbr"]: r["store_level"] for r in store_levels(df).collect()}
    assert len(levels) == 1001 and len(set(levels.values())) == 1001 and levels[1] != levels[65]
    assert abs(levels[None] - sum(v for *_, v in rows if v is not None) / sum(v is not None for *_, v in rows)) < 1e-8


def test_unknown_stores_get_the_overall_mean(fitted):
    _, pool, test, model = fitted
    row = model.prepared(test.limit(1).withColumn("store_nbr", F.lit(9999))).first()
    known = model.levels.filter("store_nbr IS NULL").first()
    assert row["store_level"] == known["store_level"]


def test_quantiles_by_range_refinement(spark):
    import numpy as np
    from tillpanel.plans import physical as P
    cols = {"different": "rand(1) * 1000 - 300", "hot": "case when id % 3 > 0 then 5.5 else id * 0.25 end",
            "few": "cast(id % 3 as double)", "wide": "pow(10.0, id % 500 - 250) * (case when id % 2 = 0 then -1 else 1 end)",
            "gaps": "case when id % 4 = 0 then null when id % 4 = 1 then double('nan') else id end", "none": "cast(null as double)", "one": "7.25D"}
    df = spark.range(20_000).selectExpr(*[f"{e} as {c}" for c, e in cols.items()]).cache()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = P.exact_quantiles(df, list(cols), probs)
    assert got["none"] == [None] * len(probs)
    data = df.toPandas()
    for c in cols:
        if c != "none":
            want = np.quantile(data[c].dropna().astype(float).to_numpy(), probs)
            assert np.allclose(got[c], want, rtol=1e-12, atol=0), c
    # what reaches the driver in a pass is bounded by the bins, whatever the number of different values
    binned = df.select(P._bin(F.col("different"), -300.0, 700.0, True).alias("b")).groupBy("b").count()
    assert binned.count() <= P.BINS


def test_exact_quantiles_equal_numpy_with_a_hot_value(spark):
    import numpy as np
    from tillpanel.plans.physical import exact_group_quantiles
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 9 < 6, 1.5).otherwise(
        (F.col("id") * 37) % 1001 / 7.0).alias("v"))
    got = {r["g"]: r for r in exact_group_quantiles(df, ["g"], "v", [0.25, 0.5, 0.95]).collect()}
    for g, rows in df.toPandas().groupby("g"):
        for c, p in (("q25", 0.25), ("q50", 0.5), ("q95", 0.95)):
            assert abs(got[g][c] - np.quantile(rows["v"], p)) < 1e-9


def test_row_index_dense_with_ties_and_skew(spark):
    from tillpanel.plans.physical import with_row_index
    # a third of the rows share one key; the index must still be 0..n-1 exactly once
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    idx = with_row_index(df, ["k"], "i", n_parts=6)
    r = idx.agg(F.min("i"), F.max("i"), F.count_distinct("i"), F.count("*")).first()
    assert tuple(r) == (0, 2999, 3000, 3000)
    # order respected: every k=0 row precedes every other row
    assert idx.filter("k = 0").agg(F.max("i")).first()[0] == 999
    # two thirds of equal values still spread over the partitions
    hot = spark.range(0, 6000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"), "id")
    parts = with_row_index(hot, ["k"], "i", n_parts=12).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert parts < 2000
