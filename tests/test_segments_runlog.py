import datetime as dt

from pyspark.sql import functions as F

from tillpanel.operators import runlog as RL
from tillpanel.operators.segments import add_segments, disparity_summary, segment_report, with_disparity


def test_segment_metrics_and_disparity(spark):
    df = spark.createDataFrame([(10.0, 10.0, "A"), (20.0, 20.0, "A"), (30.0, 30.0, "A"),
                                (5.0, 10.0, "B"), (15.0, 20.0, "B"), (25.0, 30.0, "B")],
                               "sales double, prediction double, segment string")
    rep = segment_report(df, ["segment"])
    rows = {r["segment_value"]: r for r in rep.collect()}
    assert rows["A"]["rmsle"] == 0.0 and rows["B"]["rmsle"] > 0 and rows["A"]["n"] == 3
    s = disparity_summary(rep).first()
    assert s["disparity_ratio"] is None and s["flagged"] is False  # best segment has error 0
    flagged = with_disparity(rep).first()
    assert flagged["flagged"] is False


def test_reference_only_buckets(spark):
    ref = spark.createDataFrame([(1, 10.0, 1.0), (1, 12.0, 2.0), (2, 20.0, 3.0), (2, 22.0, 4.0),
                                 (3, 30.0, 5.0), (3, 32.0, 6.0)], "store_nbr int, sales double, unemployment double")
    hold = spark.createDataFrame([(1, 10000.0, 0.0), (3, 1.0, 10.0), (9, 5.0, None)],
                                 "store_nbr int, sales double, unemployment double")
    out = {r["store_nbr"]: r for r in add_segments(hold, ref).collect()}
    assert out[1]["store_size_bucket"] == "small" and out[3]["store_size_bucket"] == "large"
    assert out[1]["unemployment_bucket"] == "Q1_lowest" and out[3]["unemployment_bucket"] == "Q4_highest"
    assert out[9]["store_size_bucket"] is None and out[9]["unemployment_bucket"] is None


def test_two_and_one_store_buckets(spark):
    two = spark.createDataFrame([(1, 5.0, 1.0), (2, 9.0, 1.0)], "store_nbr int, sales double, unemployment double")
    got = {r["store_nbr"]: r["store_size_bucket"] for r in add_segments(two).collect()}
    assert got == {1: "small", 2: "large"}
    one = two.filter("store_nbr = 1")
    assert add_segments(one).first()["store_size_bucket"] == "medium"


def _versions(spark, created):
    rows = [] if created is None else [("m", 1, "production", "r1", created)]
    return spark.createDataFrame(rows, RL.VERSION_SCHEMA)


def test_staleness_boundaries(spark):
    now = dt.datetime(2024, 1, 20, 12, 0, 0)
    cases = {None: "due", dt.timedelta(hours=1): "fresh", dt.timedelta(days=4, hours=23): "fresh",
             dt.timedelta(days=5): "approaching", dt.timedelta(days=6, hours=23): "approaching",
             dt.timedelta(days=7): "due", dt.timedelta(days=8): "due"}
    models = spark.createDataFrame([("m",)], "model_name string")
    for age, want in cases.items():
        v = _versions(spark, None if age is None else now - age)
        got = RL.staleness_status(models, v, now).first()["status"]
        assert got == want, (age, got)


def test_quality_gate_cases(spark):
    inc_schema = "model_name string, incumbent_test_rmsle double"
    cand = spark.createDataFrame([("m", 0.5)], "model_name string, candidate_test_rmsle double")
    none = spark.createDataFrame([], inc_schema)
    assert RL.quality_gate(cand, none).first()["gate_passed"]
    better = spark.createDataFrame([("m", 1e-9)], inc_schema)
    assert not RL.quality_gate(cand, better).first()["gate_passed"]
    tie = spark.createDataFrame([("m", 0.5)], inc_schema)
    assert RL.quality_gate(cand, tie).first()["gate_passed"]
    assert RL.quality_gate(cand, better, register=False).first()["gate_passed"]


def test_incumbent_latest_alias_move(spark):
    t = dt.datetime(2024, 1, 1)
    versions = spark.createDataFrame([("m", 1, "production", "r1", t), ("m", 2, "production", "r2",
                                       t + dt.timedelta(days=1)), ("m", 3, None, "r3", t + dt.timedelta(days=2))],
                                     RL.VERSION_SCHEMA)
    runs = spark.createDataFrame([("r1", "a", "m", "gbt", {}, {"test_rmsle": 0.3}, {}, t),
                                  ("r2", "b", "m", "gbt", {}, {"test_rmsle": 0.2}, {}, t)], RL.RUN_SCHEMA)
    r = RL.incumbent_of(versions, runs).first()
    assert r["version"] == 2 and r["incumbent_test_rmsle"] == 0.2
    tagged = RL.tag_lineage(runs, {"raw_data_rows": 10}).select(F.element_at("tags", "raw_data_rows")).first()[0]
    assert tagged == "10"


def test_absent_dimension_skipped_and_ratio_flag(spark):
    df = spark.createDataFrame([(10.0, 11.0, 1), (20.0, 21.0, 1), (10.0, 30.0, 2), (20.0, 5.0, 2)],
                               "sales double, prediction double, store_nbr int")
    rep = segment_report(df, ["store_size_bucket", "store_nbr"])
    assert {r["segment_dimension"] for r in rep.collect()} == {"store_nbr"}
    s = disparity_summary(rep).first()
    assert s["disparity_ratio"] >= 1.0 and s["flagged"] == (s["disparity_ratio"] > 1.5)


def test_missing_snapshot_raises(spark, tmp_dir):
    import pytest
    from tillpanel.operators.snapshot import read_snapshot
    from tillpanel.sources.panel import PanelNotFoundError
    with pytest.raises(PanelNotFoundError):
        read_snapshot(spark, f"{tmp_dir}/nothing")


def test_model_age_ignores_moves_after_now(spark):
    t = dt.datetime(2024, 1, 1)
    versions = spark.createDataFrame([("m", 1, "production", "r1", t),
                                      ("m", 2, "production", "r2", t + dt.timedelta(days=30))], RL.VERSION_SCHEMA)
    r = RL.model_age(versions, t + dt.timedelta(days=10)).first()
    assert r["version"] == 1 and abs(r["age_days"] - 10.0) < 1e-9


def test_ranks_of_many_equal_stores_use_many_tasks(spark):
    from tillpanel.operators.explore import rank_stores
    from tillpanel.operators.segments import store_size_buckets
    # two thirds of the stores sell the same, one has no sales at all
    panel = spark.range(1, 3001).select(
        F.col("id").cast("int").alias("store_nbr"),
        F.when(F.col("id") == 777, None).when(F.col("id") % 3 == 0, F.col("id") * 1.5).otherwise(100.0).alias("sales"))
    rows = {r["store_nbr"]: r for r in rank_stores(panel).collect()}
    order = sorted(rows, key=lambda s: (rows[s]["avg_sales"] is not None, rows[s]["avg_sales"], s)
                   if rows[s]["avg_sales"] is not None else (False, 0.0, s))
    assert [rows[s]["rank"] for s in order] == list(range(1, 3001))
    sizes = store_size_buckets(panel).groupBy("store_size_bucket").count().collect()
    assert {r[0]: r[1] for r in sizes} == {"small": 1000, "medium": 1000, "large": 1000}
    plan = rank_stores(panel)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
