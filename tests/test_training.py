"""Training job orchestration with a deterministic stand-in model (fast)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, toy_panel, week_sales
from tillpanel.operators import runlog as RL
from tillpanel.operators.features import with_inputs
from tillpanel.operators.segments import fairness_report
from tillpanel.plans.reports import segment_summary_json, write_report_tables
from tillpanel.plans.training import run_training
from tillpanel.sources.panel import densify_panel, panel_table, weekly_panel


class ScaledPersistence:
    """log_prediction = log1p(factor · last week's sales)."""

    def __init__(self, factor):
        self.factor = factor

    def transform(self, df):
        return df.withColumn("log_prediction", F.log1p(F.coalesce("sales_lag_1", F.lit(0.0)) * self.factor))

    def save(self, path):
        pass


def fitter_for(factor):
    return lambda train, params: ScaledPersistence(factor)


def _run(spark, panel, out, factor, register=True):
    return run_training(spark, panel, out, points=[{"num_leaves": 7}, {"num_leaves": 15}], n_splits=2, test_weeks=4,
                        register=register, fitter=fitter_for(factor), lineage={"raw_data_sha256": "abc"})


def test_gate_promotes_rejects_and_ties(spark, tmp_dir):
    panel = weekly_panel(spark, SF_SMALL)
    first = _run(spark, panel, tmp_dir, 1.0)
    assert first.promoted and first.incumbent is None and set(first.reports) == {"fairness_metrics", "fairness_summary"}
    worse = _run(spark, panel, tmp_dir, 3.0)
    assert not worse.promoted and worse.released is None and worse.reports == {}
    v = RL.read_versions(spark, f"{tmp_dir}/versions")
    assert v.count() == 1  # alias unchanged, nothing registered
    tie = _run(spark, panel, tmp_dir, 1.0)
    assert tie.promoted
    cur = RL.current_alias(RL.read_versions(spark, f"{tmp_dir}/versions")).first()
    assert cur["version"] == 2 and cur["run_id"] == tie.run_id
    runs = RL.read_runs(spark, f"{tmp_dir}/runs")
    gates = [r[0] for r in runs.filter("run_name = 'holdout'").select(F.element_at("tags", "quality_gate")).collect()]
    assert sorted(gates) == ["fail", "pass", "pass"]
    # lineage on every run and version, disparity on the released runs, one row per candidate and job
    assert runs.filter(F.element_at("tags", "raw_data_sha256") == "abc").count() == runs.count()
    assert RL.read_versions(spark, f"{tmp_dir}/versions").filter(F.element_at("tags", "raw_data_rows").isNull()).count() == 0
    released = runs.filter("run_name = 'release'").collect()
    assert len(released) == 2 and all("fairness_disparity_ratio_store_nbr" in r["metrics"] for r in released)
    assert runs.filter("run_name LIKE 'search-%'").count() == 6


def test_claimed_versions_are_nobody_elses(spark, tmp_dir):
    path = f"{tmp_dir}/versions"
    assert [RL.claim_version(spark, path, m) for m in ("a", "a", "b/ü", "a")] == [1, 2, 1, 3]

    # a file that another job created between the listing and the claim
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(f"{tmp_dir}/claim")
    fs = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert RL._created(fs, file) and not RL._created(fs, file)


def test_a_failing_release_leaves_no_version(spark, tmp_dir):
    class Unsaved(ScaledPersistence):
        def save(self, path):
            raise OSError("no space")

    with pytest.raises(OSError):
        run_training(spark, weekly_panel(spark, SF_SMALL), tmp_dir, points=[{"num_leaves": 7}], n_splits=2, test_weeks=4,
                     fitter=lambda train, params: Unsaved(1.0))
    assert not os.path.exists(f"{tmp_dir}/versions") and not os.path.exists(f"{tmp_dir}/runs")


def test_gate_off_when_not_registering(spark, tmp_dir):
    panel = weekly_panel(spark, SF_SMALL)
    _run(spark, panel, tmp_dir, 1.0)
    off = _run(spark, panel, tmp_dir, 5.0, register=False)
    assert off.promoted


def test_a_real_model_is_released_with_all_reports(spark, tmp_dir):
    points = [{"num_leaves": 7, "n_estimators": n, "learning_rate": 0.3, "min_child_samples": 5} for n in (2, 4)]
    result = run_training(spark, weekly_panel(spark, SF_SMALL), tmp_dir, points=points, n_splits=2, test_weeks=4)
    assert result.promoted and set(result.reports) == {
        "fairness_metrics", "fairness_summary", "native_gain_importance", "attribution_top_features",
        "permutation_importance_holdout", "local_example"}
    doc = json.loads(spark.read.text(result.reports["local_example"]).first()[0])
    assert abs(sum(doc["attributions"].values()) + doc["base_value"] - doc["predicted_log1p_sales"]) < 1e-9
    assert spark.read.option("header", True).csv(result.reports["permutation_importance_holdout"]).count() == 15


def test_reports_written(spark, tmp_dir):
    feats = with_inputs(toy_panel(spark, stores=(1, 2, 3, 4), weeks=12))
    ev = feats.filter(F.col("sales_lag_1").isNotNull()).withColumn("prediction", F.col("sales_lag_1") * 1.1)
    rep = fairness_report(ev)
    doc = json.loads(segment_summary_json(rep, ev).first()["json"])
    assert doc["evaluation_rows"] == ev.count() and set(doc["segments"]) >= {"store_size_bucket", "store_nbr"}
    paths = write_report_tables(f"{tmp_dir}/rep", rep, segment_summary_json(rep, ev))
    assert spark.read.option("header", True).csv(paths["fairness_metrics"]).count() == rep.count()
    assert spark.read.text(paths["fairness_summary"]).count() == 1


def test_densify_fills_gaps(spark):
    panel = toy_panel(spark, stores=(1, 2), weeks=6).filter(~((F.col("store_nbr") == 2) & (F.col("sales") == week_sales(2, 3))))
    d = densify_panel(panel)
    assert d.count() == 12
    hole = d.filter("store_nbr = 2 AND sales IS NULL").collect()
    assert len(hole) == 1 and hole[0]["holiday_flag"] == 0


def test_panel_table_materialised_once(spark):
    a = panel_table(spark, SF_SMALL)
    b = panel_table(spark, SF_SMALL)
    assert a.inputFiles() == b.inputFiles()
    assert a.exceptAll(weekly_panel(spark, SF_SMALL)).count() == 0


def test_panel_total_equals_brute_force(spark):
    import duckdb
    total = weekly_panel(spark, SF_SMALL).agg(F.sum("sales")).first()[0]
    n = weekly_panel(spark, SF_SMALL).agg(F.sum(F.lit(1))).first()[0]
    exact = duckdb.sql(f"SELECT SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) "
                       f"FROM '{SF_SMALL}/lineitem.parquet'").fetchall()[0][0]
    assert abs(total - float(exact)) < 1e-6 * float(exact) and n > 0


def test_table_fingerprint_order_free(spark, tmp_dir):
    from tillpanel.sources.derived import read_prediction_log
    from tillpanel.sources.panel import table_fingerprint
    df = spark.range(0, 1000).select("id", (F.col("id") % 7).alias("g"))
    a = table_fingerprint(df).first()
    b = table_fingerprint(df.repartition(5).orderBy(F.desc("id"))).first()
    assert a == b and a["n_rows"] == 1000
    from tillpanel.sources.derived import prediction_log
    prediction_log(spark, SF_SMALL).write.parquet(f"{tmp_dir}/log")
    assert read_prediction_log(spark, f"{tmp_dir}/log").count() == prediction_log(spark, SF_SMALL).count()
