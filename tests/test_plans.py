"""Physical-plan properties the design relies on (checked on sf0.001)."""

import re

from conftest import SF_SMALL
from tillpanel.operators import segments as G
from tillpanel.operators.features import with_inputs
from tillpanel.operators.scoring import batch_predict, score_features, validate_requests
from tillpanel.operators.snapshot import latest_per_store, read_snapshot, write_snapshot
from tillpanel.operators.validate import lineitem_feed, validate_panel
from tillpanel.sources.derived import scoring_requests
from tillpanel.sources.panel import weekly_panel


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_scan_pruned_broadcast_single_exchange(spark):
    plan = _plan(weekly_panel(spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    lineitem = [s for s in scans if "l_suppkey" in s][0]
    assert sorted(x.split("#")[0] for x in lineitem.split(",")) == sorted(
        ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"])
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # only the (store, week) aggregate


def test_validation_reads_input_once(spark):
    plan = _plan(validate_panel(lineitem_feed(spark, SF_SMALL)))
    assert len(re.findall(r"FileScan parquet \[l_suppkey", plan)) == 1


def _stored_snapshot(spark, path):
    write_snapshot(latest_per_store(with_inputs(weekly_panel(spark, SF_SMALL))), path)
    return read_snapshot(spark, path)


def test_scoring_does_not_shuffle_requests(spark, tmp_path):
    snap = _stored_snapshot(spark, str(tmp_path / "snapshot"))
    ok, _ = validate_requests(scoring_requests(spark, SF_SMALL))
    plan = _plan(score_features(ok, snap))
    assert "BroadcastHashJoin" in plan
    # a stored snapshot's bytes are known, so the planner broadcasts it and requests stay where they are
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_segment_report_single_expand(spark):
    from pyspark.sql import functions as F
    f = with_inputs(weekly_panel(spark, SF_SMALL)).withColumn("prediction", F.col("sales_lag_1"))
    plan = _plan(G.segment_report(G.add_segments(f)))
    assert plan.count("Expand") == 1


def test_batch_predict_reads_requests_and_snapshot_once(spark, tmp_path):
    snap = _stored_snapshot(spark, str(tmp_path / "snapshot"))
    plan = _plan(batch_predict(scoring_requests(spark, SF_SMALL), snap))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sum("o_orderkey" in s for s in scans) == 1
    assert sum("sales_lag_1" in s for s in scans) == 1
    assert "hashpartitioning" not in plan


def test_sliding_rates_count_before_they_spread(spark):
    from tillpanel.sources.derived import prediction_log
    from tillpanel.streaming import monitor as M
    log = prediction_log(spark, SF_SMALL)
    for df in (M.prediction_rate(log), M.http_error_ratio(log), M.latency_quantiles(log)):
        plan = _plan(df)
        assert "Expand" not in plan
        # the copies per window are made above the first aggregate
        assert plan.index("Generate") < plan.rindex("HashAggregate")
