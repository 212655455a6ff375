import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillpanel.sources.derived import prediction_log
from tillpanel.streaming import monitor as M
from tillpanel.streaming import stream as ST


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_complete_mode(spark):
    s = ST.prediction_log_stream(spark, f"{SF_SMALL}/events.parquet")
    out = ST.run_to_memory(M.error_rate_by_reason(s), "t_err", mode="complete")
    assert _same(out, M.error_rate_by_reason(prediction_log(spark, SF_SMALL)))


def test_stream_append_with_watermark_is_prefix_of_batch(spark):
    s = ST.prediction_log_stream(spark, f"{SF_SMALL}/events.parquet")
    out = ST.run_to_memory(M.request_rate_by_status(s, watermark="10 minutes"), "t_req", mode="append")
    batch = M.request_rate_by_status(prediction_log(spark, SF_SMALL))
    assert out.count() > 0 and out.exceptAll(batch).count() == 0  # closed windows only, all exact


def test_stream_alert_state_equals_batch(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1)
    conds = [True, True, False, True, True, True, True, False, True]
    df = spark.createDataFrame([("r", t0 + dt.timedelta(minutes=i), c) for i, c in enumerate(conds)],
                               "rule string, tick timestamp, condition boolean")
    df.write.parquet(f"{tmp_dir}/ticks")
    stream = spark.readStream.schema("rule string, tick timestamp, condition boolean").parquet(f"{tmp_dir}/ticks")
    got = ST.run_to_memory(ST.alert_for_stream(stream, 120), "t_alert", mode="append")
    want = M.alert_for(df, 120).select("rule", "tick", "condition", "pending_since", "firing")
    assert _same(got, want)


def test_stream_scoring_two_sinks(spark, tmp_dir):
    from tillpanel.operators.features import with_inputs
    from tillpanel.operators.snapshot import latest_per_store
    from tillpanel.sources.panel import weekly_panel
    snap = latest_per_store(with_inputs(weekly_panel(spark, SF_SMALL)))
    o = spark.readStream.schema(spark.read.parquet(f"{SF_SMALL}/orders.parquet").schema).option(
        "basePath", SF_SMALL).parquet(f"{SF_SMALL}/orders.parque[t]")
    from tillpanel.sources.derived import requests_from_orders
    q = ST.stream_scoring(requests_from_orders(o), snap, f"{tmp_dir}/ok", f"{tmp_dir}/bad", f"{tmp_dir}/ck")
    q.awaitTermination()
    ok, bad = spark.read.parquet(f"{tmp_dir}/ok"), spark.read.parquet(f"{tmp_dir}/bad")
    n_orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert ok.count() + bad.count() == n_orders
    assert bad.filter(F.col("status") != "invalid").count() == 0
    assert ok.filter("status = 'ok' AND predicted_sales < 0").count() == 0


def test_start_monitoring_closed_windows_match_batch(spark, tmp_dir):
    qs = ST.start_monitoring(spark, f"{SF_SMALL}/events.parquet", f"{tmp_dir}/mon", available_now=True)
    for q in qs.values():
        q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/mon/http_error_ratio")
    batch = M.http_error_ratio(prediction_log(spark, SF_SMALL))
    assert got.count() > 0 and got.exceptAll(batch.select(*got.columns)).count() == 0
    lat = spark.read.parquet(f"{tmp_dir}/mon/latency_quantiles")
    assert lat.filter("p50 > p95").count() == 0


def test_no_traffic_stream_with_heartbeats_matches_batch_spine(spark, tmp_dir):
    log = prediction_log(spark, SF_SMALL)
    ticks = M.minute_ticks(log)
    # one heartbeat per minute over the log's span (what a scraper would emit)
    ticks.select((F.col("tick") - F.expr("INTERVAL 30 SECONDS")).alias("ts")).write.parquet(f"{tmp_dir}/hb")
    hb = spark.readStream.schema(ST.HEARTBEAT_SCHEMA).parquet(f"{tmp_dir}/hb")
    s = ST.prediction_log_stream(spark, f"{SF_SMALL}/events.parquet")
    got = ST.run_to_memory(ST.no_traffic_stream(s, hb, watermark=None), "t_nt", mode="complete")
    batch = M.traffic_per_tick(log, 15).withColumnRenamed("n_window", "n_batch")
    j = got.join(batch, got["window_end"] == batch["tick"])
    assert j.count() >= batch.count() - 15
    assert j.filter(F.col("n_window") != F.col("n_batch")).count() == 0


def _log_rows(spark, rows):
    """(event id, seconds after the start, status, latency) → log rows."""
    t0 = dt.datetime(2031, 5, 4, 6, 0)
    from tillpanel.sources.derived import PREDICTION_LOG_SCHEMA
    data = [(i, t0 + dt.timedelta(seconds=s), 1 + s % 3, st, "internal_error" if st >= 500 else None, lat, None)
            for i, s, st, lat in rows]
    return spark.createDataFrame(data, PREDICTION_LOG_SCHEMA)


def _three_files(spark, folder):
    """Files in order of arrival: a third of the log each, replays in the second, late rows in the third."""
    rows = [(i, 17 * i, 500 if i % 7 == 0 else 200, (i * 37 % 101) / 100.0) for i in range(600)]
    late, nameless = (9001, 30, 200, 9.0), (None, 10000, 200, 0.5)
    parts = [rows[:200], rows[150:400] + [nameless, nameless], rows[400:] + [late, late, nameless]]
    for p in parts:
        _log_rows(spark, p).coalesce(1).write.mode("append").parquet(folder)
    return _log_rows(spark, rows + [nameless]), _log_rows(spark, [late])


def test_windows_of_replayed_and_late_files_equal_batch(spark, tmp_dir):
    from tillpanel.sources.derived import read_prediction_log
    in_time, _ = _three_files(spark, f"{tmp_dir}/log")
    ended = read_prediction_log(spark, f"{tmp_dir}/log")
    for name, monitor in ST.monitors().items():
        src = spark.readStream.schema(ended.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/log")
        got = ST.run_to_end(src, ended, monitor, f"{tmp_dir}/out-{name}")
        want = monitor(in_time, method="sketch") if name == "latency_quantiles" else monitor(in_time)
        assert want.count() > 20 and _same(got, want.select(*got.columns)), name


def test_landed_log_and_late_side_table(spark, tmp_dir):
    from tillpanel.sources.derived import read_prediction_log
    in_time, late = _three_files(spark, f"{tmp_dir}/log")
    raw = read_prediction_log(spark, f"{tmp_dir}/log")
    src = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/log")
    for _ in range(2):  # a second run from the checkpoint adds nothing
        ST.land_log(src, f"{tmp_dir}/landed").awaitTermination()
    landed = spark.read.parquet(f"{tmp_dir}/landed/rows")
    rows = lambda df: sorted(map(repr, df.select(*raw.columns).collect()))
    assert rows(landed) == rows(in_time) and rows(ST.late_rows(raw, landed)) == rows(late)


def test_empty_log_ends_without_windows(spark, tmp_dir):
    empty = _log_rows(spark, [])
    empty.write.parquet(f"{tmp_dir}/log")
    src = spark.readStream.schema(empty.schema).parquet(f"{tmp_dir}/log")
    assert ST.run_to_end(src, empty, M.prediction_rate, f"{tmp_dir}/out").count() == 0


def test_latency_sketch_ranks(spark):
    """One busy window: far more values than the sketch keeps, rank error against the exact order."""
    n = 300_000
    log = spark.range(n).select(
        F.timestamp_seconds(F.lit(1_900_000_020) + F.col("id") % 55).alias("ts"), F.lit(200).alias("http_status"),
        ((F.col("id") * 7919) % n / F.lit(float(n))).alias("latency_s"))
    busy = M.latency_quantiles(log, method="sketch").filter(F.col("n") == n).first()
    assert abs(busy["p50"] - 0.5) < 0.004 and abs(busy["p95"] - 0.95) < 0.004
    odd = _log_rows(spark, [(1, 0, 200, None), (2, 1, 200, float("nan"))])
    assert {(r["n"], r["p50"], r["alert"]) for r in M.latency_quantiles(odd, method="sketch").collect()} == {(2, None, None)}


def test_alert_state_over_batches_drops_replays(spark, tmp_dir):
    t0 = dt.datetime(2031, 1, 1)
    conds = [False, True, True, None, True, True, True, True, False, True, True, True, True]
    schema = "rule string, tick timestamp, condition boolean"
    rows = [("r", t0 + dt.timedelta(minutes=i), c) for i, c in enumerate(conds)]
    for lo, hi in ((0, 3), (2, 6), (6, 7), (7, 13)):  # the second file repeats a tick
        spark.createDataFrame(rows[lo:hi], schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ticks")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/ticks")
    got = ST.run_to_table(ST.alert_for_stream(src, 120), f"{tmp_dir}/alerts")
    want = M.alert_for(spark.createDataFrame([(r, t, bool(c)) for r, t, c in rows], schema), 120)
    assert _same(got, want.select(*got.columns))
