import datetime as dt

from pyspark.sql import functions as F

from tillpanel.streaming import monitor as M

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _log(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, store_nbr int, http_status int, reason string, "
                                       "latency_s double, predicted_sales double")


def test_histogram_and_quantile(spark):
    vals = [50_000.0, 150_000.0, 150_000.0, 600_000.0, 5_000_000.0]
    log = _log(spark, [(T0, 1, 200, None, 0.1, v) for v in vals])
    h = {r["le"]: r["cum_count"] for r in M.sales_histogram(log).collect()}
    assert h["0"] == 0 and h["100000"] == 1 and h["250000"] == 3 and h["750000"] == 4 and h["+Inf"] == 5
    hist = M.sales_histogram(log)
    med = M.histogram_quantile(hist, 0.5).first()["value"]
    # rank 2.5 falls in (100k, 250k] holding 2 of the 5 → 100k + 150k·(1.5/2)
    assert abs(med - (100_000 + 150_000 * 0.75)) < 1e-6
    top = M.histogram_quantile(hist, 0.99).first()["value"]
    assert top == 3_000_000.0  # +Inf bucket returns the last finite bound


def test_rates_and_ratio(spark):
    rows = [(T0 + dt.timedelta(seconds=10 * i), 1, 200 if i % 4 else 500, None if i % 4 else "internal_error",
             0.01 * i, 1000.0) for i in range(12)]
    log = _log(spark, rows)
    r = M.http_error_ratio(log).filter(F.col("window_start") == T0).first()
    assert r["n"] == 12 and r["n_5xx"] == 3 and abs(r["ratio"] - 0.25) < 1e-12 and r["alert"]
    p = M.prediction_rate(log).filter(F.col("window_start") == T0).first()
    assert p["n"] == 9 and abs(p["rate"] - 9 / 300) < 1e-12


def test_alert_for_gaps_and_islands(spark):
    conds = [True, True, False, True, True, True, True]
    df = spark.createDataFrame([("r", T0 + dt.timedelta(minutes=i), c) for i, c in enumerate(conds)],
                               "rule string, tick timestamp, condition boolean")
    out = M.alert_for(df, 2 * 60).orderBy("tick").collect()
    assert [r["firing"] for r in out] == [False, False, False, False, False, True, True]
    assert out[6]["pending_since"] == T0 + dt.timedelta(minutes=3)
    ep = M.alert_episodes(M.alert_for(df, 2 * 60)).collect()
    assert len(ep) == 1 and ep[0]["fired_at"] == T0 + dt.timedelta(minutes=5)


def test_no_traffic_spine(spark):
    rows = [(T0, 1, 200, None, 0.1, 1.0), (T0 + dt.timedelta(minutes=40), 1, 200, None, 0.1, 1.0)]
    t = M.traffic_per_tick(_log(spark, rows), 15).orderBy("tick").collect()
    zeros = [r for r in t if r["n_window"] == 0]
    assert len(t) == 42 and len(zeros) == 40 - 15


def test_scrape_up_targets(spark):
    hb = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(minutes=5)), ("b", T0)], "target string, ts timestamp")
    s = M.scrape_up(hb, "target", lookback_minutes=1, hold_seconds=60)
    a = s.filter("rule = 'a'").orderBy("tick").collect()
    assert [r["up"] for r in a] == [True, False, False, False, False, True]
    assert [r["firing"] for r in a] == [False, False, True, True, True, False]


def test_a_target_that_dies_is_down_until_the_end(spark):
    hb = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=i)) for i in range(61)]
                               + [("b", T0 + dt.timedelta(minutes=i)) for i in range(11)], "target string, ts timestamp")
    b = M.scrape_up(hb, "target", lookback_minutes=1, hold_seconds=60).filter("rule = 'b'").collect()
    assert sum(not r["up"] for r in b) == 50 and sum(r["firing"] for r in b) == 49


def test_staleness_covers_the_whole_history(spark):
    moves = [("m", T0), ("m", T0 + dt.timedelta(days=5, minutes=5)), ("n", T0 - dt.timedelta(days=200))]
    versions = spark.createDataFrame([(n, "production", t) for n, t in moves], "model_name string, alias string, created_at timestamp")
    got = {(r["model_name"], r["rule"]): r for r in M.staleness_alerts(versions, T0 + dt.timedelta(days=12)).collect()}
    # the first model is replaced five minutes into its warning, before the warning has held for ten
    assert sorted(got) == [("m", "approaching"), ("n", "approaching"), ("n", "stale")]
    assert got["m", "approaching"]["fired_at"] == T0 + dt.timedelta(days=10, minutes=15)
    assert got["n", "stale"]["pending_since"] == T0 - dt.timedelta(days=193)
    assert got["n", "stale"]["until"] == T0 + dt.timedelta(days=12)


def test_model_not_loaded_until_its_first_move(spark):
    day = "timestamp'2024-01-01 00:00:00'"
    runs = spark.sql(f"select * from values ('a', {day}), ('a', {day} + interval 3 day), ('b', {day}), ('c', {day}) as t(model_name, started_at)")
    versions = spark.sql(f"select * from values ('a', 'production', {day} + interval 1 hour), ('b', 'production', {day} + interval 1 minute),"
                         f" ('c', 'staging', {day}) as t(model_name, alias, created_at)")
    got = {r["model_name"]: r for r in M.not_loaded_alerts(runs, versions, "2024-01-10 00:00:00").collect()}
    assert set(got) == {"a", "c"}  # b was loaded within the hold
    assert str(got["a"]["fired_at"]) == "2024-01-01 00:02:00" and str(got["a"]["until"]) == "2024-01-01 01:00:00"
    assert str(got["c"]["until"]) == "2024-01-10 00:00:00"
