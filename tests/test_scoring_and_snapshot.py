import datetime as dt

from pyspark.sql import functions as F

from conftest import FIRST_WEEK, toy_panel, week_sales
from tillpanel.operators.features import with_inputs
from tillpanel.operators.scoring import batch_predict, check_batch_size, validate_requests
from tillpanel.operators.snapshot import latest_per_store, read_snapshot, write_snapshot

REQ = ("request_id long, batch_id long, store_nbr int, date date, holiday_flag int, temperature double, "
       "fuel_price double, cpi double, unemployment double")


def _snap(spark):
    return latest_per_store(with_inputs(toy_panel(spark, stores=(1, 2, 3), weeks=12)))


def test_snapshot_one_row_per_store_latest(spark, tmp_dir):
    snap = _snap(spark)
    rows = {r["store_nbr"]: r for r in snap.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1]["sales_lag_1"] == week_sales(1, 10)  # last week's own lag
    write_snapshot(snap, f"{tmp_dir}/snap")
    back = read_snapshot(spark, f"{tmp_dir}/snap")
    assert back.count() == 3 and set(back.columns) == set(snap.columns)


def test_request_routing(spark):
    d = dt.date(2012, 11, 2)
    reqs = spark.createDataFrame([
        (1, 1, 46, d, None, None, None, None, None),   # out of range -> invalid
        (2, 1, 4, d, None, None, None, None, None),    # unknown store
        (3, 1, 1, None, None, None, None, None, None),  # missing date
        (4, 1, 1, d, 2, None, None, None, None),       # bad flag
        (5, 2, 1, d, None, 60.0, None, None, None),    # ok with override
        (6, 2, 2, dt.date(2012, 12, 28), None, None, None, None, None),  # ok, holiday week
    ], REQ)
    out = {r["request_id"]: r for r in batch_predict(reqs, _snap(spark)).collect()}
    assert out[1]["status"] == "invalid" and out[3]["status"] == "invalid" and out[4]["status"] == "invalid"
    assert out[2]["status"] == "unknown_store" and out[2]["predicted_sales"] is None
    assert out[5]["status"] == "ok" and out[6]["status"] == "ok"
    assert out[5]["predicted_sales"] == round(week_sales(1, 10), 2)
    assert out[5]["predicted_sales"] >= 0


def test_overrides_and_holiday_from_date(spark):
    from tillpanel.operators.scoring import score_features
    reqs = spark.createDataFrame([
        (1, 1, 1, dt.date(2012, 12, 28), None, 70.0, None, None, None),
        (2, 1, 1, dt.date(2012, 11, 2), None, None, None, None, None)], REQ)
    ok, _ = validate_requests(reqs)
    f = {r["request_id"]: r for r in score_features(ok, _snap(spark)).collect()}
    assert f[1]["holiday_flag"] == 1 and f[2]["holiday_flag"] == 0
    assert f[1]["temperature"] == 70.0 and f[2]["temperature"] == 41.5 + 11 % 9


def test_batch_size_limits(spark):
    reqs = spark.range(0, 7).select(F.col("id").alias("request_id"), (F.col("id") % 2).alias("batch_id"))
    out = {r["batch_id"]: r for r in check_batch_size(reqs, max_items=3).collect()}
    assert out[0]["n_items"] == 4 and not out[0]["ok"]
    assert out[1]["n_items"] == 3 and out[1]["ok"]


def test_advanced_snapshot_uses_last_week(spark):
    from tillpanel.operators.snapshot import advanced_snapshot
    snap = {r["store_nbr"]: r for r in advanced_snapshot(toy_panel(spark, stores=(1,), weeks=12)).collect()}
    assert snap[1]["sales_lag_1"] == week_sales(1, 11)  # the last week's own sales
    assert snap[1]["sales_roll_mean_4"] == sum(week_sales(1, w) for w in range(8, 12)) / 4
    assert snap[1]["target_date"] == dt.date.fromisoformat(FIRST_WEEK) + dt.timedelta(days=7 * 12)


def test_prepared_snapshot_same_result(spark):
    from tillpanel.operators.scoring import PreparedSnapshot
    d = dt.date(2012, 11, 2)
    reqs = spark.createDataFrame([(1, 1, 1, d, None, None, None, None, None),
                                  (2, 1, 9, d, None, None, None, None, None)], REQ)
    a = batch_predict(reqs, _snap(spark))
    b = batch_predict(reqs, PreparedSnapshot(_snap(spark)))
    assert a.exceptAll(b).count() == 0 and b.count() == 2


def test_requests_of_an_oversized_batch_are_invalid(spark):
    from conftest import SF_SMALL
    from tillpanel.operators.features import with_inputs
    from tillpanel.operators.scoring import batch_predict
    from tillpanel.operators.snapshot import latest_per_store
    from tillpanel.sources.derived import scoring_requests
    from tillpanel.sources.panel import weekly_panel
    requests = scoring_requests(spark, SF_SMALL)
    snap = latest_per_store(with_inputs(weekly_panel(spark, SF_SMALL)))
    sizes = {r[0]: r[1] for r in requests.groupBy("batch_id").count().collect()}
    batch_of = {r[0]: r[1] for r in requests.select("request_id", "batch_id").collect()}
    limit = max(sizes.values()) - 1
    plain = {r["request_id"]: r["status"] for r in batch_predict(requests, snap).collect()}
    bound = {r["request_id"]: r["status"] for r in batch_predict(requests, snap, batch_col="batch_id", max_items=limit).collect()}
    assert set(plain) == set(bound) and any(plain[i] != bound[i] for i in plain)
    for i, status in bound.items():
        assert status == ("invalid" if sizes[batch_of[i]] > limit else plain[i])
