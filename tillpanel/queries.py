"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the driver's tables (through the derived panel or the
derived logs) so its work grows with them. Order-dependent floating results
(averages, roots) are rounded — money to 2 decimals, ratios/logs to 6 — so
the DuckDB twin in :mod:`tillpanel.oracles` can be compared value by value.
"""

from __future__ import annotations

import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.functions.calendar import (LABOR_DAY, SUPER_BOWL, THANKSGIVING, is_major_holiday_week,
                                          nth_weekday, week_ending_friday)
from tillpanel.operators import explore as X
from tillpanel.operators import runlog as RL
from tillpanel.operators import scoring as S
from tillpanel.operators import segments as G
from tillpanel.operators.evaluate import evaluate_all, naive_baseline
from tillpanel.operators.features import with_inputs, model_inputs
from tillpanel.operators.snapshot import advanced_snapshot, latest_per_store, read_snapshot, write_snapshot
from tillpanel.operators.split import assert_disjoint, assign_folds, holdout_cutoff, rolling_origin_folds
from tillpanel.operators.validate import lineitem_feed, quarantine, validate_panel
from tillpanel.plans import attribution as A
from tillpanel.plans.model import gain_importance, score_in_sales_space, store_levels, with_earlier_level
from tillpanel.plans.reports import segment_summary_json
from tillpanel.plans.training import run_training
from tillpanel.session import scratch_path
from tillpanel.sources.derived import (model_versions, prediction_log, requests_from_orders, run_log,
                                      scoring_requests)
from tillpanel.sources.panel import (densify_panel, file_fingerprint, input_state, panel_profile, panel_table, read_table,
                                     table_fingerprint, weekly_panel)
from tillpanel.streaming import monitor as M
from tillpanel.streaming import stream as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r2(c):
    return F.round(c, 2)


def r6(c):
    return F.round(c, 6)


def rounded_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({"rmsle": r6(F.col("rmsle")), "mae": r2(F.col("mae")), "rmse": r2(F.col("rmse"))})


def features(spark, sf_dir) -> DataFrame:
    return with_inputs(panel_table(spark, sf_dir))


# ---------------------------------------------------------------- 2.1 sources
@query("panel")
def q_panel(spark, sf_dir):
    return weekly_panel(spark, sf_dir)  # derived from lineitem ⋈ supplier every time


@query("features")
def q_features(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select(
        "store_nbr", "date", "sales", "holiday_flag", "month", "week_of_year", "year",
        "sales_lag_1", "sales_lag_4", "sales_lag_52",
        "sales_roll_mean_4", "sales_roll_mean_8",
        r2(F.col("sales_roll_std_4")).alias("sales_roll_std_4"),
        r6(F.col("log_sales")).alias("log_sales"),
    )


@query("naive_baseline_holdout")
def q_naive_baseline_holdout(spark, sf_dir, test_weeks: int = 8):
    f = features(spark, sf_dir)
    cutoff = holdout_cutoff(f, test_weeks)
    test = f.filter(F.col("date") >= F.lit(cutoff))
    return rounded_metrics(naive_baseline(test)).select(F.lit(cutoff).alias("cutoff"), "*")


# ---------------------------------------------------------------- 2.1 / 2.2 quality


def holdout_test(spark, sf_dir, test_weeks: int = 8):
    f = features(spark, sf_dir)
    cutoff = holdout_cutoff(f, test_weeks)
    return f.filter(F.col("date") < F.lit(cutoff)), f.filter(F.col("date") >= F.lit(cutoff))


@query("panel_profile")
def q_panel_profile(spark, sf_dir):
    return panel_profile(panel_table(spark, sf_dir))


@query("validation_report")
def q_validation_report(spark, sf_dir):
    return validate_panel(panel_table(spark, sf_dir))


@query("validation_report_feed")
def q_validation_report_feed(spark, sf_dir):
    return validate_panel(lineitem_feed(spark, sf_dir))


@query("quarantine_counts")
def q_quarantine_counts(spark, sf_dir):
    q = quarantine(lineitem_feed(spark, sf_dir))
    return (q.select(F.explode("violations").alias("violation"))
            .groupBy("violation").agg(F.count(F.lit(1)).alias("n")))


@query("model_columns")
def q_model_columns(spark, sf_dir):
    return model_inputs(features(spark, sf_dir)).select(
        "store_nbr", "holiday_flag", "month", "week_of_year", "year", "sales_lag_1", "sales_lag_4",
        "sales_lag_52", "sales_roll_mean_4", "sales_roll_mean_8")


# ---------------------------------------------------------------- 2.4 aggregations
@query("naive_baseline_all")
def q_naive_baseline_all(spark, sf_dir):
    return rounded_metrics(naive_baseline(features(spark, sf_dir)))


@query("naive_baseline_by_store")
def q_naive_baseline_by_store(spark, sf_dir):
    _, test = holdout_test(spark, sf_dir)
    return rounded_metrics(naive_baseline(test, by=["store_nbr"]))


@query("store_avg_sales")
def q_store_avg_sales(spark, sf_dir):
    return X.store_avg_sales(panel_table(spark, sf_dir))


@query("rank_stores")
def q_rank_stores(spark, sf_dir):
    return X.rank_stores(panel_table(spark, sf_dir))


@query("store_scale_range")
def q_store_scale_range(spark, sf_dir):
    return X.store_scale_range(panel_table(spark, sf_dir))


@query("weekly_total")
def q_weekly_total(spark, sf_dir):
    return X.weekly_total(panel_table(spark, sf_dir))


@query("holiday_effect")
def q_holiday_effect(spark, sf_dir):
    return X.holiday_effect(panel_table(spark, sf_dir))


@query("distinct_holiday_weeks")
def q_distinct_holiday_weeks(spark, sf_dir):
    return X.distinct_holiday_weeks(panel_table(spark, sf_dir))


@query("indicator_by_store")
def q_indicator_by_store(spark, sf_dir):
    d = X.indicator_by_store(panel_table(spark, sf_dir))
    return d.select("store_nbr", r6(F.col("cpi")).alias("cpi"), r6(F.col("unemployment")).alias("unemployment"))


@query("describe_indicators")
def q_describe_indicators(spark, sf_dir):
    d = X.describe_over_stores(panel_table(spark, sf_dir))
    return d.select("stat", r6(F.col("cpi")).alias("cpi"), r6(F.col("unemployment")).alias("unemployment"))


def _binned(spark, sf_dir, col):
    b = X.indicator_vs_sales(panel_table(spark, sf_dir), col, bins=10)
    return b.withColumn("corr", r6(F.col("corr")))


@query("temperature_vs_sales")
def q_temperature_vs_sales(spark, sf_dir):
    return _binned(spark, sf_dir, "temperature")


@query("fuel_price_vs_sales")
def q_fuel_price_vs_sales(spark, sf_dir):
    return _binned(spark, sf_dir, "fuel_price")


@query("evaluation_window")
def q_evaluation_window(spark, sf_dir):
    _, test = holdout_test(spark, sf_dir)
    return X.evaluation_window(test)


# ---------------------------------------------------------------- 2.8 calendar
@query("holiday_anchors")
def q_holiday_anchors(spark, sf_dir):
    years = panel_table(spark, sf_dir).select(F.year("date").alias("year")).distinct()
    y = F.col("year")
    anchors = {
        "super_bowl": nth_weekday(y, *SUPER_BOWL),
        "labor_day": nth_weekday(y, *LABOR_DAY),
        "thanksgiving": nth_weekday(y, *THANKSGIVING),
        "christmas": F.make_date(y, F.lit(12), F.lit(25)),
    }
    cols = {k: v for k, v in anchors.items()}
    cols.update({f"{k}_week": week_ending_friday(v) for k, v in anchors.items()})
    return years.select("year", *[v.alias(k) for k, v in cols.items()])


@query("calendar_features")
def q_calendar_features(spark, sf_dir):
    """Calendar fields and the holiday rule on every weekday of the panel's weeks."""
    dates = panel_table(spark, sf_dir).select("date").distinct()
    days = dates.select(F.explode(F.sequence(F.date_sub("date", 6), F.col("date"))).alias("day"))
    d = F.col("day")
    return days.select("day", F.month(d).alias("month"), F.weekofyear(d).alias("week_of_year"),
                       F.year(d).alias("year"), F.weekday(d).alias("weekday"),
                       week_ending_friday(d).alias("week_friday"),
                       is_major_holiday_week(d).alias("holiday_flag"))


# ---------------------------------------------------------------- 2.5 snapshot / 2.3 scoring
def snapshot_of(spark, sf_dir):
    return latest_per_store(features(spark, sf_dir))


def round_std(df):
    return df.withColumn("sales_roll_std_4", r2(F.col("sales_roll_std_4")))


@query("snapshot")
def q_snapshot(spark, sf_dir):
    return round_std(snapshot_of(spark, sf_dir))


@query("request_validation")
def q_request_validation(spark, sf_dir):
    _, rejected = S.validate_requests(scoring_requests(spark, sf_dir))
    return rejected.select("request_id", "store_nbr", "date", F.array_join("reasons", ",").alias("reasons"))


@query("batch_size_check")
def q_batch_size_check(spark, sf_dir):
    return S.check_batch_size(scoring_requests(spark, sf_dir))


@query("score_features")
def q_score_features(spark, sf_dir):
    ok, _ = S.validate_requests(scoring_requests(spark, sf_dir))
    return round_std(S.score_features(ok, snapshot_of(spark, sf_dir)))


@query("unknown_stores")
def q_unknown_stores(spark, sf_dir):
    ok, _ = S.validate_requests(scoring_requests(spark, sf_dir))
    return S.unknown_stores(ok, snapshot_of(spark, sf_dir)).select("request_id", "store_nbr", "date")


@query("batch_predict_naive")
def q_batch_predict_naive(spark, sf_dir):
    out = S.batch_predict(scoring_requests(spark, sf_dir), snapshot_of(spark, sf_dir), cents=False, batch_col="batch_id")
    # 4 decimals: the exact persistence value survives the log round trip
    return out.withColumn("predicted_sales", F.round("predicted_sales", 4))


@query("batch_predict_limited")
def q_batch_predict_limited(spark, sf_dir):
    """A limit that many of the batches exceed: all requests of such a batch are invalid."""
    out = S.batch_predict(scoring_requests(spark, sf_dir), snapshot_of(spark, sf_dir), cents=False, batch_col="batch_id",
                          max_items=12)
    # 4 decimals: the exact persistence value survives the log round trip
    return out.withColumn("predicted_sales", F.round("predicted_sales", 4))


# ---------------------------------------------------------------- 2.11 segments / fairness


def naive_holdout_frames(spark, sf_dir, test_weeks: int = 8):
    """(pool, test with ``prediction`` = persistence forecast)."""
    pool, test = holdout_test(spark, sf_dir, test_weeks)
    return pool, test.withColumn("prediction", F.col("sales_lag_1"))


def rounded_report(df):
    return rounded_metrics(df).withColumn("disparity_ratio", r6(F.col("disparity_ratio")))


@query("store_size_buckets")
def q_store_size_buckets(spark, sf_dir):
    pool, _ = holdout_test(spark, sf_dir)
    return G.store_size_buckets(pool).select("store_nbr", "avg_sales", "rank", "store_size_bucket")


@query("unemployment_edges")
def q_unemployment_edges(spark, sf_dir):
    pool, _ = holdout_test(spark, sf_dir)
    edges = G.unemployment_edges(pool)
    return spark.createDataFrame(list(enumerate(edges)), "edge_index int, edge double").withColumn("edge", r6(F.col("edge")))


@query("holdout_segments")
def q_holdout_segments(spark, sf_dir):
    pool, test = naive_holdout_frames(spark, sf_dir)
    return G.add_segments(test, pool).select(
        "store_nbr", "date", "unemployment", "store_size_bucket", "unemployment_bucket")


@query("segment_performance_size")
def q_segment_performance_size(spark, sf_dir):
    pool, test = naive_holdout_frames(spark, sf_dir)
    return rounded_metrics(G.segment_performance(G.add_segments(test, pool), "store_size_bucket"))


@query("fairness_report")
def q_fairness_report(spark, sf_dir):
    pool, test = naive_holdout_frames(spark, sf_dir)
    return rounded_report(G.fairness_report(test, pool))


@query("fairness_report_self")
def q_fairness_report_self(spark, sf_dir):
    """Exploratory form: boundaries from the evaluated rows themselves (all weeks)."""
    f = features(spark, sf_dir).withColumn("prediction", F.col("sales_lag_1"))
    return rounded_report(G.fairness_report(f))


@query("disparity_summary")
def q_disparity_summary(spark, sf_dir):
    pool, test = naive_holdout_frames(spark, sf_dir)
    rep = G.segment_report(G.add_segments(test, pool))
    return G.disparity_summary(rep).withColumn("disparity_ratio", r6(F.col("disparity_ratio")))


@query("worst_store_latest")
def q_worst_store_latest(spark, sf_dir):
    pool, test = naive_holdout_frames(spark, sf_dir)
    per_store = naive_baseline(test, by=["store_nbr"])
    row = G.worst_segment_row(test.select("store_nbr", "date", "sales", "prediction"), per_store)
    return row


# ---------------------------------------------------------------- 2.5 folds / 2.7 sets
@query("cv_folds")
def q_cv_folds(spark, sf_dir):
    pool, _ = holdout_test(spark, sf_dir)
    return rolling_origin_folds(pool, 3)


@query("fold_sizes")
def q_fold_sizes(spark, sf_dir):
    pool, _ = holdout_test(spark, sf_dir)
    rows = assign_folds(pool.select("store_nbr", "date", "sales"), rolling_origin_folds(pool, 3))
    return rows.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("date").alias("n_weeks"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("naive_cv_scores")
def q_naive_cv_scores(spark, sf_dir):
    """Persistence forecast scored per CV fold, and the fold mean (I2/D18)."""
    pool, _ = holdout_test(spark, sf_dir)
    valid = assign_folds(pool, rolling_origin_folds(pool, 3)).filter(F.col("role") == "valid")
    per_fold = naive_baseline(valid, by=["fold"])
    mean = per_fold.agg(F.avg("rmsle").alias("rmsle")).select(F.lit(-1).alias("fold"), "rmsle")
    return per_fold.select("fold", "rmsle").unionByName(mean).withColumn("rmsle", r6(F.col("rmsle")))


@query("holdout_disjoint")
def q_holdout_disjoint(spark, sf_dir):
    pool, test = holdout_test(spark, sf_dir)
    return assert_disjoint(pool, test)


# ---------------------------------------------------------------- 2.1 / 2.9 / 2.12 run log, gate, staleness

# Fixed "now" of the staleness queries: the end of the last order day
# (orders, hence versions, end on 2001-08-01).
STALENESS_NOW = "2001-08-02 00:00:00"


@query("run_log_read")
def q_run_log_read(spark, sf_dir):
    r = run_log(spark, sf_dir)
    return r.select("run_id", "run_name", "model_name", "model_type",
                    F.element_at("params", F.lit("max_depth")).alias("max_depth"),
                    F.element_at("metrics", F.lit("test_rmsle")).alias("test_rmsle"),
                    F.element_at("tags", F.lit("priority")).alias("priority"), "started_at")


@query("tag_lineage")
def q_tag_lineage(spark, sf_dir):
    fp = RL.panel_fingerprint(panel_table(spark, sf_dir))
    t = RL.tag_lineage(run_log(spark, sf_dir), fp)
    return t.select("run_id", *[F.element_at("tags", F.lit(k)).alias(k) for k in fp],
                    F.element_at("tags", F.lit("priority")).alias("priority"))


@query("incumbent")
def q_incumbent(spark, sf_dir):
    return RL.incumbent_of(model_versions(spark, sf_dir), run_log(spark, sf_dir))


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    runs = run_log(spark, sf_dir)
    inc = RL.incumbent_of(model_versions(spark, sf_dir), runs)
    return RL.quality_gate(RL.latest_runs(runs), inc)


@query("best_candidate")
def q_best_candidate(spark, sf_dir):
    return RL.best_candidate(run_log(spark, sf_dir))


@query("model_age")
def q_model_age(spark, sf_dir):
    a = RL.model_age(model_versions(spark, sf_dir), STALENESS_NOW)
    return a.select("model_name", "version", "created_at", r6(F.col("age_days")).alias("age_days"))


@query("staleness_status")
def q_staleness_status(spark, sf_dir):
    s = RL.staleness_status(run_log(spark, sf_dir), model_versions(spark, sf_dir), STALENESS_NOW)
    return s.withColumns({"age_days": r6(F.col("age_days")), "days_left": r6(F.col("days_left"))})


# ---------------------------------------------------------------- 2.13 monitoring (batch form)


@query("prediction_log")
def q_prediction_log(spark, sf_dir):
    return prediction_log(spark, sf_dir)


@query("prediction_rate")
def q_prediction_rate(spark, sf_dir):
    return M.prediction_rate(prediction_log(spark, sf_dir)).withColumn("rate", r6(F.col("rate")))


@query("error_rate_by_reason")
def q_error_rate_by_reason(spark, sf_dir):
    return M.error_rate_by_reason(prediction_log(spark, sf_dir)).withColumn("rate", r6(F.col("rate")))


@query("request_rate_by_status")
def q_request_rate_by_status(spark, sf_dir):
    return M.request_rate_by_status(prediction_log(spark, sf_dir)).withColumn("rate", r6(F.col("rate")))


@query("http_error_ratio")
def q_http_error_ratio(spark, sf_dir):
    return M.http_error_ratio(prediction_log(spark, sf_dir)).withColumn("ratio", r6(F.col("ratio")))


@query("latency_quantiles")
def q_latency_quantiles(spark, sf_dir):
    d = M.latency_quantiles(prediction_log(spark, sf_dir))
    # latencies have 5 decimals, so interpolated quantiles are exact at 8
    return d.withColumns({"p50": F.round("p50", 8), "p95": F.round("p95", 8)})


@query("sales_histogram")
def q_sales_histogram(spark, sf_dir):
    return M.sales_histogram(prediction_log(spark, sf_dir)).drop("upper")


@query("histogram_quantiles")
def q_histogram_quantiles(spark, sf_dir):
    h = M.sales_histogram(prediction_log(spark, sf_dir))
    out = M.histogram_quantile(h, 0.5).unionByName(M.histogram_quantile(h, 0.95))
    return out.withColumn("value", r2(F.col("value")))


@query("no_traffic_alerts")
def q_no_traffic_alerts(spark, sf_dir):
    cond = M.no_traffic(prediction_log(spark, sf_dir), 15).withColumn("rule", F.lit("no_traffic"))
    return M.alert_episodes(M.alert_for(cond, 15 * 60))


@query("error_rate_alerts")
def q_error_rate_alerts(spark, sf_dir):
    """Errors/s over 5 min, all reasons together, above a limit, held 5 min (limit scaled to the log's volume)."""
    log = prediction_log(spark, sf_dir)
    per = (M.error_rate_by_reason(log, limit=0.002)
           .groupBy(F.col("window_end").alias("tick")).agg((F.sum("n") / F.lit(300.0) > F.lit(0.002)).alias("alert")))
    cond = (M.minute_ticks(log).join(per, "tick", "left")
            .select(F.lit("error_rate").alias("rule"), "tick",
                    F.coalesce("alert", F.lit(False)).alias("condition")))
    return M.alert_episodes(M.alert_for(cond, 5 * 60))


@query("http_error_alerts")
def q_http_error_alerts(spark, sf_dir):
    """Share of 5xx answers over 5 min above 5 %, held 5 min."""
    log = prediction_log(spark, sf_dir)
    per = M.http_error_ratio(log).select(F.col("window_end").alias("tick"), "alert")
    cond = (M.minute_ticks(log).join(per, "tick", "left")
            .select(F.lit("http_errors").alias("rule"), "tick", F.coalesce("alert", F.lit(False)).alias("condition")))
    return M.alert_episodes(M.alert_for(cond, 5 * 60))


@query("latency_alerts")
def q_latency_alerts(spark, sf_dir):
    """p95 latency of served requests over 5 min above a limit, held 5 min (limit scaled to the log's latencies)."""
    log = prediction_log(spark, sf_dir)
    per = M.latency_quantiles(log, limit=0.05).select(F.col("window_end").alias("tick"), "alert")
    cond = (M.minute_ticks(log).join(per, "tick", "left")
            .select(F.lit("latency_p95").alias("rule"), "tick", F.coalesce("alert", F.lit(False)).alias("condition")))
    return M.alert_episodes(M.alert_for(cond, 5 * 60))


@query("http_latency_quantiles")
def q_http_latency_quantiles(spark, sf_dir):
    """p50/p95 latency of all requests, failed ones too."""
    d = M.latency_quantiles(prediction_log(spark, sf_dir), served_only=False)
    return d.withColumns({"p50": F.round("p50", 8), "p95": F.round("p95", 8)}).drop("alert")


@query("model_not_loaded_alerts")
def q_model_not_loaded_alerts(spark, sf_dir):
    """Models with runs but no serving version for 2 minutes."""
    return M.not_loaded_alerts(run_log(spark, sf_dir), model_versions(spark, sf_dir), STALENESS_NOW)


@query("scrape_up")
def q_scrape_up(spark, sf_dir):
    hb = prediction_log(spark, sf_dir).select((F.col("http_status").cast("string")).alias("target"), "ts")
    s = M.scrape_up(hb, "target", lookback_minutes=30)
    return s.groupBy("rule").agg(F.count_if(~F.col("up")).alias("n_down_ticks"),
                                 F.count_if("firing").alias("n_firing_ticks"),
                                 F.min(F.when(F.col("firing"), F.col("tick"))).alias("first_firing"))


@query("staleness_alerts")
def q_staleness_alerts(spark, sf_dir):
    return M.staleness_alerts(model_versions(spark, sf_dir), STALENESS_NOW)


@query("model_status")
def q_model_status(spark, sf_dir):
    """Loaded flag, serving version and age per model name (M9)."""
    runs = run_log(spark, sf_dir)
    ages = RL.model_age(model_versions(spark, sf_dir), STALENESS_NOW)
    j = runs.select("model_name").distinct().join(ages, "model_name", "left")
    return j.select("model_name", F.col("version").isNotNull().alias("model_loaded"), "version",
                    r6(F.col("age_days")).alias("age_days"))


@query("stream_counters_batch")
def q_stream_counters_batch(spark, sf_dir):
    served, errors = M.stream_counters(prediction_log(spark, sf_dir))
    return served.select(F.lit("predictions").alias("counter"), F.col("store_nbr").cast("string").alias("label"),
                         F.col("predictions_total").alias("total")).unionByName(
        errors.select(F.lit("errors").alias("counter"), F.col("reason").alias("label"),
                      F.col("errors_total").alias("total")))


# ---------------------------------------------------------------- 2.9 / 2.10 model and attribution (no SQL twin)

_TRAINED: dict = {}


def trained(spark, sf_dir):
    """(folder, result) of the full training job over ``sf_dir``: the search over all candidates, the holdout
    model and, if the gate passes, the release. One job serves every query on models of a session."""
    key = (spark.sparkContext.applicationId, input_state(spark, sf_dir, "lineitem", "supplier"))
    if key not in _TRAINED:
        d = sf_dir.rstrip("/")
        sums = file_fingerprint(spark, f"{d}/lineitem.parquet").unionByName(file_fingerprint(spark, f"{d}/supplier.parquet"))
        both = sums.agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("sha256"))), 256)).first()[0]
        out = scratch_path(spark, "training")
        _TRAINED[key] = out, run_training(spark, panel_table(spark, sf_dir), out, lineage={"raw_data_sha256": both})
    return _TRAINED[key]


def holdout_model(spark, sf_dir):
    """The search's best candidate, fitted on the training pool."""
    return trained(spark, sf_dir)[1].judged


@query("gbt_holdout_eval")
def q_gbt_holdout_eval(spark, sf_dir):
    _, test = holdout_test(spark, sf_dir)
    scored = score_in_sales_space(holdout_model(spark, sf_dir), test)
    return rounded_metrics(evaluate_all(scored)).withColumn("model", F.lit("gbt")).unionByName(
        rounded_metrics(naive_baseline(test)).withColumn("model", F.lit("persistence")))


@query("gbt_cv_search")
def q_gbt_cv_search(spark, sf_dir):
    """Scores of every candidate on every fold, with its parameters."""
    result = trained(spark, sf_dir)[1]
    points = spark.createDataFrame([(i, *p.values(), p == result.best) for i, p in enumerate(result.points)],
                                   ", ".join(["candidate int", "num_leaves int", "learning_rate double", "n_estimators int",
                                              "min_child_samples int", "is_best boolean"]))
    return result.scores.join(points, "candidate")


@query("store_levels")
def q_store_levels(spark, sf_dir):
    """Level of each store before each week, from earlier weeks only."""
    return with_earlier_level(features(spark, sf_dir)).select("store_nbr", "date", r6(F.col("store_level")).alias("store_level"))


@query("store_levels_final")
def q_store_levels_final(spark, sf_dir):
    return store_levels(features(spark, sf_dir)).select("store_nbr", r6(F.col("store_level")).alias("store_level"))


@query("gbt_batch_predict")
def q_gbt_batch_predict(spark, sf_dir):
    return S.batch_predict(scoring_requests(spark, sf_dir), snapshot_of(spark, sf_dir), batch_col="batch_id",
                           model=holdout_model(spark, sf_dir), model_name="tillpanel-gbt")


@query("gain_importance")
def q_gain_importance(spark, sf_dir):
    return gain_importance(holdout_model(spark, sf_dir))


@query("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    _, test = holdout_test(spark, sf_dir)
    return A.permutation_importance(holdout_model(spark, sf_dir), test, n_repeats=8, seed=42)


@query("global_attribution")
def q_global_attribution(spark, sf_dir):
    return A.global_attribution(holdout_model(spark, sf_dir), features(spark, sf_dir))


@query("attribution_check")
def q_attribution_check(spark, sf_dir):
    """Per row of the holdout: Σ attributions − (f(x) − base value) ≈ 0."""
    _, test = holdout_test(spark, sf_dir)
    attr = A.attributions(holdout_model(spark, sf_dir), test)
    return attr.groupBy("row_id").agg(
        F.sum("attribution").alias("sum_attr"), F.first("f_x").alias("f_x"),
        F.first("base_value").alias("base_value")).withColumn(
        "gap", F.abs(F.col("sum_attr") - (F.col("f_x") - F.col("base_value"))))


@query("local_explanation")
def q_local_explanation(spark, sf_dir):
    _, test = holdout_test(spark, sf_dir)
    model = holdout_model(spark, sf_dir)
    per_store = evaluate_all(score_in_sales_space(model, test), by=["store_nbr"])
    return A.local_explanation(model, G.worst_segment_row(test, per_store))


# ---------------------------------------------------------------- 2.13 monitoring (Structured Streaming form)


def _events_stream(spark, sf_dir):
    return ST.prediction_log_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def _drain(df, mode="complete"):
    return ST.run_to_table(df, scratch_path(df.sparkSession, f"stream-{_uuid.uuid4().hex[:8]}"), mode=mode)


def _to_end(spark, sf_dir, name, monitor):
    """All windows of the log, through an append-mode stream with watermark and deduplication."""
    return ST.run_to_end(_events_stream(spark, sf_dir), prediction_log(spark, sf_dir), monitor,
                         scratch_path(spark, f"stream-{name}"))


@query("stream_prediction_rate")
def q_stream_prediction_rate(spark, sf_dir):
    return _to_end(spark, sf_dir, "rate", M.prediction_rate).withColumn("rate", r6(F.col("rate")))


@query("stream_error_rate_by_reason")
def q_stream_error_rate_by_reason(spark, sf_dir):
    return _to_end(spark, sf_dir, "errors", M.error_rate_by_reason).withColumn("rate", r6(F.col("rate")))


@query("stream_request_rate_by_status")
def q_stream_request_rate_by_status(spark, sf_dir):
    return _to_end(spark, sf_dir, "requests", M.request_rate_by_status).withColumn("rate", r6(F.col("rate")))


@query("stream_http_error_ratio")
def q_stream_http_error_ratio(spark, sf_dir):
    return _to_end(spark, sf_dir, "5xx", M.http_error_ratio).withColumn("ratio", r6(F.col("ratio")))


@query("stream_latency_quantiles")
def q_stream_latency_quantiles(spark, sf_dir):
    """Rank sketches per minute, merged into sliding windows."""
    out = _to_end(spark, sf_dir, "latency", M.latency_quantiles)
    return out.withColumns({q: F.round(q, 8) for q in ("p50", "p95")})


@query("stream_counters")
def q_stream_counters(spark, sf_dir):
    served, errors = M.stream_counters(_events_stream(spark, sf_dir))
    a = _drain(served).select(F.lit("predictions").alias("counter"), F.col("store_nbr").cast("string").alias("label"),
                              F.col("predictions_total").alias("total"))
    b = _drain(errors).select(F.lit("errors").alias("counter"), F.col("reason").alias("label"),
                              F.col("errors_total").alias("total"))
    return a.unionByName(b)


@query("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    """Orders streamed as scoring requests; served + unknown rows and
    rejected rows land in two parquet sinks (read back and unioned)."""
    o = spark.readStream.schema(read_orders_schema(spark, sf_dir)).option(
        "basePath", sf_dir.rstrip("/")).parquet(f"{sf_dir.rstrip('/')}/orders.parque[t]")
    reqs = requests_from_orders(o)
    base = scratch_path(spark, "stream-scoring")
    q = ST.stream_scoring(reqs, snapshot_of(spark, sf_dir), f"{base}/ok", f"{base}/rejected", f"{base}/ckpt",
                          cents=False)
    q.awaitTermination()
    ok = spark.read.parquet(f"{base}/ok")
    bad = spark.read.parquet(f"{base}/rejected")
    out = ok.unionByName(bad).drop("batch")
    return out.withColumn("predicted_sales", F.round("predicted_sales", 4))


@query("stream_no_traffic_alerts")
def q_stream_no_traffic_alerts(spark, sf_dir):
    """Events and one heartbeat a minute streamed into 15-minute windows; closed windows stream on through the
    stateful alert machine."""
    log = prediction_log(spark, sf_dir)
    ticks = M.minute_ticks(log)
    base = scratch_path(spark, "no-traffic")
    ticks.select((F.col("tick") - F.expr("INTERVAL 30 SECONDS")).alias("ts")).write.parquet(f"{base}/beats")
    beats = spark.readStream.schema(ST.HEARTBEAT_SCHEMA).parquet(f"{base}/beats")
    ST.run_to_end(ST.with_heartbeats(_events_stream(spark, sf_dir), beats), log,
                  lambda s: ST.no_traffic_stream(s, watermark=None), f"{base}/windows")
    closed = spark.readStream.schema(ST.WINDOW_SCHEMA).parquet(f"{base}/windows/rows")
    conditions = closed.select(F.lit("no_traffic").alias("rule"), F.col("window_end").alias("tick"), "condition")
    per_tick = _drain(ST.alert_for_stream(conditions, 15 * 60), mode="append")
    return M.alert_episodes(per_tick.join(ticks, "tick", "left_semi"))


def read_orders_schema(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").schema


# ---------------------------------------------------------------- sources, reports, job runs


@query("file_fingerprint")
def q_file_fingerprint(spark, sf_dir):
    """SHA-256 and length of the raw lineitem and supplier files."""
    d = sf_dir.rstrip("/")
    return file_fingerprint(spark, f"{d}/lineitem.parquet").unionByName(
        file_fingerprint(spark, f"{d}/supplier.parquet"))


@query("snapshot_roundtrip")
def q_snapshot_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    write_snapshot(snapshot_of(spark, sf_dir), path)
    return round_std(read_snapshot(spark, path))


@query("densify_panel")
def q_densify_panel(spark, sf_dir):
    """Store × week grid over the panel's span; missing weeks keep null sales."""
    return densify_panel(panel_table(spark, sf_dir))


@query("sample_rows")
def q_sample_rows(spark, sf_dir):
    return A.sample_rows(panel_table(spark, sf_dir), 500, 42)


@query("segment_summary_json")
def q_segment_summary_json(spark, sf_dir):
    pool, test = naive_holdout_frames(spark, sf_dir)
    return segment_summary_json(G.fairness_report(test, pool), test)


@query("report_tables")
def q_report_tables(spark, sf_dir):
    """The report artifacts that the training job wrote on promotion: one row per artifact with its row count."""
    rows = []
    for name, p in trained(spark, sf_dir)[1].reports.items():
        reader = spark.read.text if name in ("fairness_summary", "local_example") else \
            (lambda x: spark.read.option("header", True).csv(x))
        rows.append((name, reader(p).count()))
    return spark.createDataFrame(rows, "artifact string, n_rows long")


@query("training_run")
def q_training_run(spark, sf_dir):
    """The whole training job (validate → features → search over all candidates → holdout → gate → refit and
    register → snapshot and reports); returns the runs it logged."""
    out, _ = trained(spark, sf_dir)
    runs = RL.read_runs(spark, f"{out}/runs")
    return runs.select("run_name", "model_type", F.element_at("tags", F.lit("quality_gate")).alias("quality_gate"),
                       F.element_at("tags", F.lit("raw_data_sha256")).alias("raw_data_sha256"),
                       *[r6(F.element_at("metrics", F.lit(k))).alias(k) for k in ("test_rmsle", "cv_mean_rmsle")],
                       *[r6(F.element_at("metrics", F.lit(f"fairness_disparity_ratio_{d}"))).alias(f"disparity_{d}")
                         for d in G.DEFAULT_SEGMENT_COLUMNS])


@query("snapshot_advanced")
def q_snapshot_advanced(spark, sf_dir):
    return round_std(advanced_snapshot(panel_table(spark, sf_dir)))


@query("fairness_report_gbt")
def q_fairness_report_gbt(spark, sf_dir):
    """Segment report of the holdout model's own predictions (J2 as run after training)."""
    pool, test = holdout_test(spark, sf_dir)
    scored = score_in_sales_space(holdout_model(spark, sf_dir), test)
    return rounded_report(G.fairness_report(scored, pool))


@query("table_fingerprint")
def q_table_fingerprint(spark, sf_dir):
    """Order-free content hash of lineitem and events (layout-independent)."""
    return table_fingerprint(read_table(spark, sf_dir, "lineitem")).select(
        F.lit("lineitem").alias("table"), "*").unionByName(
        table_fingerprint(read_table(spark, sf_dir, "events")).select(F.lit("events").alias("table"), "*"))


@query("windowed_sales_quantiles")
def q_windowed_sales_quantiles(spark, sf_dir):
    """Median predicted sales per 5-minute window from the bucket counts (dashboard form of M7)."""
    h = M.windowed_sales_histogram(prediction_log(spark, sf_dir))
    return M.histogram_quantile_by(h, 0.5).withColumn("value", r2(F.col("value")))


@query("run_disparity_metrics")
def q_run_disparity_metrics(spark, sf_dir):
    """Disparity ratios of the holdout report merged into every run's metrics (J3)."""
    pool, test = naive_holdout_frames(spark, sf_dir)
    summary = G.disparity_summary(G.segment_report(G.add_segments(test, pool)))
    runs = G.log_disparity(run_log(spark, sf_dir), summary)
    keys = [f"fairness_disparity_ratio_{d}" for d in G.DEFAULT_SEGMENT_COLUMNS]
    return runs.select("run_id", r6(F.element_at("metrics", F.lit("test_rmsle"))).alias("test_rmsle"),
                       *[r6(F.element_at("metrics", F.lit(k))).alias(k) for k in keys])
