"""Service monitoring as aggregates over the prediction log.

Log schema: ``ts TIMESTAMP, store_nbr INT, http_status INT, reason STRING?,
latency_s DOUBLE, predicted_sales DOUBLE?``. Rates are exact counts divided
by the window length in seconds. Functions accept a batch or a streaming
DataFrame; pass ``watermark`` for streaming append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Histogram bounds of predicted weekly sales (USD) and alert thresholds.
SALES_BUCKETS = [0, 100_000, 250_000, 500_000, 750_000, 1_000_000, 1_250_000,
                 1_500_000, 1_750_000, 2_000_000, 2_500_000, 3_000_000]
ERROR_RATE_LIMIT = 0.5      # errors per second over 5 minutes
HTTP_5XX_LIMIT = 0.05       # share of 5xx over 5 minutes
LATENCY_P95_LIMIT = 0.5     # seconds


def _wm(log: DataFrame, watermark: str | None) -> DataFrame:
    return log.withWatermark("ts", watermark) if watermark else log


def _win(size: str, slide: str | None = None):
    return F.window("ts", size, slide) if slide else F.window("ts", size)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                     *[c for c in df.columns if c != "window"])


def _seconds(size: str) -> float:
    n, unit = size.split()
    return float(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _sliding(log: DataFrame, size: str, slide: str, keys: list[str], counts: dict) -> DataFrame:
    """``window_start, window_end``, ``keys`` and the ``counts`` (name → count aggregate) of every window.

    In batch, rows are counted once per slide; the small counts are then added
    up over the windows that cover them. A stream counts in its windows.
    """
    if log.isStreaming:
        return _flat(log.groupBy(_win(size, slide), *keys).agg(*[c.alias(n) for n, c in counts.items()]))
    step, covered = _seconds(slide), _seconds(size) / _seconds(slide)
    if covered != int(covered):
        raise ValueError("a window must hold a whole number of slides")
    per = log.groupBy(_win(slide), *keys).agg(*[c.alias(n) for n, c in counts.items()])
    back = F.explode(F.sequence(F.lit(0), F.lit(int(covered) - 1))).alias("_back")
    spread = per.select(F.col("window.start").alias("_at"), back, *keys, *counts)
    start = F.col("_at") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("_back") * F.lit(step))
    end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(_seconds(size)))
    return (spread.withColumn("window_start", start).groupBy("window_start", *keys)
            .agg(*[F.sum(n).alias(n) for n in counts])
            .select("window_start", end.alias("window_end"), *keys, *counts))


def prediction_rate(log: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                    watermark: str | None = None) -> DataFrame:
    """Served predictions per second by store over sliding windows."""
    served = _wm(log, watermark).filter(F.col("http_status") == 200)
    g = _sliding(served, size, slide, ["store_nbr"], {"n": F.count(F.lit(1))})
    return g.withColumn("rate", F.col("n") / F.lit(_seconds(size)))


def error_rate_by_reason(log: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                         limit: float = ERROR_RATE_LIMIT, watermark: str | None = None) -> DataFrame:
    """Prediction errors per second by reason; ``alert`` when above ``limit``."""
    err = _wm(log, watermark).filter(F.col("reason").isNotNull())
    g = _sliding(err, size, slide, ["reason"], {"n": F.count(F.lit(1))})
    rate = F.col("n") / F.lit(_seconds(size))
    return g.withColumn("rate", rate).withColumn("alert", rate > F.lit(limit))


def request_rate_by_status(log: DataFrame, size: str = "1 minute", watermark: str | None = None) -> DataFrame:
    g = _wm(log, watermark).groupBy(_win(size), "http_status").agg(F.count(F.lit(1)).alias("n"))
    return _flat(g).withColumn("rate", F.col("n") / F.lit(_seconds(size)))


def http_error_ratio(log: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                     limit: float = HTTP_5XX_LIMIT, watermark: str | None = None) -> DataFrame:
    g = _sliding(_wm(log, watermark), size, slide, [], {"n_5xx": F.count_if(F.col("http_status") >= 500),
                                                        "n": F.count(F.lit(1))})
    ratio = F.col("n_5xx") / F.col("n")
    return g.withColumn("ratio", ratio).withColumn("alert", ratio > F.lit(limit))


#: sketch size of latency quantiles: exact up to this many values of a window, then a rank error of about 0.2 %
SKETCH_K = 2048


def latency_quantiles(log: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                      limit: float = LATENCY_P95_LIMIT, method: str | None = None,
                      watermark: str | None = None, served_only: bool = True) -> DataFrame:
    """p50/p95 latency per window, of served requests or of all.

    ``method``: ``exact`` (batch default) — equal latencies are counted per
    slide, and each window's exact, interpolated ``percentile`` runs over
    those counts; ``sketch`` (stream default) — one KLL sketch per slide,
    merged into the windows that cover it, so rows are read once and state
    is bounded by ``SKETCH_K`` per open slide and window whatever the rate.
    A sketch gives the value whose rank reaches the quantile. Null and NaN
    latencies count in ``n`` and in no quantile.
    """
    method = method or ("sketch" if log.isStreaming else "exact")
    served = _wm(log, watermark)
    if served_only:
        served = served.filter(F.col("http_status") == 200)
    if method == "exact":
        counts = _sliding(served, size, slide, ["latency_s"], {"n": F.count(F.lit(1))})
        g = counts.groupBy("window_start", "window_end").agg(
            F.sum("n").alias("n"), F.percentile("latency_s", [0.5, 0.95], F.col("n")).alias("_q"))
        p50, p95 = F.col("_q")[0], F.col("_q")[1]
    elif method == "sketch":
        value = F.when(~F.isnan("latency_s"), F.col("latency_s"))
        per = served.groupBy(_win(slide)).agg(F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias("_s"),
                                              F.count(F.lit(1)).alias("n"))
        merged = per.groupBy(F.window(F.window_time("window"), size, slide)).agg(
            F.kll_merge_agg_double("_s", F.lit(SKETCH_K)).alias("_s"), F.sum("n").alias("n"))
        g = _flat(merged)
        known = F.kll_sketch_get_n_double("_s") > 0
        p50, p95 = (F.when(known, F.kll_sketch_get_quantile_double("_s", F.lit(q))) for q in (0.5, 0.95))
    else:
        raise ValueError(f"unknown method {method!r}")
    return g.select("window_start", "window_end", "n", p50.alias("p50"), p95.alias("p95"), (p95 > F.lit(limit)).alias("alert"))


def sales_histogram(log: DataFrame, bounds=SALES_BUCKETS) -> DataFrame:
    """Cumulative counts of served predicted sales per bound, plus +Inf.

    One aggregation with a conditional count per bound, then unpivoted.
    """
    v = F.col("predicted_sales")
    served = log.filter(v.isNotNull())
    aggs = [F.count_if(v <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(F.lit(1)).alias(f"le_{len(bounds)}"))
    one = served.agg(*aggs)
    labels = [str(b) for b in bounds] + ["+Inf"]
    uppers = [float(b) for b in bounds] + [float("inf")]
    rows = F.array(*[F.struct(F.lit(i).alias("bucket"), F.lit(labels[i]).alias("le"),
                              F.lit(uppers[i]).alias("upper"), F.col(f"le_{i}").alias("cum_count"))
                     for i in range(len(labels))])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def windowed_sales_histogram(log: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                             bounds=SALES_BUCKETS, watermark: str | None = None) -> DataFrame:
    """Cumulative bucket counts per sliding window (the rate-window form of
    the histogram), long format ``window_start, window_end, bucket, le,
    upper, cum_count``."""
    v = F.col("predicted_sales")
    served = _wm(log, watermark).filter(v.isNotNull())
    aggs = {f"le_{i}": F.count_if(v <= F.lit(float(b))) for i, b in enumerate(bounds)}
    aggs[f"le_{len(bounds)}"] = F.count(F.lit(1))
    g = _sliding(served, size, slide, [], aggs)
    labels = [str(b) for b in bounds] + ["+Inf"]
    uppers = [float(b) for b in bounds] + [float("inf")]
    rows = F.array(*[F.struct(F.lit(i).alias("bucket"), F.lit(labels[i]).alias("le"),
                              F.lit(uppers[i]).alias("upper"), F.col(f"le_{i}").alias("cum_count"))
                     for i in range(len(labels))])
    return g.select("window_start", "window_end", F.explode(rows).alias("r")).select(
        "window_start", "window_end", "r.*")


def histogram_quantile_by(hist: DataFrame, q: float, keys=("window_start", "window_end")) -> DataFrame:
    """``histogram_quantile`` per key (e.g. per window): the same bucket
    interpolation, with windows partitioned by key over the 13 bucket rows
    of each key."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("bucket")
    wk = Window.partitionBy(*keys)
    h = hist.select(*keys, "bucket", "upper", "cum_count",
                    F.lag("upper").over(w).alias("prev_upper"), F.lag("cum_count").over(w).alias("prev_cum"),
                    (F.lit(q) * F.max("cum_count").over(wk)).alias("rank"),
                    F.max("bucket").over(wk).alias("last_bucket"))
    start = F.coalesce(F.col("prev_upper"), F.lit(0.0))
    prev = F.coalesce(F.col("prev_cum"), F.lit(0))
    value = (F.when(F.col("bucket") == F.col("last_bucket"), F.col("prev_upper"))
             .when((F.col("bucket") == 0) & (F.col("upper") <= 0), F.col("upper"))
             .otherwise(start + (F.col("upper") - start)
                        * ((F.col("rank") - prev) / (F.col("cum_count") - prev))))
    hit = h.filter(F.col("cum_count") >= F.col("rank"))
    first = hit.groupBy(*keys).agg(F.min_by(F.struct(value.alias("v")), F.col("bucket")).alias("_f"))
    return first.select(*keys, F.lit(q).alias("q"), F.col("_f.v").alias("value"))


def histogram_quantile(hist: DataFrame, q: float) -> DataFrame:
    """Quantile estimate from cumulative buckets, interpolating linearly
    inside the bucket where the cumulative count first reaches q·total
    (the +Inf bucket returns the last finite bound). Runs on the tiny
    bucket table (one row per bound)."""
    w = Window.orderBy("bucket")
    total = F.max("cum_count").over(Window.partitionBy())
    h = hist.select("bucket", "upper", "cum_count",
                    F.lag("upper").over(w).alias("prev_upper"),
                    F.lag("cum_count").over(w).alias("prev_cum"),
                    (F.lit(q) * total).alias("rank"),
                    F.max("bucket").over(Window.partitionBy()).alias("last_bucket"))
    hit = h.filter(F.col("cum_count") >= F.col("rank")).orderBy("bucket").limit(1)
    start = F.coalesce(F.col("prev_upper"), F.lit(0.0))
    prev = F.coalesce(F.col("prev_cum"), F.lit(0))
    value = (F.when(F.col("bucket") == F.col("last_bucket"), F.col("prev_upper"))
             .when((F.col("bucket") == 0) & (F.col("upper") <= 0), F.col("upper"))
             .otherwise(start + (F.col("upper") - start)
                        * ((F.col("rank") - prev) / (F.col("cum_count") - prev))))
    return hit.select(F.lit(q).alias("q"), value.alias("value"))


def minute_ticks(log: DataFrame, step_minutes: int = 1) -> DataFrame:
    """Evaluation ticks (minute ends) covering the log, built with
    ``spark.range`` (distributed) from two scalars."""
    b = log.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if b["lo"] is None:
        return log.sparkSession.range(0).select(F.lit(None).cast("timestamp").alias("tick"))
    lo = F.date_trunc("minute", F.lit(b["lo"]))
    n = int((b["hi"] - b["lo"]).total_seconds() // (60 * step_minutes)) + 2
    return log.sparkSession.range(1, n + 1).select(
        (lo + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") * step_minutes)).alias("tick"))


def traffic_per_tick(log: DataFrame, lookback_minutes: int = 15, status: int = 200) -> DataFrame:
    """Served predictions in (tick − lookback, tick] for every minute tick.

    Per-minute counts are spread to the ``lookback`` ticks they cover and
    summed (no global window); ticks with no traffic come from the spine.
    """
    minute = (log.filter(F.col("http_status") == status)
              .groupBy((F.date_trunc("minute", "ts") + F.expr("INTERVAL 1 MINUTE")).alias("m_end"))
              .agg(F.count(F.lit(1)).alias("n")))
    spread = minute.select(
        F.explode(F.sequence(F.lit(0), F.lit(lookback_minutes - 1))).alias("k"), "m_end", "n"
    ).select((F.col("m_end") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k"))).alias("tick"), "n")
    per_tick = spread.groupBy("tick").agg(F.sum("n").alias("n_window"))
    ticks = minute_ticks(log)
    return ticks.join(per_tick, "tick", "left").select(
        "tick", F.coalesce("n_window", F.lit(0)).cast("long").alias("n_window"))


def no_traffic(log: DataFrame, lookback_minutes: int = 15) -> DataFrame:
    t = traffic_per_tick(log, lookback_minutes)
    return t.withColumn("condition", F.col("n_window") == 0)


def alert_for(conditions: DataFrame, hold_seconds: float, key_cols=("rule",),
              time_col: str = "tick", cond_col: str = "condition") -> DataFrame:
    """Fire once a condition has held on every evaluation since ``hold``.

    Gaps and islands: consecutive true ticks share ``tick_index − row_number``;
    the island's first tick is when the alert became pending; it fires at
    ticks at least ``hold_seconds`` later. Windows are partitioned by rule
    key (tick tables are one row per evaluation, bounded by the time span).
    """
    keys = list(key_cols)
    w_all = Window.partitionBy(*keys).orderBy(time_col)
    c = conditions.withColumn("_i", F.row_number().over(w_all))
    w_true = Window.partitionBy(*keys, cond_col).orderBy(time_col)
    c = c.withColumn("_grp", F.col("_i") - F.row_number().over(w_true))
    start = F.min(time_col).over(Window.partitionBy(*keys, cond_col, "_grp"))
    c = c.withColumn("pending_since", F.when(F.col(cond_col), start))
    held = F.unix_micros(F.col(time_col)) - F.unix_micros(F.col("pending_since"))
    return c.withColumn("firing", F.coalesce(F.col(cond_col) & (held >= F.lit(int(hold_seconds * 1e6))),
                                             F.lit(False))).drop("_i", "_grp")


def alert_episodes(per_tick: DataFrame, key_cols=("rule",), time_col: str = "tick") -> DataFrame:
    """One row per firing episode: pending since, first firing tick, last tick."""
    keys = list(key_cols)
    return (per_tick.filter(F.col("pending_since").isNotNull())
            .groupBy(*keys, "pending_since")
            .agg(F.min(F.when(F.col("firing"), F.col(time_col))).alias("fired_at"),
                 F.max(time_col).alias("last_tick"))
            .filter(F.col("fired_at").isNotNull()))


def scrape_up(heartbeats: DataFrame, target_col: str = "target", lookback_minutes: int = 1,
              hold_seconds: float = 60.0) -> DataFrame:
    """Per target and minute tick: ``up`` iff a heartbeat arrived in the last
    ``lookback`` minutes; ``firing`` once down for ``hold_seconds``.

    Ticks run from a target's first heartbeat to the last heartbeat of any
    target, so a target that dies is down until the end of the log.
    """
    hb = heartbeats.select(F.col(target_col).alias("rule"), "ts")
    m_end = F.date_trunc("minute", "ts") + F.expr("INTERVAL 1 MINUTE")
    minute = hb.groupBy("rule", m_end.alias("m_end")).agg(F.count(F.lit(1)).alias("n"))
    spread = minute.select("rule", F.explode(F.sequence(F.lit(0), F.lit(lookback_minutes - 1))).alias("k"),
                           "m_end", "n").select(
        "rule", (F.col("m_end") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k"))).alias("tick"), "n")
    seen = spread.groupBy("rule", "tick").agg(F.sum("n").alias("n"))
    bounds = minute.groupBy("rule").agg(F.min("m_end").alias("lo")).crossJoin(
        F.broadcast(minute.agg(F.max("m_end").alias("hi"))))  # one row
    ticks = bounds.select("rule", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MINUTE"))).alias("tick"))
    grid = ticks.join(seen, ["rule", "tick"], "left").select(
        "rule", "tick", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    cond = grid.withColumn("condition", F.col("n") == 0)
    return alert_for(cond, hold_seconds).withColumn("up", ~F.col("condition"))


def staleness_alerts(versions: DataFrame, now, max_age_days: int = 7, lead_days: int = 2,
                     alias: str = "production") -> DataFrame:
    """Firing episodes per model: ``approaching`` (max − lead ≤ age < max, held
    10 min) and ``stale`` (age ≥ max, held 24 h), over the whole history.

    The age grows steadily between alias moves, so each move starts at most one
    episode per rule and its times follow by arithmetic: pending when the age
    reaches the threshold, over at the next move, at ``now``, or (approaching)
    when the age reaches the maximum.
    """
    end = F.lit(now).cast("timestamp")
    moves = versions.filter((F.col("alias") == alias) & (F.col("created_at") <= end)).select("model_name", "created_at").distinct()
    after = F.lead("created_at").over(Window.partitionBy("model_name").orderBy("created_at"))
    spans = moves.withColumn("next_move", after)
    days = lambda n: F.make_dt_interval(F.lit(n))
    rules = [("approaching", days(max_age_days - lead_days), F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10)), days(max_age_days)),
             ("stale", days(max_age_days), F.make_dt_interval(F.lit(0), F.lit(24)), None)]
    episodes = [F.struct(F.lit(name).alias("rule"), (F.col("created_at") + begin).alias("pending_since"),
                         (F.col("created_at") + begin + hold).alias("fired_at"),
                         F.least(end, "next_move", *([F.col("created_at") + past] if past is not None else [])).alias("until"))
                for name, begin, hold, past in rules]
    return (spans.select("model_name", "next_move", F.explode(F.array(*episodes)).alias("e")).select("model_name", "next_move", "e.*")
            .filter((F.col("fired_at") <= end) & (F.col("next_move").isNull() | (F.col("fired_at") < F.col("next_move"))))
            .drop("next_move"))


def not_loaded_alerts(runs: DataFrame, versions: DataFrame, now, hold_minutes: int = 2,
                      alias: str = "production") -> DataFrame:
    """Episodes in which a model that has runs serves no version for longer than the hold.

    A model is pending from its first run until its first alias move (or
    ``now``), so both times follow from one row per model.
    """
    end = F.lit(now).cast("timestamp")
    wanted = (runs.filter(F.col("started_at") <= end).groupBy("model_name").agg(F.min("started_at").alias("pending_since")))
    loaded = (versions.filter((F.col("alias") == alias) & (F.col("created_at") <= end))
              .groupBy("model_name").agg(F.min("created_at").alias("_loaded")))
    fired = F.col("pending_since") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(hold_minutes))
    return (wanted.join(loaded, "model_name", "left")
            .select(F.lit("model_not_loaded").alias("rule"), "model_name", "pending_since", fired.alias("fired_at"),
                    F.least(end, "_loaded").alias("until"))
            .filter(F.col("fired_at") <= F.col("until")))


def stream_counters(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Running totals: served predictions per store, errors per reason."""
    served = log.filter(F.col("http_status") == 200).groupBy("store_nbr").agg(
        F.count(F.lit(1)).alias("predictions_total"))
    errors = log.filter(F.col("reason").isNotNull()).groupBy("reason").agg(
        F.count(F.lit(1)).alias("errors_total"))
    return served, errors
