"""DuckDB SQL twins of the registered queries (the correctness oracle).

Tables ``lineitem supplier orders events …`` are views over the same
parquet files. Shared CTEs below mirror the library's derivations; every
computed column carries the same alias as the Spark result.
"""

from __future__ import annotations


# ---------------------------------------------------------------- calendar
def wef(d: str) -> str:
    """Friday closing the Saturday-to-Friday week of ``d`` (DuckDB)."""
    return f"(({d}) + CAST(6 - ((((isodow({d}) - 1) - 5) % 7) + 7) % 7 AS INTEGER))"


def nth_weekday(y: str, month: int, weekday: int, n: int) -> str:
    first = f"make_date({y}, {month}, 1)"
    return (f"({first} + CAST(((({weekday} - (isodow({first}) - 1)) % 7) + 7) % 7 "
            f"+ {7 * (n - 1)} AS INTEGER))")


def holiday(d: str) -> str:
    y = f"year({d})"
    anchors = [nth_weekday(y, 2, 6, 1), nth_weekday(y, 9, 0, 1), nth_weekday(y, 11, 3, 4),
               f"make_date({y}, 12, 25)"]
    ors = " OR ".join(f"{wef(d)} = {wef(a)}" for a in anchors)
    return f"(CASE WHEN ({d}) IS NULL THEN NULL WHEN {ors} THEN 1 ELSE 0 END)"


def clip0(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN GREATEST(CAST({x} AS DOUBLE), 0.0) END)"


def log1p(x: str) -> str:
    return f"LN(1 + {x})"


def metrics(y: str, p: str, r: bool = True) -> str:
    """n, n_missing, rmsle, mae, rmse (rounded 6 / 2 / 2 like the queries)."""
    ok = f"(({y}) IS NOT NULL AND ({p}) IS NOT NULL)"
    d = f"({log1p(clip0(p))} - {log1p(clip0(y))})"
    e = f"(CAST({y} AS DOUBLE) - CAST({p} AS DOUBLE))"
    rmsle = f"SQRT(AVG(CASE WHEN {ok} THEN {d} * {d} END))"
    mae = f"AVG(CASE WHEN {ok} THEN ABS({e}) END)"
    rmse = f"SQRT(AVG(CASE WHEN {ok} THEN {e} * {e} END))"
    if r:
        rmsle, mae, rmse = f"ROUND({rmsle}, 6)", f"ROUND({mae}, 2)", f"ROUND({rmse}, 2)"
    return (f"CAST(COUNT(CASE WHEN {ok} THEN 1 END) AS BIGINT) AS n, "
            f"CAST(COUNT(CASE WHEN NOT {ok} THEN 1 END) AS BIGINT) AS n_missing, "
            f"{rmsle} AS rmsle, {mae} AS mae, {rmse} AS rmse")


# ---------------------------------------------------------------- shared CTEs
PANEL_AGG = f"""
panel_agg AS (
  SELECT CAST(s.s_nationkey + 1 AS INTEGER) AS store_nbr,
         {wef('CAST(l.l_shipdate AS DATE)')} AS date,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l.l_discount AS DECIMAL(18,4)))) AS DOUBLE) AS sales,
         COUNT(*) AS _n,
         CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS _qty,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS _price,
         CAST(SUM(CAST(l.l_discount AS DECIMAL(18,4))) AS DOUBLE) AS _disc
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2
)"""

PANEL = PANEL_AGG + f""",
panel AS (
  SELECT store_nbr, date, sales, CAST({holiday('date')} AS INTEGER) AS holiday_flag,
         _qty / _n AS temperature, _price / _n / 1000.0 AS fuel_price,
         _price / _qty AS cpi, 100.0 * (_disc / _n) AS unemployment
  FROM panel_agg
)"""

FEAT = PANEL + f""",
feat AS (
  SELECT *,
    CAST(month(date) AS INTEGER) AS month,
    CAST(weekofyear(date) AS INTEGER) AS week_of_year,
    CAST(year(date) AS INTEGER) AS year,
    LAG(sales, 1) OVER w AS sales_lag_1,
    LAG(sales, 4) OVER w AS sales_lag_4,
    LAG(sales, 52) OVER w AS sales_lag_52,
    CAST(SUM(CAST(sales AS DECIMAL(38,8))) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / COUNT(sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS sales_roll_mean_4,
    CAST(SUM(CAST(sales AS DECIMAL(38,8))) OVER (w ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / COUNT(sales) OVER (w ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS sales_roll_mean_8,
    STDDEV_SAMP(sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS sales_roll_std_4,
    {log1p(clip0('sales'))} AS log_sales
  FROM panel
  WINDOW w AS (PARTITION BY store_nbr ORDER BY date)
)"""


def holdout(weeks: int = 8) -> str:
    """``cutoff`` (first holdout date), ``pool`` and ``test`` over ``feat``."""
    return FEAT + f""",
cutoff AS (
  SELECT date AS cutoff FROM (SELECT DISTINCT date FROM feat) ORDER BY date DESC LIMIT 1 OFFSET {weeks - 1}
),
pool AS (SELECT f.* FROM feat f, cutoff c WHERE f.date < c.cutoff),
test AS (SELECT f.* FROM feat f, cutoff c WHERE f.date >= c.cutoff)"""


ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


# ---------------------------------------------------------------- 2.1 sources
@oracle("panel")
def _():
    return f"WITH {PANEL} SELECT * FROM panel"


@oracle("features")
def _():
    return f"""WITH {FEAT}
SELECT store_nbr, date, sales, holiday_flag, month, week_of_year, year,
       sales_lag_1, sales_lag_4, sales_lag_52,
       sales_roll_mean_4, sales_roll_mean_8,
       ROUND(sales_roll_std_4, 2) AS sales_roll_std_4,
       ROUND(log_sales, 6) AS log_sales
FROM feat"""


@oracle("naive_baseline_holdout")
def _():
    return f"""WITH {holdout(8)}
SELECT (SELECT cutoff FROM cutoff) AS cutoff, {metrics('sales', 'sales_lag_1')}
FROM test WHERE sales_lag_1 IS NOT NULL"""


def exact_mean(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(38,8))) AS DOUBLE) / COUNT({x}))"


def exact_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,8))) AS DOUBLE)"


FEED = f"""
feed AS (
  SELECT CAST(s.s_nationkey AS INTEGER) AS store_nbr,
         {wef('CAST(l.l_shipdate AS DATE)')} AS date,
         l.l_extendedprice * (1.0::DOUBLE - l.l_discount) AS sales,
         CAST({holiday(wef('CAST(l.l_shipdate AS DATE)'))} AS INTEGER) AS holiday_flag,
         l.l_quantity AS temperature,
         l.l_extendedprice / 1000.0::DOUBLE AS fuel_price,
         l.l_tax * 100.0::DOUBLE AS cpi,
         l.l_discount * 100.0::DOUBLE AS unemployment
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

REQUIRED = ["date", "store_nbr", "sales", "holiday_flag", "temperature", "fuel_price", "cpi", "unemployment"]
RANGE_RULES = [
    ("sales", "error", "sales < 0"),
    ("holiday_flag", "error", "NOT COALESCE(holiday_flag IN (0, 1), false)"),
    ("unemployment", "error", "unemployment < 0"),
    ("fuel_price", "error", "fuel_price <= 0"),
    ("cpi", "error", "cpi <= 0"),
    ("store_nbr", "error", "store_nbr < 1"),
    ("temperature", "warning", "(temperature < -30 OR temperature > 130)"),
]


def validation_sql(src: str) -> str:
    aggs = [f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS null__{c}" for c in REQUIRED]
    aggs += [f"CAST(COUNT_IF({p}) AS BIGINT) AS range__{c}" for c, _, p in RANGE_RULES]
    rows = [f"SELECT 'error' AS severity, 'nulls' AS \"check\", '{c}' AS \"column\", null__{c} AS n_bad, "
            f"printf('nulls check on {c}: %d rows', null__{c}) AS message FROM one" for c in REQUIRED]
    rows += [f"SELECT '{sev}', 'range', '{c}', range__{c}, printf('range check on {c}: %d rows', range__{c}) FROM one"
             for c, sev, _ in RANGE_RULES]
    rows.append("SELECT 'error', 'duplicates', 'date,store_nbr', n_dupes, "
                "printf('duplicates check on date+store_nbr: %d rows', n_dupes) FROM dup")
    rows.append("SELECT 'warning', 'balance', 'date', CASE WHEN k > 1 THEN hi - lo ELSE 0 END, "
                "printf('balance check: stores have %d to %d weeks', lo, hi) "
                "FROM bal")
    union = "\n  UNION ALL ".join(rows)
    return f"""{src},
one AS (SELECT {', '.join(aggs)} FROM src),
per_key AS (SELECT store_nbr, date, COUNT(*) AS n FROM src GROUP BY store_nbr, date),
dup AS (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_dupes FROM per_key),
weeks AS (SELECT store_nbr, COUNT(date) AS weeks FROM per_key WHERE store_nbr IS NOT NULL GROUP BY store_nbr),
bal AS (SELECT CAST(MIN(weeks) AS BIGINT) AS lo, CAST(MAX(weeks) AS BIGINT) AS hi,
               COUNT(DISTINCT weeks) AS k FROM weeks),
rep AS (
  {union}
)
SELECT severity, "check", "column", CAST(n_bad AS BIGINT) AS n_bad, message FROM rep WHERE n_bad > 0"""


@oracle("panel_profile")
def _():
    return f"""WITH {PANEL}
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(date) AS min_date, MAX(date) AS max_date,
       CAST(COUNT(DISTINCT store_nbr) AS BIGINT) AS n_stores FROM panel"""


@oracle("validation_report")
def _():
    return validation_sql(f"WITH {PANEL}, src AS (SELECT * FROM panel)")


@oracle("validation_report_feed")
def _():
    return validation_sql(f"WITH {FEED}, src AS (SELECT * FROM feed)")


@oracle("quarantine_counts")
def _():
    parts = [f"SELECT 'null_{c}' AS violation, CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS n FROM feed"
             for c in REQUIRED]
    parts += [f"SELECT '{sev}_{c}', CAST(COUNT_IF({p}) AS BIGINT) FROM feed" for c, sev, p in RANGE_RULES]
    return f"WITH {FEED} SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0"


@oracle("model_columns")
def _():
    return f"""WITH {FEAT}
SELECT store_nbr, holiday_flag, month, week_of_year, year, sales_lag_1, sales_lag_4, sales_lag_52,
       sales_roll_mean_4, sales_roll_mean_8 FROM feat"""


@oracle("naive_baseline_all")
def _():
    return f"WITH {FEAT} SELECT {metrics('sales', 'sales_lag_1')} FROM feat WHERE sales_lag_1 IS NOT NULL"


@oracle("naive_baseline_by_store")
def _():
    return f"""WITH {holdout(8)}
SELECT store_nbr, {metrics('sales', 'sales_lag_1')} FROM test WHERE sales_lag_1 IS NOT NULL GROUP BY store_nbr"""


STORE_AVG = f"store_avg AS (SELECT store_nbr, {exact_mean('sales')} AS avg_sales FROM panel " \
            f"WHERE store_nbr IS NOT NULL GROUP BY store_nbr)"


@oracle("store_avg_sales")
def _():
    return f"WITH {PANEL}, {STORE_AVG} SELECT * FROM store_avg"


@oracle("rank_stores")
def _():
    return f"""WITH {PANEL}, {STORE_AVG}
SELECT store_nbr, avg_sales, CAST(ROW_NUMBER() OVER (ORDER BY avg_sales, store_nbr) AS INTEGER) AS rank
FROM store_avg"""


@oracle("store_scale_range")
def _():
    return f"""WITH {PANEL}, {STORE_AVG}
SELECT MIN(avg_sales) AS smallest_avg, MAX(avg_sales) AS largest_avg, CAST(COUNT(*) AS BIGINT) AS n_stores
FROM store_avg"""


@oracle("weekly_total")
def _():
    return f"""WITH {PANEL}
SELECT date, {exact_sum('sales')} AS total_sales, CAST(COUNT(*) AS BIGINT) AS n_stores FROM panel GROUP BY date"""


@oracle("holiday_effect")
def _():
    return f"""WITH {PANEL}
SELECT holiday_flag, {exact_mean('sales')} AS mean_sales, CAST(COUNT(*) AS BIGINT) AS n_weeks
FROM panel WHERE holiday_flag IS NOT NULL GROUP BY holiday_flag"""


@oracle("distinct_holiday_weeks")
def _():
    return f"WITH {PANEL} SELECT DISTINCT date FROM panel WHERE holiday_flag = 1"


IND = "ind AS (SELECT store_nbr, AVG(cpi) AS cpi, AVG(unemployment) AS unemployment FROM panel " \
      "WHERE store_nbr IS NOT NULL GROUP BY store_nbr)"


@oracle("indicator_by_store")
def _():
    return f"WITH {PANEL}, {IND} SELECT store_nbr, ROUND(cpi, 6) AS cpi, ROUND(unemployment, 6) AS unemployment FROM ind"


@oracle("describe_indicators")
def _():
    stats = [("count", "CAST(COUNT({c}) AS DOUBLE)"), ("mean", "AVG({c})"), ("std", "STDDEV_SAMP({c})"),
             ("min", "MIN({c})"), ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"),
             ("75%", "quantile_cont({c}, 0.75)"), ("max", "MAX({c})")]
    parts = [f"SELECT '{s}' AS stat, ROUND({e.format(c='cpi')}, 6) AS cpi, "
             f"ROUND({e.format(c='unemployment')}, 6) AS unemployment FROM ind" for s, e in stats]
    return f"WITH {PANEL}, {IND} {' UNION ALL '.join(parts)}"


def binned_sql(col: str, bins: int = 10) -> str:
    return f"""WITH {PANEL},
b AS (SELECT MIN({col}) AS lo, MAX({col}) AS hi, CORR({col}, sales) AS corr FROM panel),
w AS (SELECT lo, hi, corr, CASE WHEN hi > lo THEN (hi - lo) / {bins}.0::DOUBLE ELSE 1.0::DOUBLE END AS width FROM b),
x AS (SELECT LEAST(CAST(FLOOR((p.{col} - w.lo) / w.width) AS INTEGER), {bins - 1}) AS bin, p.sales
      FROM panel p, w WHERE p.{col} IS NOT NULL)
SELECT '{col}' AS indicator, x.bin, w.lo + x.bin * w.width AS bin_lo, w.lo + (x.bin + 1) * w.width AS bin_hi,
       CAST(COUNT(*) AS BIGINT) AS n, {exact_mean('x.sales')} AS mean_sales, ROUND(ANY_VALUE(w.corr), 6) AS corr
FROM x, w GROUP BY x.bin, w.lo, w.width"""


@oracle("temperature_vs_sales")
def _():
    return binned_sql("temperature")


@oracle("fuel_price_vs_sales")
def _():
    return binned_sql("fuel_price")


@oracle("evaluation_window")
def _():
    return f"""WITH {holdout(8)}
SELECT MIN(date) AS start_date, MAX(date) AS end_date, CAST(COUNT(DISTINCT date) AS BIGINT) AS n_weeks,
       CAST(COUNT(*) AS BIGINT) AS n_rows FROM test"""


@oracle("holiday_anchors")
def _():
    y = "year"
    a = {"super_bowl": nth_weekday(y, 2, 6, 1), "labor_day": nth_weekday(y, 9, 0, 1),
         "thanksgiving": nth_weekday(y, 11, 3, 4), "christmas": f"make_date({y}, 12, 25)"}
    cols = [f"{v} AS {k}" for k, v in a.items()] + [f"{wef(v)} AS {k}_week" for k, v in a.items()]
    return f"""WITH {PANEL}, years AS (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM panel)
SELECT year, {', '.join(cols)} FROM years"""


@oracle("calendar_features")
def _():
    return f"""WITH {PANEL},
days AS (SELECT CAST(unnest(generate_series(date - 6, date, INTERVAL 1 DAY)) AS DATE) AS day
         FROM (SELECT DISTINCT date FROM panel))
SELECT day, CAST(month(day) AS INTEGER) AS month, CAST(weekofyear(day) AS INTEGER) AS week_of_year,
       CAST(year(day) AS INTEGER) AS year, CAST(isodow(day) - 1 AS INTEGER) AS weekday,
       {wef('day')} AS week_friday, CAST({holiday('day')} AS INTEGER) AS holiday_flag
FROM days"""


SNAP_COLS = ["temperature", "fuel_price", "cpi", "unemployment", "sales_lag_1", "sales_lag_4", "sales_lag_52",
             "sales_roll_mean_4", "sales_roll_mean_8", "sales_roll_std_4"]
SNAP = "snap AS (SELECT store_nbr, " + ", ".join(f"arg_max({c}, date) AS {c}" for c in SNAP_COLS) + \
       " FROM feat WHERE store_nbr IS NOT NULL GROUP BY store_nbr)"

REQ = """
req AS (
  SELECT o_orderkey AS request_id, o_custkey AS batch_id,
         CAST((o_orderkey % 50) - 2 AS INTEGER) AS store_nbr,
         CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS date,
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS holiday_flag,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 5000.0::DOUBLE END AS temperature,
         CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice / 100000.0::DOUBLE - 1.0::DOUBLE END AS fuel_price,
         CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice / 1000.0::DOUBLE - 5.0::DOUBLE END AS cpi,
         CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice / 50000.0::DOUBLE - 0.5::DOUBLE END AS unemployment
  FROM orders
),
req_r AS (
  SELECT *, concat_ws(',',
    CASE WHEN store_nbr IS NULL THEN 'store_nbr_required' END,
    CASE WHEN store_nbr < 1 OR store_nbr > 45 THEN 'store_nbr_out_of_range' END,
    CASE WHEN date IS NULL THEN 'date_required' END,
    CASE WHEN holiday_flag IS NOT NULL AND holiday_flag NOT IN (0, 1) THEN 'holiday_flag_invalid' END,
    CASE WHEN fuel_price < 0 THEN 'fuel_price_negative' END,
    CASE WHEN cpi <= 0 THEN 'cpi_non_positive' END,
    CASE WHEN unemployment < 0 THEN 'unemployment_negative' END) AS reasons
  FROM req
),
req_ok AS (SELECT * EXCLUDE (reasons) FROM req_r WHERE reasons = '')"""


@oracle("snapshot")
def _():
    return f"WITH {FEAT}, {SNAP} SELECT * REPLACE (ROUND(sales_roll_std_4, 2) AS sales_roll_std_4) FROM snap"


@oracle("request_validation")
def _():
    return f"WITH {REQ} SELECT request_id, store_nbr, date, reasons FROM req_r WHERE reasons <> ''"


@oracle("batch_size_check")
def _():
    return f"""WITH {REQ}
SELECT batch_id, CAST(COUNT(*) AS BIGINT) AS n_items, COUNT(*) BETWEEN 1 AND 500 AS ok FROM req GROUP BY batch_id"""


SCORE = f"""
scored AS (
  SELECT r.request_id, r.batch_id, r.store_nbr, r.date,
         COALESCE(r.holiday_flag, CAST({holiday('r.date')} AS INTEGER)) AS holiday_flag,
         COALESCE(r.temperature, s.temperature) AS temperature,
         COALESCE(r.fuel_price, s.fuel_price) AS fuel_price,
         COALESCE(r.cpi, s.cpi) AS cpi,
         COALESCE(r.unemployment, s.unemployment) AS unemployment,
         CAST(month(r.date) AS INTEGER) AS month, CAST(weekofyear(r.date) AS INTEGER) AS week_of_year,
         CAST(year(r.date) AS INTEGER) AS year,
         s.sales_lag_1, s.sales_lag_4, s.sales_lag_52, s.sales_roll_mean_4, s.sales_roll_mean_8, s.sales_roll_std_4,
         CASE WHEN s.store_nbr IS NULL THEN 'unknown_store' ELSE 'ok' END AS status
  FROM req_ok r LEFT JOIN snap s ON r.store_nbr = s.store_nbr
)"""


@oracle("score_features")
def _():
    return (f"WITH {FEAT}, {SNAP}, {REQ}, {SCORE} "
            "SELECT * REPLACE (ROUND(sales_roll_std_4, 2) AS sales_roll_std_4) FROM scored")


@oracle("unknown_stores")
def _():
    return f"""WITH {FEAT}, {SNAP}, {REQ}
SELECT request_id, store_nbr, date FROM req_ok r WHERE NOT EXISTS (SELECT 1 FROM snap s WHERE s.store_nbr = r.store_nbr)"""


def predictions_sql(max_items: int | None) -> str:
    """Responses to all requests; with a limit, those of a batch of more items are invalid."""
    pred = clip0("EXP(LN(1 + sales_lag_1)) - 1")
    big = f"COUNT(*) > {max_items}" if max_items is not None else "false"
    return f"""WITH {FEAT}, {SNAP}, {REQ}, {SCORE},
big AS (SELECT batch_id FROM req GROUP BY batch_id HAVING {big}),
fit AS (SELECT * FROM scored WHERE batch_id NOT IN (SELECT batch_id FROM big))
SELECT request_id, store_nbr, date, ROUND({pred}, 4) AS predicted_sales, status,
       'naive' AS model_name, 'production' AS model_alias FROM fit WHERE status = 'ok'
UNION ALL
SELECT request_id, store_nbr, date, NULL, status, 'naive', 'production' FROM fit WHERE status <> 'ok'
UNION ALL
SELECT request_id, store_nbr, date, NULL, 'invalid', 'naive', 'production' FROM scored
WHERE batch_id IN (SELECT batch_id FROM big)
UNION ALL
SELECT request_id, store_nbr, date, NULL, 'invalid', 'naive', 'production' FROM req_r WHERE reasons <> ''"""


ORACLES["batch_predict_naive"] = predictions_sql(500)
ORACLES["batch_predict_limited"] = predictions_sql(12)
ORACLES["stream_scoring"] = predictions_sql(None)


# ---------------------------------------------------------------- 2.11 segments
def size_buckets(ref: str) -> str:
    return f"""
sa AS (SELECT store_nbr, {exact_mean('sales')} AS avg_sales FROM {ref} WHERE store_nbr IS NOT NULL GROUP BY store_nbr),
rk AS (SELECT store_nbr, avg_sales, ROW_NUMBER() OVER (ORDER BY avg_sales, store_nbr) AS rank,
              COUNT(*) OVER () AS n_stores FROM sa),
sizes AS (
  SELECT store_nbr, avg_sales, CAST(rank AS INTEGER) AS rank,
    CASE WHEN n_stores = 1 THEN 'medium'
         WHEN n_stores = 2 THEN CASE WHEN rank = 1 THEN 'small' ELSE 'large' END
         WHEN 3 * (rank - 1) < n_stores - 1 THEN 'small'
         WHEN 3 * (rank - 1) < 2 * (n_stores - 1) THEN 'medium'
         ELSE 'large' END AS store_size_bucket
  FROM rk
)"""


def segmented(ev: str, ref: str) -> str:
    return size_buckets(ref) + f""",
edges AS (SELECT list_sort(list_distinct(quantile_cont(unemployment, [0.25, 0.5, 0.75]))) AS e FROM {ref}),
seg AS (
  SELECT t.*, s.store_size_bucket,
    CASE WHEN t.unemployment IS NOT NULL THEN
      ['Q1_lowest', 'Q2', 'Q3', 'Q4_highest'][1 + (CASE WHEN edges.e[1] <= t.unemployment THEN 1 ELSE 0 END)
        + (CASE WHEN edges.e[2] <= t.unemployment THEN 1 ELSE 0 END)
        + (CASE WHEN edges.e[3] <= t.unemployment THEN 1 ELSE 0 END)] END
      AS unemployment_bucket
  FROM {ev} t LEFT JOIN sizes s ON t.store_nbr = s.store_nbr, edges
)"""


def seg_report() -> str:
    parts = [f"SELECT '{d}' AS segment_dimension, CAST({d} AS VARCHAR) AS segment_value, "
             f"{metrics('sales', 'prediction', r=False)} FROM seg WHERE {d} IS NOT NULL GROUP BY {d}"
             for d in ["store_size_bucket", "unemployment_bucket", "store_nbr"]]
    return "rep AS (" + " UNION ALL ".join(parts) + ")"


FAIR_SELECT = """
SELECT segment_dimension, segment_value, n, n_missing, ROUND(rmsle, 6) AS rmsle, ROUND(mae, 2) AS mae,
       ROUND(rmse, 2) AS rmse,
       ROUND(CASE WHEN MIN(rmsle) OVER d > 0 THEN MAX(rmsle) OVER d / MIN(rmsle) OVER d END, 6) AS disparity_ratio,
       COALESCE(CASE WHEN MIN(rmsle) OVER d > 0 THEN MAX(rmsle) OVER d / MIN(rmsle) OVER d END > 1.5, false)
         AS flagged
FROM rep WINDOW d AS (PARTITION BY segment_dimension)"""

NAIVE_HOLDOUT = holdout(8) + ", ev AS (SELECT *, sales_lag_1 AS prediction FROM test)"


@oracle("store_size_buckets")
def _():
    return f"WITH {holdout(8)}, {size_buckets('pool')} SELECT * FROM sizes"


@oracle("unemployment_edges")
def _():
    return f"""WITH {holdout(8)},
q AS (SELECT list_sort(list_distinct(quantile_cont(unemployment, [0.25, 0.5, 0.75]))) AS e FROM pool)
SELECT CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS edge_index, ROUND(unnest(e), 6) AS edge FROM q"""


@oracle("holdout_segments")
def _():
    return f"""WITH {NAIVE_HOLDOUT}, {segmented('ev', 'pool')}
SELECT store_nbr, date, unemployment, store_size_bucket, unemployment_bucket FROM seg"""


@oracle("segment_performance_size")
def _():
    return f"""WITH {NAIVE_HOLDOUT}, {segmented('ev', 'pool')}
SELECT store_size_bucket, {metrics('sales', 'prediction')} FROM seg WHERE store_size_bucket IS NOT NULL
GROUP BY store_size_bucket"""


@oracle("fairness_report")
def _():
    return f"WITH {NAIVE_HOLDOUT}, {segmented('ev', 'pool')}, {seg_report()} {FAIR_SELECT}"


@oracle("fairness_report_self")
def _():
    return (f"WITH {FEAT}, ev AS (SELECT *, sales_lag_1 AS prediction FROM feat), "
            f"{segmented('ev', 'ev')}, {seg_report()} {FAIR_SELECT}")


@oracle("disparity_summary")
def _():
    return f"""WITH {NAIVE_HOLDOUT}, {segmented('ev', 'pool')}, {seg_report()},
agg AS (SELECT segment_dimension, MIN(rmsle) AS lo, MAX(rmsle) AS hi, CAST(COUNT(*) AS BIGINT) AS n_segments
        FROM rep GROUP BY segment_dimension)
SELECT segment_dimension, n_segments, ROUND(CASE WHEN lo > 0 THEN hi / lo END, 6) AS disparity_ratio,
       COALESCE(CASE WHEN lo > 0 THEN hi / lo END > 1.5, false) AS flagged FROM agg"""


@oracle("worst_store_latest")
def _():
    d = f"({log1p(clip0('sales_lag_1'))} - {log1p(clip0('sales'))})"
    return f"""WITH {NAIVE_HOLDOUT},
ps AS (SELECT store_nbr, SQRT(AVG({d} * {d})) AS rmsle FROM ev WHERE sales_lag_1 IS NOT NULL GROUP BY store_nbr),
worst AS (SELECT store_nbr FROM ps ORDER BY rmsle DESC, store_nbr ASC LIMIT 1)
SELECT e.store_nbr, e.date, e.sales, e.prediction FROM ev e JOIN worst w ON e.store_nbr = w.store_nbr
ORDER BY e.date DESC LIMIT 1"""


# ---------------------------------------------------------------- 2.5 folds
def folds_sql(k: int = 3) -> str:
    fl = ", ".join(str(j) for j in range(k))
    return f"""
di AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) - 1 AS i, COUNT(*) OVER () AS n
       FROM (SELECT DISTINCT date FROM pool)),
dt AS (SELECT *, CAST(FLOOR(n / {k + 1}) AS BIGINT) AS t FROM di),
df AS (SELECT date, i, n, t, unnest([{fl}]) AS fold FROM dt),
folds AS (
  SELECT date, CAST(fold AS INTEGER) AS fold,
         CASE WHEN i >= n - ({k} - fold) * t THEN 'valid' ELSE 'train' END AS role
  FROM df WHERE t > 0 AND i < n - ({k - 1} - fold) * t
)"""


@oracle("cv_folds")
def _():
    return f"WITH {holdout(8)}, {folds_sql()} SELECT * FROM folds"


@oracle("fold_sizes")
def _():
    return f"""WITH {holdout(8)}, {folds_sql()}
SELECT f.fold, f.role, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(DISTINCT p.date) AS BIGINT) AS n_weeks,
       MIN(p.date) AS first_date, MAX(p.date) AS last_date
FROM pool p JOIN folds f ON p.date = f.date GROUP BY f.fold, f.role"""


@oracle("naive_cv_scores")
def _():
    d = f"({log1p(clip0('sales_lag_1'))} - {log1p(clip0('sales'))})"
    return f"""WITH {holdout(8)}, {folds_sql()},
pf AS (SELECT f.fold, SQRT(AVG({d} * {d})) AS rmsle FROM pool p JOIN folds f ON p.date = f.date
       WHERE f.role = 'valid' AND p.sales_lag_1 IS NOT NULL GROUP BY f.fold)
SELECT fold, ROUND(rmsle, 6) AS rmsle FROM pf
UNION ALL SELECT -1, ROUND(AVG(rmsle), 6) FROM pf"""


@oracle("holdout_disjoint")
def _():
    return f"""WITH {holdout(8)}
SELECT CAST((SELECT COUNT(*) FROM (SELECT date FROM pool INTERSECT SELECT date FROM test)) AS BIGINT) AS n_shared,
       (SELECT MAX(date) FROM pool) AS pool_max, (SELECT MIN(date) FROM test) AS test_min,
       COALESCE((SELECT MAX(date) FROM pool) < (SELECT MIN(date) FROM test), true) AS ordered"""


# ---------------------------------------------------------------- run log / versions
RUNS = """
runs AS (
  SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id,
         'candidate-' || CAST(o_orderkey % 6 AS VARCHAR) AS run_name,
         'model-' || CAST(o_custkey % 7 AS VARCHAR) AS model_name,
         CASE WHEN o_orderstatus = 'F' THEN 'gbt_final' ELSE 'gbt' END AS model_type,
         CAST(3 + o_orderkey % 3 AS VARCHAR) AS max_depth,
         o_totalprice / 1000000.0::DOUBLE AS test_rmsle,
         o_totalprice / 900000.0::DOUBLE AS cv_mean_rmsle,
         o_orderpriority AS priority,
         CAST(o_orderdate AS TIMESTAMP) AS started_at
  FROM orders
)"""

VERSIONS = """
versions AS (
  SELECT 'model-' || CAST(o_custkey % 7 AS VARCHAR) AS model_name, o_orderkey AS version,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'production' END AS alias,
         'run-' || CAST(o_orderkey AS VARCHAR) AS run_id,
         CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS created_at
  FROM orders WHERE o_orderstatus = 'F'
),
cur AS (
  SELECT model_name, version, run_id, created_at FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY created_at DESC, version DESC) AS rn
    FROM versions WHERE alias = 'production') WHERE rn = 1
)"""

INCUMBENT = "inc AS (SELECT c.run_id, c.model_name, c.version, c.created_at, r.test_rmsle AS incumbent_test_rmsle " \
            "FROM cur c LEFT JOIN runs r ON c.run_id = r.run_id)"


@oracle("run_log_read")
def _():
    return f"WITH {RUNS} SELECT run_id, run_name, model_name, model_type, max_depth, test_rmsle, priority, " \
           f"started_at FROM runs"


@oracle("tag_lineage")
def _():
    return f"""WITH {PANEL}, {RUNS},
fp AS (SELECT CAST(COUNT(*) AS VARCHAR) AS raw_data_rows, CAST(MIN(date) AS VARCHAR) AS raw_data_min_date,
              CAST(MAX(date) AS VARCHAR) AS raw_data_max_date,
              CAST(COUNT(DISTINCT store_nbr) AS VARCHAR) AS raw_data_n_stores FROM panel)
SELECT r.run_id, fp.raw_data_rows, fp.raw_data_min_date, fp.raw_data_max_date, fp.raw_data_n_stores, r.priority
FROM runs r, fp"""


@oracle("incumbent")
def _():
    return f"WITH {RUNS}, {VERSIONS}, {INCUMBENT} SELECT * FROM inc"


@oracle("quality_gate")
def _():
    return f"""WITH {RUNS}, {VERSIONS}, {INCUMBENT},
lr AS (SELECT model_name, run_id, candidate_test_rmsle FROM (
  SELECT model_name, run_id, test_rmsle AS candidate_test_rmsle,
         ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY started_at DESC, run_id DESC) AS rn FROM runs)
  WHERE rn = 1)
SELECT lr.model_name, lr.run_id, lr.candidate_test_rmsle, i.incumbent_test_rmsle,
       COALESCE(i.incumbent_test_rmsle IS NULL OR (NOT isnan(lr.candidate_test_rmsle)
                AND NOT isnan(i.incumbent_test_rmsle) AND lr.candidate_test_rmsle <= i.incumbent_test_rmsle), false)
         AS gate_passed
FROM lr LEFT JOIN inc i ON lr.model_name = i.model_name"""


@oracle("best_candidate")
def _():
    return f"""WITH {RUNS}
SELECT model_name, arg_min(run_id, (cv_mean_rmsle, run_id)) AS best_run_id, MIN(cv_mean_rmsle) AS best_cv_mean_rmsle
FROM runs WHERE cv_mean_rmsle IS NOT NULL AND NOT isnan(cv_mean_rmsle) GROUP BY model_name"""


AGE = """
cur_now AS (
  SELECT model_name, version, run_id, created_at FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY created_at DESC, version DESC) AS rn
    FROM versions WHERE alias = 'production' AND created_at <= TIMESTAMP '2001-08-02 00:00:00') WHERE rn = 1
),
age AS (
  SELECT model_name, version, created_at,
         (epoch_us(TIMESTAMP '2001-08-02 00:00:00') / 1e6 - epoch_us(created_at) / 1e6) AS age_seconds
  FROM cur_now
)"""


@oracle("model_age")
def _():
    return f"""WITH {VERSIONS}, {AGE}
SELECT model_name, version, created_at, ROUND(age_seconds / 86400.0, 6) AS age_days FROM age"""


@oracle("staleness_status")
def _():
    due = "COALESCE(a.age_seconds >= 7 * 86400.0, true)"
    near = f"(a.age_seconds IS NOT NULL AND NOT {due} AND a.age_seconds >= 5 * 86400.0)"
    return f"""WITH {RUNS}, {VERSIONS}, {AGE}
SELECT m.model_name, a.version, ROUND(a.age_seconds / 86400.0, 6) AS age_days, {due} AS due, {near} AS approaching,
       CASE WHEN {due} THEN 'due' WHEN {near} THEN 'approaching' ELSE 'fresh' END AS status,
       ROUND(CASE WHEN NOT {due} THEN 7.0 - a.age_seconds / 86400.0 END, 6) AS days_left
FROM (SELECT DISTINCT model_name FROM runs) m LEFT JOIN age a ON m.model_name = a.model_name"""


# ---------------------------------------------------------------- 2.13 monitoring
PLOG = """
plog AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(user_id % 45 + 1 AS INTEGER) AS store_nbr,
         CASE WHEN event_type = 'error' AND value >= 50 THEN 404 WHEN event_type = 'error' THEN 500 ELSE 200 END
           AS http_status,
         CASE WHEN event_type = 'error' AND value >= 50 THEN 'unknown_store'
              WHEN event_type = 'error' THEN 'internal_error' END AS reason,
         value / 1000.0::DOUBLE AS latency_s,
         CASE WHEN event_type <> 'error' THEN value * 10000.0::DOUBLE END AS predicted_sales
  FROM events
)"""


def sliding(src: str, size_min: int, slide_min: int = 1) -> str:
    ks = ", ".join(str(k) for k in range(size_min // slide_min))
    return f"""
SELECT p.*, date_trunc('minute', p.ts) - to_minutes(CAST(k.k AS BIGINT)) AS window_start,
       date_trunc('minute', p.ts) - to_minutes(CAST(k.k AS BIGINT)) + to_minutes({size_min}) AS window_end
FROM {src} p, (SELECT unnest([{ks}]) AS k) k"""


def alert_sql(cond: str, keys: list[str], hold_s: float) -> str:
    """CTEs a1..a4 implementing alert_for on ``cond`` (keys…, tick, condition)."""
    k = ", ".join(keys)
    return f"""
a1 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY tick) AS i FROM {cond}),
a2 AS (SELECT *, i - ROW_NUMBER() OVER (PARTITION BY {k}, condition ORDER BY tick) AS grp FROM a1),
a3 AS (SELECT *, CASE WHEN condition THEN MIN(tick) OVER (PARTITION BY {k}, condition, grp) END AS pending_since
       FROM a2),
a4 AS (SELECT *, COALESCE(condition AND (epoch_us(tick) - epoch_us(pending_since)) >= {int(hold_s * 1e6)}, false)
         AS firing FROM a3)"""


def episodes_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, pending_since, MIN(CASE WHEN firing THEN tick END) AS fired_at, MAX(tick) AS last_tick
FROM a4 WHERE pending_since IS NOT NULL GROUP BY {k}, pending_since
HAVING MIN(CASE WHEN firing THEN tick END) IS NOT NULL"""


TICKS = """
bnd AS (SELECT MIN(ts) AS lo, MAX(ts) AS hi FROM plog),
ticks AS (SELECT date_trunc('minute', lo) + to_minutes(CAST(unnest(range(1, CAST(floor(epoch(hi - lo) / 60) AS BIGINT) + 3)) AS BIGINT)) AS tick
          FROM bnd)"""


@oracle("prediction_log")
def _():
    return f"WITH {PLOG} SELECT * FROM plog"


@oracle("prediction_rate")
def _():
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)})
SELECT window_start, window_end, store_nbr, CAST(COUNT(*) AS BIGINT) AS n, ROUND(COUNT(*) / 300.0::DOUBLE, 6) AS rate
FROM w WHERE http_status = 200 GROUP BY window_start, window_end, store_nbr"""


@oracle("error_rate_by_reason")
def _():
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)})
SELECT window_start, window_end, reason, CAST(COUNT(*) AS BIGINT) AS n, ROUND(COUNT(*) / 300.0::DOUBLE, 6) AS rate,
       COUNT(*) / 300.0::DOUBLE > 0.5 AS alert
FROM w WHERE reason IS NOT NULL GROUP BY window_start, window_end, reason"""


@oracle("request_rate_by_status")
def _():
    return f"""WITH {PLOG}
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
       http_status, CAST(COUNT(*) AS BIGINT) AS n, ROUND(COUNT(*) / 60.0::DOUBLE, 6) AS rate
FROM plog GROUP BY 1, 2, http_status"""


@oracle("http_error_ratio")
def _():
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)})
SELECT window_start, window_end, CAST(COUNT_IF(http_status >= 500) AS BIGINT) AS n_5xx, CAST(COUNT(*) AS BIGINT) AS n,
       ROUND(COUNT_IF(http_status >= 500) / COUNT(*), 6) AS ratio, COUNT_IF(http_status >= 500) / COUNT(*) > 0.05 AS alert
FROM w GROUP BY window_start, window_end"""


@oracle("latency_quantiles")
def _():
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)})
SELECT window_start, window_end, CAST(COUNT(*) AS BIGINT) AS n, ROUND(quantile_cont(latency_s, 0.5), 8) AS p50,
       ROUND(quantile_cont(latency_s, 0.95), 8) AS p95, quantile_cont(latency_s, 0.95) > 0.5 AS alert
FROM w WHERE http_status = 200 GROUP BY window_start, window_end"""


BOUNDS = [0, 100_000, 250_000, 500_000, 750_000, 1_000_000, 1_250_000, 1_500_000, 1_750_000, 2_000_000,
          2_500_000, 3_000_000]
HIST = "hist AS (" + " UNION ALL ".join(
    [f"SELECT {i} AS bucket, '{b}' AS le, {float(b)}::DOUBLE AS upper, "
     f"CAST(COUNT_IF(predicted_sales <= {float(b)}) AS BIGINT) AS cum_count FROM plog WHERE predicted_sales IS NOT NULL"
     for i, b in enumerate(BOUNDS)]
    + [f"SELECT {len(BOUNDS)}, '+Inf', 'inf'::DOUBLE, CAST(COUNT(*) AS BIGINT) FROM plog WHERE predicted_sales IS NOT NULL"]
) + ")"


@oracle("sales_histogram")
def _():
    return f"WITH {PLOG}, {HIST} SELECT CAST(bucket AS INTEGER) AS bucket, le, cum_count FROM hist"


@oracle("histogram_quantiles")
def _():
    st = "COALESCE(prev_upper, 0.0)"
    pc = "COALESCE(prev_cum, 0)"
    val = (f"CASE WHEN bucket = last_bucket THEN prev_upper WHEN bucket = 0 AND upper <= 0 THEN upper "
           f"ELSE {st} + (upper - {st}) * ((q * total - {pc}) / (cum_count - {pc})) END")
    return f"""WITH {PLOG}, {HIST},
hh AS (SELECT *, LAG(upper) OVER (ORDER BY bucket) AS prev_upper, LAG(cum_count) OVER (ORDER BY bucket) AS prev_cum,
              MAX(cum_count) OVER () AS total, MAX(bucket) OVER () AS last_bucket FROM hist),
qs AS (SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE]) AS q)
SELECT q, ROUND(arg_min({val}, bucket), 2) AS value FROM hh, qs WHERE cum_count >= q * total GROUP BY q"""


@oracle("no_traffic_alerts")
def _():
    return f"""WITH {PLOG}, {TICKS},
mn AS (SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE AS m_end, COUNT(*) AS n FROM plog WHERE http_status = 200
       GROUP BY 1),
sp AS (SELECT m_end + to_minutes(CAST(k AS BIGINT)) AS tick, n FROM mn, (SELECT unnest(range(0, 15)) AS k)),
pt AS (SELECT tick, SUM(n) AS n FROM sp GROUP BY tick),
cond AS (SELECT 'no_traffic' AS rule, t.tick, COALESCE(pt.n, 0) = 0 AS condition
         FROM ticks t LEFT JOIN pt ON t.tick = pt.tick),
{alert_sql('cond', ['rule'], 15 * 60)}
{episodes_sql(['rule'])}"""


@oracle("error_rate_alerts")
def _():
    return f"""WITH {PLOG}, {TICKS}, w AS ({sliding('plog', 5)}),
er AS (SELECT window_end AS tick, COUNT(*) / 300.0::DOUBLE > 0.002 AS alert FROM w WHERE reason IS NOT NULL
       GROUP BY window_end),
cond AS (SELECT 'error_rate' AS rule, t.tick, COALESCE(er.alert, false) AS condition
         FROM ticks t LEFT JOIN er ON t.tick = er.tick),
{alert_sql('cond', ['rule'], 5 * 60)}
{episodes_sql(['rule'])}"""


@oracle("http_error_alerts")
def _():
    return f"""WITH {PLOG}, {TICKS}, w AS ({sliding('plog', 5)}),
er AS (SELECT window_end AS tick, COUNT_IF(http_status >= 500) / CAST(COUNT(*) AS DOUBLE) > 0.05 AS alert
       FROM w GROUP BY window_end),
cond AS (SELECT 'http_errors' AS rule, t.tick, COALESCE(er.alert, false) AS condition
         FROM ticks t LEFT JOIN er ON t.tick = er.tick),
{alert_sql('cond', ['rule'], 5 * 60)}
{episodes_sql(['rule'])}"""


@oracle("latency_alerts")
def _():
    return f"""WITH {PLOG}, {TICKS}, w AS ({sliding('plog', 5)}),
lq AS (SELECT window_end AS tick, quantile_cont(latency_s, 0.95) > 0.05 AS alert FROM w WHERE http_status = 200
       GROUP BY window_end),
cond AS (SELECT 'latency_p95' AS rule, t.tick, COALESCE(lq.alert, false) AS condition
         FROM ticks t LEFT JOIN lq ON t.tick = lq.tick),
{alert_sql('cond', ['rule'], 5 * 60)}
{episodes_sql(['rule'])}"""


@oracle("http_latency_quantiles")
def _():
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)})
SELECT window_start, window_end, CAST(COUNT(*) AS BIGINT) AS n, ROUND(quantile_cont(latency_s, 0.5), 8) AS p50,
       ROUND(quantile_cont(latency_s, 0.95), 8) AS p95
FROM w GROUP BY window_start, window_end"""


@oracle("model_not_loaded_alerts")
def _():
    now = "TIMESTAMP '2001-08-02 00:00:00'"
    return f"""WITH {RUNS}, {VERSIONS},
fr AS (SELECT model_name, MIN(started_at) AS p FROM runs WHERE started_at <= {now} GROUP BY model_name),
fm AS (SELECT model_name, MIN(created_at) AS l FROM versions WHERE alias = 'production' AND created_at <= {now} GROUP BY 1),
ep AS (SELECT fr.model_name, p, LEAST({now}, COALESCE(l, {now})) AS u FROM fr LEFT JOIN fm ON fr.model_name = fm.model_name)
SELECT 'model_not_loaded' AS rule, model_name, p AS pending_since, p + INTERVAL 2 MINUTE AS fired_at, u AS until
FROM ep WHERE p + INTERVAL 2 MINUTE <= u"""


@oracle("scrape_up")
def _():
    return f"""WITH {PLOG},
hb AS (SELECT CAST(http_status AS VARCHAR) AS rule, ts FROM plog),
mn AS (SELECT rule, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS m_end, COUNT(*) AS n FROM hb GROUP BY 1, 2),
sp AS (SELECT rule, m_end + to_minutes(CAST(k AS BIGINT)) AS tick, n FROM mn, (SELECT unnest(range(0, 30)) AS k)),
seen AS (SELECT rule, tick, SUM(n) AS n FROM sp GROUP BY 1, 2),
bd AS (SELECT rule, MIN(m_end) AS lo, (SELECT MAX(m_end) FROM mn) AS hi FROM mn GROUP BY rule),
tk AS (SELECT rule, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS tick FROM bd),
cond AS (SELECT t.rule, t.tick, COALESCE(s.n, 0) = 0 AS condition FROM tk t LEFT JOIN seen s
         ON t.rule = s.rule AND t.tick = s.tick),
{alert_sql('cond', ['rule'], 60)}
SELECT rule, CAST(COUNT_IF(condition) AS BIGINT) AS n_down_ticks, CAST(COUNT_IF(firing) AS BIGINT) AS n_firing_ticks,
       MIN(CASE WHEN firing THEN tick END) AS first_firing FROM a4 GROUP BY rule"""


@oracle("staleness_alerts")
def _():
    now = "TIMESTAMP '2001-08-02 00:00:00'"
    return f"""WITH {VERSIONS},
mv AS (SELECT DISTINCT model_name, created_at FROM versions WHERE alias = 'production' AND created_at <= {now}),
sp AS (SELECT *, LEAD(created_at) OVER (PARTITION BY model_name ORDER BY created_at) AS nx FROM mv),
ep AS (SELECT model_name, nx, 'approaching' AS rule, created_at + INTERVAL 5 DAY AS pending_since,
              created_at + INTERVAL 5 DAY + INTERVAL 10 MINUTE AS fired_at,
              LEAST({now}, COALESCE(nx, {now}), created_at + INTERVAL 7 DAY) AS until FROM sp
       UNION ALL
       SELECT model_name, nx, 'stale', created_at + INTERVAL 7 DAY, created_at + INTERVAL 8 DAY,
              LEAST({now}, COALESCE(nx, {now})) FROM sp)
SELECT model_name, rule, pending_since, fired_at, until FROM ep
WHERE fired_at <= {now} AND (nx IS NULL OR fired_at < nx)"""


@oracle("model_status")
def _():
    return f"""WITH {RUNS}, {VERSIONS}, {AGE}
SELECT m.model_name, a.version IS NOT NULL AS model_loaded, a.version, ROUND(a.age_seconds / 86400.0, 6) AS age_days
FROM (SELECT DISTINCT model_name FROM runs) m LEFT JOIN age a ON m.model_name = a.model_name"""


@oracle("stream_counters_batch")
def _():
    return f"""WITH {PLOG}
SELECT 'predictions' AS counter, CAST(store_nbr AS VARCHAR) AS label, CAST(COUNT(*) AS BIGINT) AS total
FROM plog WHERE http_status = 200 GROUP BY store_nbr
UNION ALL SELECT 'errors', reason, CAST(COUNT(*) AS BIGINT) FROM plog WHERE reason IS NOT NULL GROUP BY reason"""


# Streaming forms: same result as their batch twins once the input is drained.
for _b, _s in [("prediction_rate", "stream_prediction_rate"), ("error_rate_by_reason", "stream_error_rate_by_reason"),
               ("request_rate_by_status", "stream_request_rate_by_status"), ("http_error_ratio", "stream_http_error_ratio"),
               ("stream_counters_batch", "stream_counters"),
               ("no_traffic_alerts", "stream_no_traffic_alerts")]:
    ORACLES[_s] = ORACLES[_b]


@oracle("stream_latency_quantiles")
def _():
    # the sketch keeps every value of a window until it holds more than SKETCH_K
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)})
SELECT window_start, window_end, CAST(COUNT(*) AS BIGINT) AS n, ROUND(quantile_disc(latency_s, 0.5), 8) AS p50,
       ROUND(quantile_disc(latency_s, 0.95), 8) AS p95, quantile_disc(latency_s, 0.95) > 0.5 AS alert
FROM w WHERE http_status = 200 GROUP BY window_start, window_end"""


ORACLES["snapshot_roundtrip"] = ORACLES["snapshot"]


@oracle("densify_panel")
def _():
    return f"""WITH {PANEL},
b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM panel),
sp AS (SELECT s.store_nbr, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 7 DAY)) AS DATE) AS date
       FROM (SELECT DISTINCT store_nbr FROM panel) s, b)
SELECT sp.store_nbr, sp.date, p.sales, COALESCE(p.holiday_flag, CAST({holiday('sp.date')} AS INTEGER)) AS holiday_flag,
       p.temperature, p.fuel_price, p.cpi, p.unemployment
FROM sp LEFT JOIN panel p ON sp.store_nbr = p.store_nbr AND sp.date = p.date"""


@oracle("snapshot_advanced")
def _():
    return f"""WITH {PANEL},
nxt AS (SELECT store_nbr, MAX(date) + 7 AS date, CAST(NULL AS DOUBLE) AS sales,
               arg_max(temperature, date) AS temperature, arg_max(fuel_price, date) AS fuel_price,
               arg_max(cpi, date) AS cpi, arg_max(unemployment, date) AS unemployment
        FROM panel GROUP BY store_nbr),
rows AS (SELECT store_nbr, date, sales, temperature, fuel_price, cpi, unemployment, false AS nx FROM panel
         UNION ALL SELECT store_nbr, date, sales, temperature, fuel_price, cpi, unemployment, true FROM nxt),
f AS (
  SELECT *, LAG(sales, 1) OVER w AS sales_lag_1, LAG(sales, 4) OVER w AS sales_lag_4, LAG(sales, 52) OVER w AS sales_lag_52,
    CAST(SUM(CAST(sales AS DECIMAL(38,8))) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / COUNT(sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS sales_roll_mean_4,
    CAST(SUM(CAST(sales AS DECIMAL(38,8))) OVER (w ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / COUNT(sales) OVER (w ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS sales_roll_mean_8,
    STDDEV_SAMP(sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS sales_roll_std_4
  FROM rows WINDOW w AS (PARTITION BY store_nbr ORDER BY date))
SELECT store_nbr, temperature, fuel_price, cpi, unemployment, sales_lag_1, sales_lag_4, sales_lag_52,
       sales_roll_mean_4, sales_roll_mean_8, ROUND(sales_roll_std_4, 2) AS sales_roll_std_4, date AS target_date
FROM f WHERE nx"""


@oracle("windowed_sales_quantiles")
def _():
    parts = [f"SELECT window_start, window_end, {i} AS bucket, {float(b)}::DOUBLE AS upper, "
             f"CAST(COUNT_IF(predicted_sales <= {float(b)}) AS BIGINT) AS cum_count FROM w "
             f"WHERE predicted_sales IS NOT NULL GROUP BY window_start, window_end" for i, b in enumerate(BOUNDS)]
    parts.append(f"SELECT window_start, window_end, {len(BOUNDS)}, 'inf'::DOUBLE, CAST(COUNT(*) AS BIGINT) FROM w "
                 f"WHERE predicted_sales IS NOT NULL GROUP BY window_start, window_end")
    st, pc = "COALESCE(prev_upper, 0.0)", "COALESCE(prev_cum, 0)"
    val = (f"CASE WHEN bucket = last_bucket THEN prev_upper WHEN bucket = 0 AND upper <= 0 THEN upper "
           f"ELSE {st} + (upper - {st}) * ((0.5::DOUBLE * total - {pc}) / (cum_count - {pc})) END")
    return f"""WITH {PLOG}, w AS ({sliding('plog', 5)}),
hist AS ({' UNION ALL '.join(parts)}),
hh AS (SELECT *, LAG(upper) OVER k AS prev_upper, LAG(cum_count) OVER k AS prev_cum,
              MAX(cum_count) OVER (PARTITION BY window_start, window_end) AS total,
              MAX(bucket) OVER (PARTITION BY window_start, window_end) AS last_bucket
       FROM hist WINDOW k AS (PARTITION BY window_start, window_end ORDER BY bucket))
SELECT window_start, window_end, 0.5::DOUBLE AS q, ROUND(arg_min({val}, bucket), 2) AS value
FROM hh WHERE cum_count >= 0.5::DOUBLE * total GROUP BY window_start, window_end"""


@oracle("run_disparity_metrics")
def _():
    return f"""WITH {NAIVE_HOLDOUT}, {segmented('ev', 'pool')}, {seg_report()}, {RUNS},
d AS (SELECT segment_dimension, CASE WHEN MIN(rmsle) > 0 THEN MAX(rmsle) / MIN(rmsle) END AS r
      FROM rep GROUP BY segment_dimension),
p AS (SELECT MAX(CASE WHEN segment_dimension = 'store_size_bucket' THEN r END) AS a,
             MAX(CASE WHEN segment_dimension = 'unemployment_bucket' THEN r END) AS b,
             MAX(CASE WHEN segment_dimension = 'store_nbr' THEN r END) AS c FROM d)
SELECT runs.run_id, ROUND(runs.test_rmsle, 6) AS test_rmsle,
       ROUND(p.a, 6) AS fairness_disparity_ratio_store_size_bucket,
       ROUND(p.b, 6) AS fairness_disparity_ratio_unemployment_bucket,
       ROUND(p.c, 6) AS fairness_disparity_ratio_store_nbr
FROM runs, p"""

LEVEL_SUMS = FEAT + """,
logs AS (SELECT *, CAST(log_sales AS DECIMAL(18,9)) AS log FROM feat)"""
ORACLES["store_levels"] = "WITH " + LEVEL_SUMS + """,
weekly AS (SELECT date, SUM(log) AS s, COUNT(log) AS n FROM logs GROUP BY date),
prior AS (SELECT date, CAST(SUM(s) OVER w AS DOUBLE) / NULLIF(SUM(n) OVER w, 0) AS prior FROM weekly
          WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
own AS (SELECT store_nbr, date, SUM(log) OVER w AS s, COUNT(log) OVER w AS n FROM logs
        WINDOW w AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT store_nbr, date, ROUND(COALESCE((COALESCE(CAST(s AS DOUBLE), 0.0) + 8 * prior) / (n + 8), 0.0), 6) AS store_level
FROM own JOIN prior USING (date)"""
ORACLES["store_levels_final"] = "WITH " + LEVEL_SUMS + """,
per AS (SELECT store_nbr, SUM(log) AS s, COUNT(log) AS n FROM logs GROUP BY store_nbr),
overall AS (SELECT CAST(SUM(s) AS DOUBLE) / SUM(n) AS prior FROM per)
SELECT store_nbr, ROUND((CAST(s AS DOUBLE) + 8 * prior) / (n + 8), 6) AS store_level FROM per, overall
UNION ALL SELECT NULL, ROUND(prior, 6) FROM overall"""
