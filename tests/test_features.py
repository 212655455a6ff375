import datetime as dt
import math
import statistics

from pyspark.sql import functions as F

from conftest import FIRST_WEEK, toy_panel, week_sales
from tillpanel.functions.calendar import is_major_holiday_week, nth_weekday, week_ending_friday
from tillpanel.operators.features import INPUTS, history_inputs, model_inputs, with_inputs, with_last_week
from tillpanel.sources.panel import weeks_between, write_store_table


def _nth(year, month, weekday, n):
    """n-th Monday (0) … Sunday (6) of a month, by walking through it."""
    days = [dt.date(year, month, 1) + dt.timedelta(days=i) for i in range(28)]
    return [d for d in days if d.weekday() == weekday][n - 1]


def _closing_friday(day):
    while day.weekday() != 4:
        day += dt.timedelta(days=1)
    return day


def _holiday_fridays(year):
    """The three holiday weeks outside February: first Monday of September, fourth Thursday of November, 25 December."""
    return {_closing_friday(_nth(year, 9, 0, 1)), _closing_friday(_nth(year, 11, 3, 4)),
            _closing_friday(dt.date(year, 12, 25))}


def test_holiday_weeks_of_many_years(spark):
    fridays = [dt.date(2027, 1, 1) + dt.timedelta(weeks=w) for w in range(52 * 9)]
    df = spark.createDataFrame([(d,) for d in fridays], "d date")
    flagged = {r[0] for r in df.filter(is_major_holiday_week(F.col("d")) == 1).collect()}
    for year in range(2028, 2035):
        of_year = {d for d in flagged if d.year == year}
        assert _holiday_fridays(year) <= of_year
        assert len(of_year - _holiday_fridays(year)) == 1  # the one in February
        assert [d.month for d in of_year - _holiday_fridays(year)] == [2]


def test_every_day_of_a_week_is_flagged_like_its_friday(spark):
    days = [dt.date(2029, 8, 25) + dt.timedelta(days=i) for i in range(200)]
    df = spark.createDataFrame([(d, _closing_friday(d)) for d in days], "d date, f date")
    odd = df.filter((is_major_holiday_week(F.col("d")) != is_major_holiday_week(F.col("f")))
                    | (week_ending_friday("d") != F.col("f")))
    assert odd.count() == 0


def test_nth_weekday_by_walking(spark):
    cases = [(y, m, wd, n) for y in (2026, 2028, 2033) for m in (2, 9, 11) for wd in (0, 3, 6) for n in (1, 2, 4)]
    for y, m, wd, n in cases[::5]:
        assert spark.range(1).select(nth_weekday(F.lit(y), m, wd, n)).first()[0] == _nth(y, m, wd, n)


def _by_week(spark, stores=(3, 5), weeks=60):
    rows = with_inputs(toy_panel(spark, stores=stores, weeks=weeks)).collect()
    first = dt.date.fromisoformat(FIRST_WEEK)
    return {(r["store_nbr"], (r["date"] - first).days // 7): r for r in rows}


def test_history_inputs_against_plain_lists(spark):
    got = _by_week(spark)
    for (s, w), r in got.items():
        past = [week_sales(s, i) for i in range(w)]
        for k in (1, 4, 52):
            assert r[f"sales_lag_{k}"] == (past[-k] if len(past) >= k else None)
        for k in (4, 8):
            want = statistics.fmean(past[-k:]) if past else None
            assert r[f"sales_roll_mean_{k}"] == want or abs(r[f"sales_roll_mean_{k}"] - want) < 1e-9
        want = statistics.stdev(past[-4:]) if len(past) >= 2 else None
        assert r["sales_roll_std_4"] == want or abs(r["sales_roll_std_4"] - want) < 1e-9
        assert abs(r["log_sales"] - math.log(1 + week_sales(s, w))) < 1e-12


def test_missing_sales_are_no_values(spark):
    panel = toy_panel(spark, weeks=6).withColumn("sales", F.when(F.weekofyear("date") % 2 == 0, F.col("sales")))
    rows = with_inputs(panel).orderBy("date").collect()
    for i, r in enumerate(rows):
        known = [x["sales"] for x in rows[max(0, i - 4):i] if x["sales"] is not None]
        assert r["sales_roll_mean_4"] == (sum(known) / len(known) if known else None)
        assert (r["sales_roll_std_4"] is None) == (len(known) < 2)


def test_calendar_inputs(spark):
    for r in with_inputs(toy_panel(spark, start="2032-12-03", weeks=12)).collect():
        assert (r["year"], r["month"], r["week_of_year"]) == (r["date"].year, r["date"].month, r["date"].isocalendar()[1])


def test_inputs_in_order_and_pairs(spark):
    df = with_inputs(toy_panel(spark, stores=(1, 2), weeks=5), log_sales=False)
    assert model_inputs(df).columns == list(INPUTS) and "log_sales" not in df.columns
    assert model_inputs(df.drop("cpi")).columns == [c for c in INPUTS if c != "cpi"]
    assert with_last_week(df).count() == 8 and len(history_inputs()) == 6


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_for_all_windows(spark):
    assert _plan(with_inputs(toy_panel(spark))).count("Exchange hashpartitioning(store_nbr") == 1


def test_store_table_needs_no_exchange_and_prunes_years(spark, tmp_dir):
    panel = toy_panel(spark, stores=range(1, 30), weeks=120)
    table = write_store_table(panel, "toy_store_table", f"{tmp_dir}/table", buckets=4)
    assert sorted(table.select(*panel.columns).collect()) == sorted(panel.collect())
    plain = table.select(*panel.columns)
    assert "Exchange" not in _plan(with_inputs(plain))
    assert "Exchange" not in _plan(plain.groupBy("store_nbr").agg(F.max("sales")))
    assert sorted(with_inputs(plain).select("store_nbr", "date", "sales_lag_4").collect()) == sorted(
        with_inputs(panel).select("store_nbr", "date", "sales_lag_4").collect())
    part = weeks_between(table, "2032-01-02", "2032-02-27")
    assert part.count() == 9 * 29 and all("year=2032" in f for f in _files(spark, part))
    assert "PartitionFilters: [isnotnull(year" in _plan(part)


def _files(spark, df):
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
