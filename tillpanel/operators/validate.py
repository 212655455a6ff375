"""Data-quality checks on a panel, as one report DataFrame.

Report schema: ``severity, check, column, n_bad, message`` — one row per
failed check. Errors block training, warnings do not. All rules are
evaluated in one pass: a ``groupBy(store_nbr, date)`` carrying every null and
range count, then per store, then one row. Checks on absent columns are
skipped (the schema check reports them). Weeks per store count distinct
non-null dates (a store with none counts 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpanel.sources.panel import PANEL_COLUMNS

REQUIRED_COLUMNS = ["date", "store_nbr", "sales", "holiday_flag", "temperature",
                    "fuel_price", "cpi", "unemployment"]
KEY_COLUMNS = ["date", "store_nbr"]

# Temperature plausibility bounds (Fahrenheit, warning only).
TEMP_LOW, TEMP_HIGH = -30.0, 130.0


def _message(check: str, column: str, n_bad):
    """Report text from what the row already says."""
    return F.concat(F.lit(f"{check} check on {column}: "), n_bad.cast("string"), F.lit(" rows"))


REPORT_SCHEMA = T.StructType([
    T.StructField("severity", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("message", T.StringType()),
])


class DataValidationError(ValueError):
    """Raised when a report holds at least one error."""


def _range_rules(cols: set[str]):
    """(column, severity, predicate-of-bad) for present columns.

    A null never breaks a comparison rule, except the flag rule, where a
    missing flag is not in {0, 1}.
    """
    c = F.col
    preds = {
        "sales": ("error", lambda: c("sales") < 0),
        "holiday_flag": ("error", lambda: ~F.coalesce(c("holiday_flag").isin(0, 1), F.lit(False))),
        "unemployment": ("error", lambda: c("unemployment") < 0),
        "fuel_price": ("error", lambda: c("fuel_price") <= 0),
        "cpi": ("error", lambda: c("cpi") <= 0),
        "store_nbr": ("error", lambda: c("store_nbr") < 1),
        "temperature": ("warning", lambda: (c("temperature") < TEMP_LOW) | (c("temperature") > TEMP_HIGH)),
    }
    return [(col, sev, pred()) for col, (sev, pred) in preds.items() if col in cols]


def _rows(df: DataFrame, entries):
    """Turn (severity, check, column, n_bad column, message column) into report rows."""
    structs = [F.struct(F.lit(s).alias("severity"), F.lit(k).alias("check"), F.lit(col).alias("column"),
                        n.cast("long").alias("n_bad"), m.alias("message"))
               for s, k, col, n, m in entries]
    return (df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
            .filter(F.col("n_bad") > 0))


def validate_panel(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    spark = df.sparkSession
    cols = set(df.columns)
    parts = []
    missing = [c for c in required if c not in cols]
    if missing:
        parts.append(spark.createDataFrame(
            [("error", "schema", ",".join(missing), len(missing),
              f"schema check: absent {', '.join(missing)}")], REPORT_SCHEMA))

    # nulls + ranges (+ duplicates and balance): every count is additive, so
    # with key columns present they ride on the groupBy(store, date) that the
    # duplicate and balance checks need anyway: one scan of the input.
    null_cols = [c for c in required if c in cols]
    rules = _range_rules(cols)
    counts = [F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in null_cols]
    counts += [F.count_if(pred).alias(f"range__{col}") for col, _, pred in rules]
    entries = [("error", "nulls", c, F.col(f"null__{c}"),
                _message("nulls", c, F.col(f"null__{c}")))
               for c in null_cols]
    entries += [(sev, "range", col, F.col(f"range__{col}"),
                 _message("range", col, F.col(f"range__{col}")))
                for col, sev, _ in rules]
    keyed = all(k in cols for k in KEY_COLUMNS)
    if not keyed:
        if counts:
            parts.append(_rows(df.agg(*counts), entries))
    else:
        # one linear chain (no branches → one scan): (store, date) → store → one row
        per_key = df.groupBy("store_nbr", "date").agg(F.count(F.lit(1)).alias("_n"), *counts)
        cnt_cols = per_key.columns[3:]
        per_store = per_key.groupBy("store_nbr").agg(
            *[F.sum(c).alias(c) for c in cnt_cols],
            F.sum(F.col("_n") - 1).alias("_dupes"),
            F.count_if(F.col("date").isNotNull()).alias("_weeks"))
        weeks = F.when(F.col("store_nbr").isNotNull(), F.col("_weeks"))
        one = per_store.agg(
            *[F.sum(c).alias(c) for c in cnt_cols],
            F.coalesce(F.sum("_dupes"), F.lit(0)).alias("n_dupes"),
            F.min(weeks).alias("lo"), F.max(weeks).alias("hi"), F.count_distinct(weeks).alias("k"))
        entries.append(("error", "duplicates", ",".join(KEY_COLUMNS), F.col("n_dupes"),
                        _message("duplicates", "+".join(KEY_COLUMNS), F.col("n_dupes"))))
        entries.append(("warning", "balance", "date",
                        F.when(F.col("k") > 1, F.col("hi") - F.col("lo")).otherwise(0),
                        F.format_string("balance check: stores have %d to %d weeks", F.col("lo"), F.col("hi"))))
        parts.append(_rows(one, entries))
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_if_failed(report: DataFrame) -> None:
    """Driver action: fetch only the error rows (few) and raise when any."""
    errors = [r["message"] for r in report.filter(F.col("severity") == "error").collect()]
    if errors:
        raise DataValidationError("; ".join(errors))


def quarantine(df: DataFrame) -> DataFrame:
    """Per-row variant: every row with the array of rule names it breaks."""
    cols = set(df.columns)
    checks = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in REQUIRED_COLUMNS if c in cols]
    checks += [F.when(pred, F.lit(f"{sev}_{col}")) for col, sev, pred in _range_rules(cols)]
    return df.withColumn("violations", F.array_compact(F.array(*checks)))


def lineitem_feed(spark, sf_dir) -> DataFrame:
    """Unaggregated feed in panel columns (one row per line item).

    Used to exercise the checks on a feed that really has duplicates
    (many lines per store-week), store 0 (nation 0) and zero tax.
    """
    from tillpanel.functions.calendar import is_major_holiday_week, week_ending_friday
    from tillpanel.sources.panel import read_table
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    d = week_ending_friday(F.to_date("l_shipdate"))
    return li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").cast("int").alias("store_nbr"),
        d.alias("date"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("sales"),
        is_major_holiday_week(d).alias("holiday_flag"),
        F.col("l_quantity").alias("temperature"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("fuel_price"),
        (F.col("l_tax") * F.lit(100.0)).alias("cpi"),
        (F.col("l_discount") * F.lit(100.0)).alias("unemployment"),
    ).select(*PANEL_COLUMNS)
