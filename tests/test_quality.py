import datetime as dt
import os

import pytest

from conftest import toy_panel
from tillpanel.operators.validate import DataValidationError, raise_if_failed, validate_panel
from tillpanel.sources.panel import PANEL_SCHEMA, PanelNotFoundError, load_panel_csv

D0 = dt.date(2010, 2, 5)
GOOD = (1, D0, 100.0, 0, 50.0, 2.5, 200.0, 8.0)


def _report(spark, rows, schema=PANEL_SCHEMA):
    base = [(s, D0 + dt.timedelta(days=7 * i), 100.0, 0, 50.0, 2.5, 200.0, 8.0) for s in (1, 2) for i in range(3)]
    df = spark.createDataFrame(base + rows, schema)
    return {(r["check"], r["column"]): r for r in validate_panel(df).collect()}


def test_clean_panel_passes(spark):
    raise_if_failed(validate_panel(toy_panel(spark, stores=(1, 2, 3))))


@pytest.mark.parametrize("row,key,severity", [
    ((1, None, 100.0, 0, 50.0, 2.5, 200.0, 8.0), ("nulls", "date"), "error"),
    ((3, D0, -5.0, 0, 50.0, 2.5, 200.0, 8.0), ("range", "sales"), "error"),
    ((3, D0, 5.0, 2, 50.0, 2.5, 200.0, 8.0), ("range", "holiday_flag"), "error"),
    ((3, D0, 5.0, 0, 50.0, 2.5, 200.0, -1.0), ("range", "unemployment"), "error"),
    ((3, D0, 5.0, 0, 50.0, 0.0, 200.0, 8.0), ("range", "fuel_price"), "error"),
    ((3, D0, 5.0, 0, 50.0, 2.5, -5.0, 8.0), ("range", "cpi"), "error"),
    ((0, D0, 5.0, 0, 50.0, 2.5, 200.0, 8.0), ("range", "store_nbr"), "error"),
    ((3, D0, 5.0, 0, 200.0, 2.5, 200.0, 8.0), ("range", "temperature"), "warning"),
    ((1, D0, 5.0, 0, 50.0, 2.5, 200.0, 8.0), ("duplicates", "date,store_nbr"), "error"),
])
def test_one_bad_row_per_rule(spark, row, key, severity):
    rep = _report(spark, [row])
    assert key in rep and rep[key]["severity"] == severity and rep[key]["n_bad"] == 1


def test_null_flag_counts_as_invalid(spark):
    rep = _report(spark, [(3, D0, 5.0, None, 50.0, 2.5, 200.0, 8.0)])
    assert rep[("range", "holiday_flag")]["n_bad"] == 1


def test_unbalanced_is_warning_only(spark):
    rep = _report(spark, [(3, D0, 5.0, 0, 50.0, 2.5, 200.0, 8.0)])
    assert rep[("balance", "date")]["severity"] == "warning"


def test_missing_column_reported_and_skipped(spark):
    df = toy_panel(spark).drop("sales")
    rep = {r["check"]: r for r in validate_panel(df).collect()}
    assert rep["schema"]["column"] == "sales"
    with pytest.raises(DataValidationError):
        raise_if_failed(validate_panel(df))


def test_csv_ingest(spark, tmp_dir):
    path = f"{tmp_dir}/weekly_sales.csv"
    with open(path, "w") as fh:
        fh.write("Store,Date,Weekly_Sales,Holiday_Flag,Temperature,Fuel_Price,CPI,Unemployment\n")
        fh.write("1,05-02-2010,1643690.9,0,42.31,2.572,211.0963582,8.106\n")
        fh.write("1,12-02-2010,1641957.44,1,38.51,2.548,211.2421698,8.106\n")
    df = load_panel_csv(spark, path)
    assert df.columns == ["store_nbr", "date", "sales", "holiday_flag", "temperature", "fuel_price", "cpi",
                          "unemployment"]
    rows = df.orderBy("date").collect()
    assert rows[0]["date"] == dt.date(2010, 2, 5) and rows[1]["holiday_flag"] == 1
    assert dict(df.dtypes)["holiday_flag"] == "int"
    with pytest.raises(PanelNotFoundError):
        load_panel_csv(spark, f"{tmp_dir}/missing.csv")


def test_panel_parquet_roundtrip_partitioned(spark, tmp_dir):
    from conftest import toy_panel
    from tillpanel.sources.panel import load_panel, write_panel
    panel = toy_panel(spark, stores=(1, 2), weeks=60)
    write_panel(panel, f"{tmp_dir}/panel")
    back = load_panel(spark, f"{tmp_dir}/panel")
    assert back.drop("year").select(*panel.columns).exceptAll(panel).count() == 0
    # a date filter prunes year partitions
    plan = back.filter("year = 2032")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_file_fingerprint_matches_hashlib(spark):
    import hashlib
    from conftest import SF_SMALL
    from tillpanel.sources.panel import file_fingerprint
    path = f"{SF_SMALL}/supplier.parquet"
    r = file_fingerprint(spark, path).first()
    with open(path, "rb") as fh:
        data = fh.read()
    assert r["sha256"] == hashlib.sha256(data).hexdigest() and r["length"] == len(data)


def test_subset_stores_full_history_pushed_down(spark, tmp_dir):
    from conftest import toy_panel
    from tillpanel.sources.panel import load_panel, subset_stores, write_panel
    panel = toy_panel(spark, stores=(1, 2, 3, 4), weeks=30)
    write_panel(panel, f"{tmp_dir}/p", partition_by_year=False)
    sub = subset_stores(load_panel(spark, f"{tmp_dir}/p"), [1, 3])
    rows = sub.groupBy("store_nbr").count().collect()
    assert {r["store_nbr"]: r["count"] for r in rows} == {1: 30, 3: 30}
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(store_nbr" in plan or "PushedFilters: [Or(" in plan


def test_file_fingerprint_of_large_files_reads_them_by_splits(spark, tmp_dir):
    """no task reads a whole large file; line feeds at the ends, a UTF-8 mark and packed files keep their bytes."""
    import hashlib
    import random

    from tillpanel.sources.panel import file_fingerprint
    noise = random.Random(1).randbytes(400_000)
    contents = {"noise": noise, "ends": noise[:90_000] + b"\n", "twice": b"\n" + noise[:90_000] + b"\n\n", "feeds": b"\n" * 100_000,
                "returns": b"a\r\nb\r" * 20_000, "none": bytes(200_000), "marked": b"\xef\xbb\xbf" + b"a,b\n" * 30_000,
                "packed.gz": noise[:100_000], "small": b"x"}
    os.makedirs(f"{tmp_dir}/files")
    for name, data in contents.items():
        with open(f"{tmp_dir}/files/{name}", "wb") as f:
            f.write(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        found = file_fingerprint(spark, f"{tmp_dir}/files", whole=50_000)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["file"].rsplit("/", 1)[1]: (r["sha256"], r["length"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {name: (hashlib.sha256(data).hexdigest(), len(data)) for name, data in contents.items()}
    assert "LessThanOrEqual(length,50000)" in plan
