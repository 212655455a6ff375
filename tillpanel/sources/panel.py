"""The store × week sales panel: schema, readers, the derived test panel.

Canonical panel schema (one row per store and week-ending Friday):
``store_nbr INT, date DATE, sales DOUBLE, holiday_flag INT, temperature DOUBLE,
fuel_price DOUBLE, cpi DOUBLE, unemployment DOUBLE``.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tillpanel.functions.calendar import is_major_holiday_week, week_ending_friday
from tillpanel.functions.digest import UTF8_MARK, Sha256
from tillpanel.functions.metrics import nan_to_null

# Raw CSV column names → panel column names, and date format.
RAW_COLUMN_RENAME = {
    "Store": "store_nbr",
    "Date": "date",
    "Weekly_Sales": "sales",
    "Holiday_Flag": "holiday_flag",
    "Temperature": "temperature",
    "Fuel_Price": "fuel_price",
    "CPI": "cpi",
    "Unemployment": "unemployment",
}
RAW_DATE_FORMAT = "dd-MM-yyyy"

PANEL_COLUMNS = ["store_nbr", "date", "sales", "holiday_flag", "temperature",
                 "fuel_price", "cpi", "unemployment"]
MEASURES = ["sales", "temperature", "fuel_price", "cpi", "unemployment"]

PANEL_SCHEMA = T.StructType([
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("holiday_flag", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("fuel_price", T.DoubleType()),
    T.StructField("cpi", T.DoubleType()),
    T.StructField("unemployment", T.DoubleType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Weekly_Sales", T.DoubleType()),
    T.StructField("Holiday_Flag", T.IntegerType()),
    T.StructField("Temperature", T.DoubleType()),
    T.StructField("Fuel_Price", T.DoubleType()),
    T.StructField("CPI", T.DoubleType()),
    T.StructField("Unemployment", T.DoubleType()),
])


class PanelNotFoundError(FileNotFoundError):
    """The panel input does not exist."""


def _read_or_raise(reader, path: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise PanelNotFoundError(f"Missing panel input {path}") from exc
        raise


def normalize_panel(df: DataFrame) -> DataFrame:
    """NaN → null on measures so every check sees one kind of missing."""
    return df.withColumns({c: nan_to_null(F.col(c)) for c in MEASURES if c in df.columns})


def load_panel_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw weekly CSV (``Store, Date dd-MM-yyyy, Weekly_Sales, …``) → panel.

    Unparsable dates become null (reported by validation, not raised).
    Row order is left to consumers; every window orders by date itself.
    """
    raw = _read_or_raise(
        lambda p: spark.read.schema(RAW_SCHEMA).option("header", True).csv(p), path)
    df = raw.withColumnsRenamed(RAW_COLUMN_RENAME)
    df = df.withColumn("date", F.try_to_date(F.col("date"), RAW_DATE_FORMAT))
    return normalize_panel(df.select(*PANEL_COLUMNS))


def load_panel(spark: SparkSession, path: str) -> DataFrame:
    """Parquet twin of :func:`load_panel_csv` (already renamed and typed)."""
    df = _read_or_raise(spark.read.parquet, path)
    return normalize_panel(df)


def write_panel(df: DataFrame, path: str, partition_by_year: bool = True) -> None:
    """Persist a panel; partitioned by year so date filters prune files."""
    w = df.withColumn("year", F.year("date")) if partition_by_year else df
    writer = w.write.mode("overwrite")
    if partition_by_year:
        writer = writer.partitionBy("year")
    writer.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store × week panel derived from the driver's ``lineitem`` and ``supplier``.

    store = supplier nation + 1; week = Friday closing the ship date's
    Saturday-to-Friday week; sales = Σ extendedprice·(1−discount); proxies:
    temperature = avg quantity, fuel_price = avg extendedprice / 1000,
    cpi = Σ extendedprice / Σ quantity, unemployment = 100 · avg discount.
    Sums are exact (integer cents / hundredths summed as BIGINT, overflow
    raises under ANSI) so the result does not depend on summation order;
    each exact sum is converted to double once before dividing.

    Plan: the lineitem scan reads five columns; the supplier side is a
    two-column lookup, broadcast or shuffled as its bytes decide, where
    adaptive execution splits hot suppliers; the
    aggregate is partial (map-side) + final on (store, week), so only
    stores × weeks partial rows per task are shuffled, whatever the skew.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Money in whole cents and discount in hundredths (the source's precision):
    # per row only long arithmetic; each group's exact sum becomes DECIMAL once.
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    disc = F.rint(F.col("l_discount") * 100).cast("long")
    qty = F.rint(F.col("l_quantity") * 100).cast("long")
    agg = (
        li.join(su, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            (F.col("s_nationkey") + 1).cast("int").alias("store_nbr"),
            week_ending_friday(F.to_date("l_shipdate")).alias("date"),
        )
        .agg(
            F.sum(cents * (F.lit(100) - disc)).alias("_sales_e4"),
            F.count(F.lit(1)).alias("_n"),
            F.sum(qty).alias("_qty_e2"),
            F.sum(cents).alias("_price_e2"),
            F.sum(disc).alias("_disc_e2"),
        )
    )

    def exact(c, digits):
        return (F.col(c).cast("decimal(38,0)") / F.lit(10 ** digits)).cast("double")

    agg = agg.select("store_nbr", "date", "_n", exact("_sales_e4", 4).alias("sales"), exact("_qty_e2", 2).alias("_qty"),
                     exact("_price_e2", 2).alias("_price"), exact("_disc_e2", 2).alias("_disc"))
    return agg.select(
        "store_nbr",
        "date",
        "sales",
        is_major_holiday_week(F.col("date")).alias("holiday_flag"),
        (F.col("_qty") / F.col("_n")).alias("temperature"),
        (F.col("_price") / F.col("_n") / F.lit(1000.0)).alias("fuel_price"),
        (F.col("_price") / F.col("_qty")).alias("cpi"),
        (F.lit(100.0) * (F.col("_disc") / F.col("_n"))).alias("unemployment"),
    )


def subset_stores(df: DataFrame, store_ids) -> DataFrame:
    """Small panel with the full history of the given stores (pushed to the scan)."""
    return df.filter(F.col("store_nbr").isin(list(store_ids)))


def densify_panel(df: DataFrame, fill_sales: float | None = None) -> DataFrame:
    """Complete store × week grid between the panel's first and last Friday.

    Missing weeks get ``sales = fill_sales`` (null by default) and null
    indicators, so that row lags equal week lags. The spine is built per
    store from its own first/last week (no cross product of stores × dates).
    """
    bounds = df.groupBy("store_nbr").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    gmin = F.min("_lo").over(_all())
    gmax = F.max("_hi").over(_all())
    spine = (
        bounds.select("store_nbr", gmin.alias("_lo"), gmax.alias("_hi"))
        .select("store_nbr", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 7 DAYS"))).alias("date"))
    )
    out = spine.join(df, ["store_nbr", "date"], "left")
    out = out.withColumn("holiday_flag", F.coalesce("holiday_flag", is_major_holiday_week(F.col("date"))))
    if fill_sales is not None:
        out = out.withColumn("sales", F.coalesce("sales", F.lit(float(fill_sales))))
    return out.select(*[c for c in PANEL_COLUMNS if c in out.columns])


def _all():
    from pyspark.sql import Window
    return Window.partitionBy()


def panel_profile(df: DataFrame) -> DataFrame:
    """rows, first/last week and distinct stores in one aggregation."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("store_nbr").alias("n_stores"),
    )


#: files of at most so many bytes are hashed in one piece
WHOLE_FILE = 64 << 20
#: files with these endings are unpacked by Spark's line reader, so their bytes are only seen whole
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")


def _joined_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a split as stretches of its bytes, each with the place where the split begins."""
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([b.column("at").slice(0, 1), pa.array([b"\n".join(b.column("line").to_pylist())], pa.binary())],
                                             ["at", "data"])


def _sha256_by_splits(spark: SparkSession, path: str, length: int, head: bytes = b"") -> str:
    """SHA-256 of one file's bytes, of which no task reads more than one split.

    The digest takes the bytes in order, so the splits are read one after another, and each task hands its
    state on to the next. Spark's line reader cuts a file of any content at line feeds; each split ends with
    the line in which its last byte lies. ``head``: bytes that the reader leaves out at the beginning.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_block_start").alias("at"), F.col("value").cast("binary").alias("line"))
    splits = lines.mapInArrow(_joined_lines, "at long, data binary").rdd
    state, n, last = b"", -1, -1  # n of -1: nothing read yet, so no line feed is due

    def advance(state: bytes, n: int):
        def run(rows):
            digest, size, at = Sha256(state), n, []
            for r in rows:
                at.append(r["at"])
                for part in ((b"\n" if size >= 0 else head), bytes(r["data"])):
                    digest.update(part)
                    size = max(size, 0) + len(part)
            yield digest.state(), size, min(at, default=None), max(at, default=None)
        return run

    for k in range(splits.getNumPartitions()):
        (state, n, first, newest), = spark.sparkContext.runJob(splits, advance(state, n), [k])
        if first is not None:
            if first < last:
                raise ValueError(f"splits of {path} are not in the order of their bytes")
            last = newest
    digest, n = Sha256(state), max(n, 0)
    if n == length - 1:  # the reader does not tell whether the last line ends with a line feed
        digest.update(b"\n")
        n += 1
    if n != length:
        if not head:
            return _sha256_by_splits(spark, path, length, UTF8_MARK)
        raise ValueError(f"{path}: {n} of {length} bytes read")
    return digest.hexdigest()


def file_fingerprint(spark: SparkSession, path: str, whole: int = WHOLE_FILE, parallelism: int = 8) -> DataFrame:
    """SHA-256 of the raw bytes of every file under ``path`` (one row per file).

    Files of more than ``whole`` bytes are read split by split when this is called, ``parallelism`` files at a time.
    """
    def hashed(files: DataFrame) -> DataFrame:
        return files.select(F.col("path").alias("file"), F.sha2(F.col("content"), 256).alias("sha256"), F.col("length"))

    files = spark.read.format("binaryFile").load(path)
    large = [tuple(r) for r in files.filter(F.col("length") > whole).select("path", "length").collect()]
    if not large:
        return hashed(files)
    found = hashed(files.filter(F.col("length") <= whole))  # pushed down, so larger files are not opened
    packed = [f for f, _ in large if f.lower().endswith(PACKED)]
    if packed:
        found = found.unionAll(hashed(spark.read.format("binaryFile").load(packed)))
    plain = [(f, n) for f, n in large if f not in packed]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        digests = pool.map(lambda f: _sha256_by_splits(spark, *f), plain)
        rows = [(f, digest, n) for (f, n), digest in zip(plain, digests, strict=True)]
    return found.unionAll(spark.createDataFrame(rows, found.schema))


def write_store_table(panel: DataFrame, name: str, path: str, buckets: int | None = None) -> DataFrame:
    """The panel as table ``name`` at ``path``: bucketed by store, partitioned by year, weeks in order.

    A store's weeks lie in one bucket, so windows and aggregates per store
    need no Exchange, and a filter on ``year`` reads that year's files only
    (see ``weeks_between``). Rows are spread by the bucket's own hash before
    writing: buckets x years files, none of them in pieces. A store with a
    large share of the rows has one row per week here, like any other.
    """
    spark = panel.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = panel.withColumn("year", F.year("date")).repartition(n, "store_nbr")
    (rows.write.mode("overwrite").option("path", path).partitionBy("year")
     .bucketBy(n, "store_nbr").sortBy("store_nbr", "date").saveAsTable(name))
    return spark.table(name)


def weeks_between(panel: DataFrame, first, last) -> DataFrame:
    """Weeks from ``first`` to ``last`` (dates, both included); reads only their years of a table partitioned by year."""
    days = [F.lit(d).cast("date") for d in (first, last)]
    out = panel.filter(F.col("date").between(*days))
    return out.filter(F.col("year").between(*[F.year(d) for d in days])) if "year" in panel.columns else out


def input_state(spark: SparkSession, sf_dir: str, *tables: str) -> tuple:
    """Files of the tables with size and time of change (their content is not read)."""
    names = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]
    files = spark.read.format("binaryFile").load(names).select("path", "length", "modificationTime")
    return tuple(sorted(map(tuple, files.collect())))


_MATERIALIZED: dict = {}


def panel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived panel, written once per session and state of its input
    under the shared checkpoint folder, and read back by every later query.

    Materializing cuts the lineage to the raw scan (later jobs neither
    rescan ``lineitem`` nor depend on executors that held it), gives the
    panel real file statistics for the planner, and keeps the weeks of a
    store together (``write_store_table``).
    """
    from tillpanel.session import scratch_path
    key = (spark.sparkContext.applicationId, input_state(spark, sf_dir, "lineitem", "supplier"))
    name = _MATERIALIZED.get(key)
    if name is None or not spark.catalog.tableExists(name):
        path = scratch_path(spark, "panel")
        name = f"tillpanel_panel_{path.rsplit('-', 1)[1]}"
        write_store_table(weekly_panel(spark, sf_dir), name, path)
        _MATERIALIZED[key] = name
    return spark.table(name).select(*PANEL_SCHEMA.fieldNames())


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free content hash of a table: row count and the exact (DECIMAL)
    sum of a 64-bit hash of every row. Independent of file layout and
    partitioning; used for inputs whose files are too large to hash as
    bytes (``binaryFile`` loads a whole file per row)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).cast("string").alias("content_hash"))
