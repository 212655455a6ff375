"""Structured Streaming forms of the monitoring and scoring jobs.

Sources are file streams (parquet); every query runs with a checkpoint in
the shared checkpoint folder so it restarts where it stopped after a
failure. ``availableNow`` drains what is there and stops (batch-like runs);
``processingTime`` keeps a service running.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillpanel.operators.scoring import PreparedSnapshot, batch_predict
from tillpanel.session import scratch_path
from tillpanel.sources.derived import derive_prediction_log

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_events_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File stream of event parquet files. ``path`` is a directory (new
    files are picked up as they land) or a single file / glob."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if path.endswith(".parquet"):  # a single file: stream it through a glob over its folder
        folder, name = path.rsplit("/", 1)
        r = r.option("basePath", folder)
        path = f"{folder}/{name[:-1]}[{name[-1]}]"
    return r.parquet(path)


def prediction_log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return derive_prediction_log(read_events_stream(spark, path, max_files))


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None):
    """Drain the available input into a memory table (tests, notebooks)."""
    spark = df.sparkSession
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def run_to_table(df: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Drain the available input into a parquet table (executors write it;
    nothing passes through the driver). Complete mode rewrites the table
    with every micro-batch's full result; append/update modes append."""
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":  # every micro-batch carries the full result
            batch.write.mode("overwrite").parquet(f"{path}/batch=0")
        else:  # one folder per micro-batch: a replayed batch overwrites its own output
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (df.writeStream.foreachBatch(write).outputMode(mode)
         .option("checkpointLocation", checkpoint or f"{path}-checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(path).drop("batch") if _has_files(spark, path) else \
        spark.createDataFrame([], df.schema)


def _has_files(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                   interval: str = "1 minute"):
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.outputMode("append").start()


def stream_scoring(requests: DataFrame, snapshot: DataFrame, out_ok: str, out_rejected: str,
                   checkpoint: str, model=None, model_name: str = "naive", available_now: bool = True,
                   cents: bool = True):
    """Score a request stream against the static snapshot; served and
    unknown-store rows go to ``out_ok``, invalid requests to ``out_rejected``.

    ``foreachBatch`` reuses the batch scoring job on every micro-batch
    (stream–static join with the prepared snapshot). Each micro-batch writes its own ``batch=<id>`` folder in
    overwrite mode, so a batch replayed after a failure replaces its output
    instead of duplicating it (exactly-once files).
    """
    if not isinstance(snapshot, PreparedSnapshot):
        snapshot = PreparedSnapshot(snapshot)  # computed once for the life of the stream

    def write(batch: DataFrame, batch_id: int) -> None:
        res = batch_predict(batch, snapshot, model=model, model_name=model_name, cents=cents)
        res = res.persist()
        res.filter(F.col("status") != "invalid").write.mode("overwrite").parquet(f"{out_ok}/batch={batch_id}")
        res.filter(F.col("status") == "invalid").write.mode("overwrite").parquet(f"{out_rejected}/batch={batch_id}")
        res.unpersist()

    w = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


# ---------------------------------------------------------------- alert state machine
ALERT_OUT = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("tick", T.TimestampType()),
    T.StructField("condition", T.BooleanType()),
    T.StructField("pending_since", T.TimestampType()),
    T.StructField("firing", T.BooleanType()),
])
ALERT_STATE = T.StructType([
    T.StructField("pending_since", T.TimestampType()),
    T.StructField("last_tick", T.TimestampType()),
])


def _alert_fn(hold_seconds: float):
    hold = pd.Timedelta(seconds=hold_seconds)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pending, last = (state.get if state.exists else (None, None))
        parts = list(pdfs)
        if not parts:
            return
        ticks = pd.concat(parts).drop_duplicates("tick").sort_values("tick", ignore_index=True)
        if not pd.isna(last):
            ticks = ticks[ticks["tick"] > last].reset_index(drop=True)  # evaluations arrive once; replays are ignored
        if ticks.empty:
            return
        held = ticks["condition"].fillna(False).astype(bool)
        starts = held & ~held.shift(1, fill_value=not pd.isna(pending))
        since = ticks["tick"].where(starts)
        if not pd.isna(pending) and held.iloc[0]:
            since.iloc[0] = pending
        since = since.ffill().where(held)
        state.update((since.iloc[-1] if held.iloc[-1] else None, ticks["tick"].iloc[-1]))
        yield pd.DataFrame({"rule": key[0], "tick": ticks["tick"], "condition": held, "pending_since": since,
                            "firing": (held & (ticks["tick"] - since >= hold)).astype(bool)})

    return fn


def alert_for_stream(conditions: DataFrame, hold_seconds: float) -> DataFrame:
    """Streaming ``alert_for``: per rule, keep (pending since, last tick) in
    state and emit every evaluation with its firing flag (append mode)."""
    return conditions.groupBy("rule").applyInPandasWithState(
        _alert_fn(hold_seconds), ALERT_OUT, ALERT_STATE, "append", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------- event-time streams
def deduplicated(log: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """The log stream with its watermark, each event once.

    An event is known by ``event_id``; one without an id by its whole row.
    The state holds the keys of one watermark, however long the log. Rows
    behind the watermark are dropped here: ``late_rows`` finds them.
    """
    whole = F.when(F.col("event_id").isNull(), F.to_json(F.struct(*log.columns)))
    keyed = log.withColumn("_whole", whole).withWatermark("ts", watermark)
    return keyed.dropDuplicatesWithinWatermark(["event_id", "_whole"]).drop("_whole")


def land_log(log: DataFrame, path: str, watermark: str = "10 minutes", available_now: bool = True,
             interval: str = "1 minute"):
    """Appends every event that is in time, once, to the table ``path/rows`` (exactly-once files)."""
    return run_to_parquet(deduplicated(log, watermark), f"{path}/rows", f"{path}/checkpoint",
                          available_now=available_now, interval=interval)


def late_rows(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Side table of a landed log: the events of the batch ``log`` that came behind the watermark, each once."""
    key = F.when(F.col("event_id").isNull(), F.to_json(F.struct(*log.columns)))
    have = landed.select(*log.columns).select(F.col("event_id").alias("_id"), key.alias("_row"))
    rows = log.withColumn("_whole", key)
    return (rows.join(have, rows["event_id"].eqNullSafe(have["_id"]) & rows["_whole"].eqNullSafe(have["_row"]), "left_anti")
            .dropDuplicates(["event_id", "_whole"]).drop("_whole"))


def monitors() -> dict:
    """Name → windowed monitor of a log stream that already has its watermark."""
    from tillpanel.streaming import monitor as M
    return {
        "prediction_rate": M.prediction_rate,
        "error_rate_by_reason": M.error_rate_by_reason,
        "request_rate_by_status": M.request_rate_by_status,
        "http_error_ratio": M.http_error_ratio,
        "latency_quantiles": M.latency_quantiles,
    }


def start_monitoring(spark: SparkSession, events_path: str, out_dir: str, watermark: str = "10 minutes",
                     available_now: bool = False, interval: str = "1 minute") -> dict:
    """Start the monitoring streams over an events folder.

    Each windowed monitor runs as its own append-mode query over the
    deduplicated log (windows are written once, when closed) into
    ``out_dir/<name>`` with its checkpoint in ``out_dir/_checkpoints``.
    Latency quantiles come from rank sketches, so their state stays bounded.
    Returns name → StreamingQuery.
    """
    out = out_dir.rstrip("/")
    log = deduplicated(prediction_log_stream(spark, events_path), watermark)
    return {name: run_to_parquet(monitor(log), f"{out}/{name}", f"{out}/_checkpoints/{name}",
                                 available_now=available_now, interval=interval)
            for name, monitor in monitors().items()}


def run_to_end(log: DataFrame, ended: DataFrame, monitor, path: str, watermark: str = "10 minutes",
               longest: str = "1 day") -> DataFrame:
    """Every window of a log that has ended, as append-mode results.

    ``log`` is the log as a stream, ``ended`` the same log as a batch.
    Append mode keeps the last windows open, so after the input is drained
    one closing row, ``longest`` beyond the last event, is streamed through
    the same checkpoint: it moves the watermark past every window and, with
    no status, reason or values, counts in none. ``monitor`` gets the
    deduplicated stream. Windows that the closing row itself opens stay open.
    """
    spark = ended.sparkSession
    closing = f"{path}/closing"
    spark.createDataFrame([], ended.schema).write.parquet(closing)

    def drain():
        both = log.unionByName(spark.readStream.schema(ended.schema).parquet(closing))
        df = monitor(deduplicated(both, watermark))
        run_to_parquet(df, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
        return df.schema

    drain()
    end = ended.agg((F.max("ts") + F.expr(f"INTERVAL {longest}")).alias("ts")).filter(F.col("ts").isNotNull())
    end.select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in ended.schema]
               ).write.mode("append").parquet(closing)
    schema = drain()
    return spark.read.schema(schema).parquet(f"{path}/rows")


HEARTBEAT_SCHEMA = "ts TIMESTAMP"
WINDOW_SCHEMA = "window_start TIMESTAMP, window_end TIMESTAMP, n_window BIGINT, condition BOOLEAN"


def with_heartbeats(log: DataFrame, heartbeats: DataFrame) -> DataFrame:
    """The log stream with heartbeat rows: only ``ts`` is set, so they open windows and count in none."""
    return log.unionByName(heartbeats.select(F.col("ts").cast("timestamp").alias("ts")), allowMissingColumns=True)


def no_traffic_stream(log: DataFrame, heartbeats: DataFrame | None = None, lookback: str = "15 minutes",
                      slide: str = "1 minute", watermark: str | None = "20 minutes") -> DataFrame:
    """Streaming no-traffic condition.

    An empty window emits nothing in a stream, so heartbeat rows (at least
    one per slide, e.g. from the scraper or a rate source) belong to the
    log, here or by ``with_heartbeats`` before: every window then exists,
    and counts only served predictions. A log that already has its
    watermark is given ``watermark=None``.
    Output per window: ``window_start, window_end, n_window, condition``.
    """
    both = log if heartbeats is None else with_heartbeats(log, heartbeats)
    if watermark:
        both = both.withWatermark("ts", watermark)
    g = both.groupBy(F.window("ts", lookback, slide)).agg(F.count_if(F.col("http_status") == 200).alias("n_window"))
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "n_window", (F.col("n_window") == 0).alias("condition"))
