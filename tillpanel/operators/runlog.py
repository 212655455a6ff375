"""Run log and model-version tables: lineage tags, incumbent lookup,
promotion gate and staleness rules.

Run log: ``run_id, run_name, model_name, model_type, params MAP<STRING,STRING>,
metrics MAP<STRING,DOUBLE>, tags MAP<STRING,STRING>, started_at TIMESTAMP``.
Versions: ``model_name, version, alias, run_id, created_at, tags MAP<STRING,STRING>``. A version row
with ``alias`` set is an alias move; the latest move per model wins.
"""

from __future__ import annotations

import hashlib

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("started_at", T.TimestampType()),
])
VERSION_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("alias", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
#: versions as they are stored: with the lineage tags of their run
STORED_VERSION_SCHEMA = T.StructType([*VERSION_SCHEMA, T.StructField("tags", T.MapType(T.StringType(), T.StringType()))])

# Staleness defaults (days).
MAX_AGE_DAYS = 7
WARNING_LEAD_DAYS = 2
DAY_SECONDS = 86400.0
GATE_METRIC = "test_rmsle"


def append_run(spark: SparkSession, path: str, rows: list[dict]) -> None:
    spark.createDataFrame(rows, RUN_SCHEMA).write.mode("append").parquet(path)


def append_version(spark: SparkSession, path: str, rows: list[dict]) -> None:
    rows = [{f.name: row.get(f.name) for f in STORED_VERSION_SCHEMA} for row in rows]
    spark.createDataFrame(rows, STORED_VERSION_SCHEMA).write.mode("append").parquet(path)


def claim_version(spark: SparkSession, path: str, model_name: str) -> int:
    """The next version number of a model at ``path``, claimed for the caller alone.

    A claim is an empty file that is created only if it is absent, which the
    shared file system decides for one of several jobs; the others go on to
    the next number. The version is seen once its row is appended; a job that
    fails before leaves a number out.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    key = hashlib.sha256(model_name.encode()).hexdigest()
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}_claims/{key}")
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    taken = [f.getPath().getName() for f in fs.listStatus(folder)]
    version = max((int(n) for n in taken if n.isdigit()), default=0) + 1
    while not _created(fs, jvm.org.apache.hadoop.fs.Path(folder, str(version))):
        version += 1
    return version


def _created(fs, file) -> bool:
    try:
        fs.create(file, False).close()
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_VERSION_SCHEMA).parquet(path)


def tag_lineage(runs: DataFrame, fingerprint: dict) -> DataFrame:
    """Attach data-fingerprint tags (string values) to every run row."""
    kv = []
    for k, v in fingerprint.items():
        kv += [F.lit(str(k)), F.lit(None if v is None else str(v)).cast("string")]
    return runs.withColumn("tags", F.map_concat(F.coalesce("tags", F.create_map().cast("map<string,string>")),
                                                F.create_map(*kv)))


def panel_fingerprint(panel: DataFrame) -> dict:
    """rows / first / last week / stores of a panel (one small action)."""
    r = panel.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("min_date"),
                  F.max("date").alias("max_date"), F.count_distinct("store_nbr").alias("n_stores")).first()
    return {"raw_data_rows": r["rows"], "raw_data_min_date": r["min_date"],
            "raw_data_max_date": r["max_date"], "raw_data_n_stores": r["n_stores"]}


def current_alias(versions: DataFrame, alias: str = "production") -> DataFrame:
    """Per model: the version the alias points to (latest move wins)."""
    moves = versions.filter(F.col("alias") == alias)
    last = moves.groupBy("model_name").agg(F.max_by(
        F.struct("version", "run_id", "created_at"), F.struct("created_at", "version")).alias("_v"))
    return last.select("model_name", "_v.version", "_v.run_id", "_v.created_at")


def incumbent_of(versions: DataFrame, runs: DataFrame, alias: str = "production",
                 metric: str = GATE_METRIC) -> DataFrame:
    """Aliased version per model with its run's gate metric (null if absent).

    The incumbent table has one row per model: broadcast if the planner finds it small,
    so the (large) run log is scanned once and never shuffled.
    """
    cur = current_alias(versions, alias)
    r = runs.select("run_id", F.element_at("metrics", F.lit(metric)).alias(f"incumbent_{metric}"))
    # inner broadcast join keeps the run log unshuffled; the outer join is small × small
    matched = r.join(cur.select("run_id"), "run_id")
    return cur.join(matched, "run_id", "left")


def quality_gate(candidates: DataFrame, incumbents: DataFrame, register: bool = True,
                 metric: str = GATE_METRIC) -> DataFrame:
    """Promote iff no incumbent metric, or candidate ≤ incumbent (ties pass).

    A NaN on either side rejects when an incumbent exists; with
    ``register=False`` the gate is off and every candidate passes.
    """
    inc = incumbents.select("model_name", F.col(f"incumbent_{metric}"))
    j = candidates.join(inc, "model_name", "left")
    cand, prod = F.col(f"candidate_{metric}"), F.col(f"incumbent_{metric}")
    ok = prod.isNull() | (~F.isnan(cand) & ~F.isnan(prod) & (cand <= prod))
    if not register:
        ok = F.lit(True)
    return j.withColumn("gate_passed", F.coalesce(ok, F.lit(False)))


def latest_runs(runs: DataFrame, metric: str = GATE_METRIC) -> DataFrame:
    """Per model the most recent run and its metric (candidate for the gate)."""
    last = runs.groupBy("model_name").agg(F.max_by(
        F.struct("run_id", F.element_at("metrics", F.lit(metric)).alias("m")),
        F.struct("started_at", "run_id")).alias("_r"))
    return last.select("model_name", F.col("_r.run_id").alias("run_id"),
                       F.col("_r.m").alias(f"candidate_{metric}"))


def best_candidate(runs: DataFrame, score: str = "cv_mean_rmsle") -> DataFrame:
    """Per model the run with the lowest score; NaN never wins; ties → lower id."""
    s = F.element_at("metrics", F.lit(score))
    ok = runs.filter(s.isNotNull() & ~F.isnan(s))
    return ok.groupBy("model_name").agg(
        F.min_by(F.col("run_id"), F.struct(s, F.col("run_id"))).alias("best_run_id"),
        F.min(s).alias(f"best_{score}"))


def model_age(versions: DataFrame, now, alias: str = "production") -> DataFrame:
    """Per model: seconds and days since the version aliased *as of now*
    was created (alias moves after ``now`` are not seen yet)."""
    now_c = F.lit(now).cast("timestamp") if not hasattr(now, "_jc") else now
    cur = current_alias(versions.filter(F.col("created_at") <= now_c), alias)
    secs = F.unix_micros(now_c).cast("double") / 1e6 - F.unix_micros("created_at").cast("double") / 1e6
    return cur.select("model_name", "version", "created_at", secs.alias("age_seconds"),
                      (secs / F.lit(DAY_SECONDS)).alias("age_days"))


def retrain_due(age_seconds, max_age_days: int = MAX_AGE_DAYS):
    """No model (null age) or age ≥ limit (inclusive)."""
    return F.coalesce(age_seconds >= F.lit(max_age_days * DAY_SECONDS), F.lit(True))


def approaching_staleness(age_seconds, max_age_days: int = MAX_AGE_DAYS,
                          lead_days: int = WARNING_LEAD_DAYS):
    """Not due yet, but within ``lead_days`` of the limit; never for no model."""
    return (age_seconds.isNotNull() & ~retrain_due(age_seconds, max_age_days)
            & (age_seconds >= F.lit((max_age_days - lead_days) * DAY_SECONDS)))


def staleness_status(models: DataFrame, versions: DataFrame, now, max_age_days: int = MAX_AGE_DAYS,
                     lead_days: int = WARNING_LEAD_DAYS, alias: str = "production") -> DataFrame:
    """fresh / approaching / due per model name (models without an aliased
    version are due), with days left before the limit."""
    ages = model_age(versions, now, alias)
    j = models.select("model_name").distinct().join(ages, "model_name", "left")
    a = F.col("age_seconds")
    due, near = retrain_due(a, max_age_days), approaching_staleness(a, max_age_days, lead_days)
    return j.select(
        "model_name", "version", "age_days",
        due.alias("due"), near.alias("approaching"),
        F.when(due, "due").when(near, "approaching").otherwise("fresh").alias("status"),
        F.when(~due, F.lit(float(max_age_days)) - F.col("age_days")).alias("days_left"),
    )
