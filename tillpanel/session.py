"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings this library relies on; anything already set on the
# session (cluster defaults, spark-submit flags) wins over these.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tillpanel", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared filesystem / object store path).
    Only when it is unset and the master is this machine's (``local``, tests)
    a private folder is created.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="tillpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/tillpanel/{name}-{uuid.uuid4().hex}"
