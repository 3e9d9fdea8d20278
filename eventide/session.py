"""SparkSession construction and cluster-aware settings.

On a cluster the session is created by the platform; ``get_session`` only fills in
settings that are unset, so a cluster's own ``spark.checkpoint.dir`` or shuffle sizing
always wins.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on. They apply unless the launch configuration (cluster
# config, spark-submit --conf) names the key itself.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Broadcast only sizes that are proven: no broadcast from planner estimates; explicit
    # hints come after a bounded count (operators.joins), and AQE may still broadcast a
    # side whose shuffle output it has measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Streaming session windows: merge sessions inside each partition before the shuffle
    # (pre-aggregation for hot keys).
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Partial (map-side) window group limit before the shuffle for top-N-per-key.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches of documents: a few MB instead of tens, in the JVM's buffers and in Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, app_name: str = "eventide",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one.

    Only keys that the launch configuration (spark-submit, cluster defaults) leaves unset are
    filled. Loopback addresses, the driver's memory, a small number of shuffle partitions and a
    scratch checkpoint folder are for local masters only.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active)
        return active
    from pyspark import SparkConf

    launch = SparkConf()  # what spark-submit or the environment set
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf.update({"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    if (master or launch.get("spark.master", "")).startswith("local"):
        conf.update({
            "spark.driver.memory": os.environ.get("EVENTIDE_DRIVER_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.checkpoint.dir": "",
        })
    conf = {k: v for k, v in conf.items() if not launch.contains(k)}
    if conf.get("spark.checkpoint.dir") == "":
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="eventide-ckpt-")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


_APPLIED = "spark.eventide.defaults"


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL defaults the library relies on, once per session.

    A key named in the launch configuration wins (the cluster knows better), and what the user
    sets in the session afterwards stays. The session time zone is an exception: results are
    defined in UTC and another zone would shift dates.
    """
    if spark.conf.get(_APPLIED, None):
        return
    launch = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if k == "spark.sql.session.timeZone" or not launch.contains(k):
            spark.conf.set(k, v)
    spark.conf.set(_APPLIED, "1")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session without it (a test)
    gets a scratch folder; on a cluster a missing setting is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="eventide-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package: Spark sends them its source (once for each
    application), so executors need no copy of the repository."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[0]
    path = f"{tempfile.mkdtemp(prefix='eventide-src-')}/{root.name}-src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session for caches of DataFrames built on it: the application id
    changes when a session is stopped and another one started (``id()`` may be reused)."""
    return (spark.sparkContext.applicationId, id(spark))
