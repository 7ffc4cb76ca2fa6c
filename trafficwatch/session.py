"""Session helpers: the confs every job here relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    # Windows, dates and alert keys are rendered in UTC (cast to string, to_date).
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster sizing for large inputs (e.g. a 1000-executor job over ~100 TB):
# partitions are sized by bytes, not by count.  AQE starts from many shuffle
# partitions and coalesces them to ~256 MB each, splits skewed join
# partitions, and only broadcasts a join side it has measured below the
# threshold at runtime.  Scan splits of 256 MB keep a task's input bounded.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


# Streams keep one state store per shuffle partition, fixed by the first
# checkpoint: as many as the executors' cores, not as a batch job's shuffle.
STREAM_CONF = {"spark.sql.shuffle.partitions": "400"}


def cluster_session(app_name: str = "trafficwatch", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for cluster runs: CLUSTER_CONF plus ``extra``; master from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "trafficwatch",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Alert keys, JSON and dates are defined in UTC; pin it on the session."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a
    local master gets ``fallback``, or a new folder of its own; on a cluster
    it is an error, since executors don't share a machine's own folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/trafficwatch-{uuid.uuid4().hex}/{tag}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, so a lost executor never recomputes it."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``trafficwatch`` importable in Python workers (once per application).

    Operators that run Python inside tasks (``applyInArrow``,
    ``mapInArrow``) pickle functions by module reference, so the
    executors need the package - the ``--py-files`` mechanism, done lazily.
    A deployment that already ships the package may skip this.
    """
    import shutil

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="trafficwatch-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(staging, "trafficwatch"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="trafficwatch"
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
