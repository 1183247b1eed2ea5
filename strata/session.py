"""Session construction and shared-storage helpers."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps are NTZ anyway),
# AQE for runtime re-planning (coalescing, skew splits, broadcast conversion).
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(
    master: str | None = None,
    *,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the lake defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only when nothing is
    configured (local tests) is a private folder created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor "
            "can reach (HDFS / object store) before running lake jobs"
        )
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def shared_scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint location for one run."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/strata/{purpose}-{uuid.uuid4().hex[:12]}"


_CONF_LOCK = threading.RLock()


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Temporarily apply session settings (restored afterwards).

    Held under a process-wide lock: two threads writing through one session
    must not restore each other's settings (e.g. the overwrite mode) mid-job.
    """
    with _CONF_LOCK:
        previous = {k: spark.conf.get(k, None) for k in settings}
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in previous.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def scale_settings(
    input_bytes: int,
    *,
    total_cores: int,
    partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Session settings sized to the input (pass to ``build_session(conf=…)``).

    The initial shuffle width is input / partition size (at least three
    waves of the cluster's cores); AQE then coalesces small partitions and
    splits skewed ones at runtime, so every task handles about
    ``partition_bytes`` and spills stay bounded. Example: 100 TB on 8,000
    cores → ~400,000 initial shuffle partitions, scan splits of 256 MiB.
    """
    width = max(total_cores * 3, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * partition_bytes // (1024 * 1024)}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def apply_scale(spark: SparkSession, inputs: list[str]) -> dict[str, str]:
    """Set this session's shuffle width and split sizes from the bytes under
    ``inputs`` (files or folders; sizes from the file system's listing)."""
    from strata.sources import storage

    total = sum(storage.size(spark, path) for path in inputs)
    settings = scale_settings(total, total_cores=max(1, spark.sparkContext.defaultParallelism))
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings
