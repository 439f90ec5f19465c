"""SparkSession construction and the shared scratch location.

Intermediate tables (layer writes, CSV round trips, stream checkpoints) go to
the shared folder the cluster names in ``spark.checkpoint.dir``; a local
folder is created only when that setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session this package creates itself. On a cluster the
# deployment's own settings win; these only fill gaps.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (~100 TB of raw orders). Pass as
# ``extra_conf`` or put in the deployment's defaults; nothing here is required.
CLUSTER_CONF: dict[str, str] = {
    # ~512 MB input splits: ~200k scan tasks for 100 TB instead of ~800k.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Gold/summary shuffles carry (map tasks x keys) rows; AQE coalesces them.
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Layers are written once and read many times: smaller files pay off.
    "spark.sql.parquet.compression.codec": "zstd",
    # Task retries before a job fails (lost executors are retried anyway).
    "spark.task.maxFailures": "8",
    # Mid-sized inputs still split into >= 2 tasks per core (set to 2 x total
    # cores): with about 1.5 tasks per core, the last wave leaves half idle.
    "spark.sql.files.minPartitionNum": "8000",
}

# Input splits per core when this package creates a local session.
SPLITS_PER_CORE = 2


def _local_cores(master: str | None) -> int | None:
    m = re.fullmatch(r"local\[(\d+|\*)(?:,\d+)?\]", master or "")
    if not m:
        return None
    return os.cpu_count() or 1 if m.group(1) == "*" else int(m.group(1))


def get_session(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with ANSI on and AQE enabled."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    cores = _local_cores(master)
    if cores:
        conf["spark.sql.files.minPartitionNum"] = str(SPLITS_PER_CORE * cores)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and
    the master is local (tests, laptops) a temporary folder is created and registered as the
    checkpoint directory, so ``DataFrame.checkpoint()`` and our scratch
    writes land in the same place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all hosts share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-checkpoint-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex}"
