"""Session settings and the shared working folder.

Everything that must survive executor loss (stream checkpoints, lineage cuts,
versioned tables) lives under the folder the cluster names in
``spark.checkpoint.dir``. We only pick our own folder when that setting is
unset, which happens in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE coalesces small shuffle partitions,
# splits skewed join partitions and turns sort-merge joins into broadcast
# joins only when the measured side is under the threshold below.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Size-checked broadcast: the planner broadcasts a side only when its
    # estimated (static) or measured (AQE) size is under 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions_for(largest_shuffle_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Initial shuffle partitions so the largest shuffle has ~target-sized
    partitions; AQE then coalesces the smaller stages to the advisory size.

    The fact dedupe shuffles roughly the Bronze transactions' width: 100 TB
    of input gives about 400,000 partitions of 256 MB.
    """
    return max(1, -(-largest_shuffle_bytes // target_bytes))


def build_session(
    app: str = "tillroll",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only if unset.

    ``spark.checkpoint.dir`` is a core setting read at start-up (it cannot be
    changed at run time), so the fallback folder is registered with
    ``setCheckpointDir`` instead. That happens in local runs only.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        spark.sparkContext.setCheckpointDir(local)
        path = spark.sparkContext.getCheckpointDir() or local
    return path


def work_path(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path under the shared folder. ``fresh`` adds a unique leaf."""
    base = shared_dir(spark)
    if fresh:
        parts = (*parts, uuid.uuid4().hex[:12])
    sep = "" if base.endswith("/") else "/"
    return base + sep + "/".join(parts) if parts else base
