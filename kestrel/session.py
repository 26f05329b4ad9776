"""Session helpers: defaults for local runs, and the shared folder for lineage cuts and job output.

On a cluster the session comes from ``spark-submit``; nothing here overrides what the cluster sets.
Only settings that are still unset get a default.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves (tests, bench). AQE is what keeps the plans honest at
# scale: it coalesces small shuffle partitions, turns joins into broadcasts only when the measured
# side is small, and splits skewed partitions of sort-merge joins.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def cluster_settings(largest_shuffle_bytes: int, executor_memory_bytes: int = 8 << 30,
                     executor_cores: int = 4, executors: int = 1000, stateful_stream: bool = False) -> dict:
    """Settings for a large cluster, to pass to ``spark-submit --conf``.

    ``largest_shuffle_bytes`` is the biggest exchange of the job, not the input: after column
    pruning and the partial aggregate, counting keywords of 100 TB of text shuffles a small
    fraction of it. Each reduce task should fit that share in its part of execution memory
    (about 60% of the heap split over the cores), so spills stay rare; at least 3 tasks per core
    keep every core busy. AQE then coalesces partitions that turn out small and splits skewed ones.
    Scan splits get the same target size. A stateful stream keeps its partition count for the
    life of its checkpoint, and large state goes to RocksDB.
    """
    per_task = max(64 << 20, min(512 << 20, int(executor_memory_bytes * 0.6 / executor_cores)))
    partitions = max(3 * executors * executor_cores, -(-largest_shuffle_bytes // per_task))
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_task // 2),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(per_task // 2),
        "spark.sql.session.timeZone": "UTC",
    }
    if stateful_stream:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    return settings


def get_session(master: str | None = None, app_name: str = "kestrel",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session unchanged, or build one.

    ``LOCAL_DEFAULTS`` fill only settings that were not given at launch (``spark-submit --conf``);
    ``shuffle_partitions`` and ``extra`` are explicit and always apply.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from pyspark import SparkConf

    launched = SparkConf()  # the spark.* settings the launcher passed in
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in LOCAL_DEFAULTS.items():
        if not launched.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]):
    """The session with ``settings`` inside the block; its own come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_dropped(spark: SparkSession):
    """Inside the block a job's shuffle files go when it ends, not whenever the driver's garbage collector finds that
    nothing holds them any more. For jobs whose result is stored or collected; streams started inside keep to it."""
    return settings_of(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def ensure_utc(spark: SparkSession) -> None:
    """Event-time windows and the fixed clock shift are defined on UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system or object store); an unset one is an
    error there. Only in local mode (tests) a folder of our own is made and registered.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store): "
                           "a machine-local folder is not visible to the other executors")
    root = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(root)
    # setCheckpointDir adds a random sub folder; use that one as the root.
    return (sc.getCheckpointDir() or root).rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root, for job output and stream checkpoints."""
    return f"{checkpoint_root(spark)}/kestrel/{name}-{uuid.uuid4().hex[:12]}"
