"""Session helpers: UTC time zone, shared work folder, sizing defaults."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC_CONF = "spark.sql.session.timeZone"
CHECKPOINT_CONF = "spark.checkpoint.dir"


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All time arithmetic (unix_micros, day buckets, windows) assumes UTC."""
    if spark.conf.get(UTC_CONF, None) != "UTC":
        spark.conf.set(UTC_CONF, "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Control tables, written intermediate tables and stream checkpoints live
    below it, so they survive the loss of any executor.  Only when the
    setting is absent (tests, local runs) a private folder is created and
    registered, once per application.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="tidemark-")  # local mode only (tests)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)  # remembered by the context; the setting itself is static
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new location for an intermediate table, in a folder of the
    application that the file system removes when the application ends
    (results are evaluated lazily and may read it until then)."""
    root = f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session used by tests and the bench (local mode)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config(UTC_CONF, "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Spark settings sized for a run over ``input_bytes`` on a cluster.

    Shuffle partitions: enough that each holds about ``target_partition_bytes``
    (so sorts and aggregates of one partition fit an executor core's share of
    memory without spilling), and at least 2 waves of the cluster's cores;
    AQE then coalesces small partitions and splits skewed ones at run time.
    Input splits of 256 MB keep the scan task count in the same range."""
    cores = max(1, executors * cores_per_executor)
    by_volume = -(-int(input_bytes) // target_partition_bytes)
    partitions = max(2 * cores, by_volume)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.session.timeZone": "UTC",
    }
