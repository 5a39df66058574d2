"""Session construction and shared-storage helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: AQE re-plans joins and coalesces shuffle output at
# run time, skew handling splits hot partitions, session clock is UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app: str = "changeledger", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):      # executors elsewhere must reach the driver by its own address
        conf["spark.driver.bindAddress"] = "127.0.0.1"
        conf["spark.driver.host"] = "127.0.0.1"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[int, str] = {}


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a classic context (Spark Connect)
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only when nothing is configured (local tests) a folder is created.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local"):  # a Connect session's own folders are not the cluster's
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = _LOCAL_FALLBACK.setdefault(id(spark), tempfile.mkdtemp(prefix="changeledger-ckpt-"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "8"))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one job's outputs."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/changeledger/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise a DataFrame as Parquet in the shared checkpoint folder.

    The plan runs once; later readers scan the stored columns (with pruning and
    pushdown), and the files survive the loss of any executor.
    """
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def listing_parallelism(spark: SparkSession, tasks: int | None = None):
    """Bound the number of tasks Spark uses to list many partition folders.

    By default a listing job gets one task per folder (up to 10,000); for a
    date-partitioned landing zone with thousands of tiny day folders, a few
    tasks per core list them far faster.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = tasks or max(8, default_parallelism(spark) * 4)
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(tasks))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
