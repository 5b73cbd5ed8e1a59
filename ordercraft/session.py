"""Session helpers for local runs (tests, bench) and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ordercraft") -> SparkSession:
    """A local session configured like the cluster one: AQE on, UTC, UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(shuffle_partitions: int = 20000) -> dict[str, str]:
    """Settings for a large cluster (about 100 TB of input), to pass to the session builder.

    Shuffle partitions start high (about 0.5 GB each for a 10 TB shuffle) and AQE
    coalesces them toward the advisory size; scans read 512 MB splits; skewed join
    partitions over 512 MB and 5x the median are split; tables measured at up to
    64 MB broadcast automatically; runtime
    bloom filters prune the large side of selective joins before the shuffle.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        # Lets AQE split a skewed join even where that costs an extra shuffle, e.g. the final
        # order-details joins, whose header side keeps its partitioning from an earlier join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and versioned tables.

    Taken from ``spark.checkpoint.dir`` as the cluster names it. Only a ``local[...]``
    master, which has no other executors, gets a folder of its own when none is named;
    any other master without the setting is an error.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ordercraft-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_FOLDER: ContextVar[str | None] = ContextVar("ordercraft_run_folder", default=None)


@contextmanager
def run_folder(spark: SparkSession):
    """A folder for the stage tables of one run, in the shared checkpoint folder; removed when the run ends.

    For runs that write their results inside the block; lazy plans must not outlive it.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ordercraft-run-{uuid.uuid4().hex}"
    token = _FOLDER.set(root)
    try:
        yield root
    finally:
        _FOLDER.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def steps(spark: SparkSession, cut: Callable[[DataFrame], DataFrame] | None):
    """Two cuts of a job: one for steps, whose stage tables go when the block ends, one for tables that outlive it.

    Without ``cut`` both leave a plan as it is, and no folder is needed.
    """
    if cut is None:
        yield (lambda df: df), (lambda df: df)
        return
    outer = _FOLDER.get()

    def keep(df: DataFrame) -> DataFrame:
        token = _FOLDER.set(outer)
        try:
            return cut(df)
        finally:
            _FOLDER.reset(token)

    with run_folder(spark):
        yield cut, keep


# Settings are read when a query starts.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """The shuffle files of a query that runs inside go as soon as it ends.

    Else they stay on the executors' disks until the driver collects garbage, so the steps of a job add up. For queries
    that run once: a second run of the same plan would have to make its shuffles again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


SMALL_BROADCAST = 1 << 20
_BROADCAST_LIMITS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@contextmanager
def small_broadcasts(spark: SparkSession):
    """Joins that run inside broadcast tables of up to 1 MB only (in files or shuffle output), or less if the session says so.

    For runs of many joins: each broadcast passes through the driver, where a table takes several times its compressed
    size, so with Spark's own limit of 10 MB all of them together are too much for it.
    """
    conf = spark.conf
    # The first has a value in every session; the adaptive one follows it unless set.
    before = {_BROADCAST_LIMITS[0]: conf.get(_BROADCAST_LIMITS[0]), _BROADCAST_LIMITS[1]: conf.get(_BROADCAST_LIMITS[1], None)}
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    # -1 switches broadcasts off
    lowered = {name: value for name, value in before.items()
               if value is not None and not value.startswith("-") and size(value.lower()) > SMALL_BROADCAST}
    try:
        for name in lowered:
            conf.set(name, str(SMALL_BROADCAST))
        yield
    finally:
        for name, value in lowered.items():
            conf.set(name, value)


def materialize(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Cut lineage by writing ``df`` once as Parquet in the shared checkpoint folder and reading it back.

    One pass over the plan (``DataFrame.checkpoint`` computes it twice unless cached),
    columnar and compressed, and later reads prune columns and push filters. The
    files live in the folder the cluster names in ``spark.checkpoint.dir``, so a lost
    executor does not lose them. Inside ``run_folder`` they go with the run. The shuffles
    of ``df`` are freed once it is written. ``options``: of the Parquet writer.
    """
    spark = df.sparkSession
    root = _FOLDER.get() or ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ordercraft-{label}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.mode("errorifexists").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
