"""Session and lineage helpers."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 4 << 20    # of a catalogue's text, in a partition of its items
LEAST_PARTITIONS = 8         # of a catalogue, on a cluster of few cores


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marquee") -> SparkSession:
    """Return the active session or build one tuned for local tests.

    On a cluster the session is normally created by the launcher; we only add
    settings that are missing.  AQE stays on so shuffle partition counts and
    skewed joins are re-planned at runtime.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("MARQUEE_DRIVER_MEMORY", "8g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python functions of it can run there
    wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="marquee-zip-")), "marquee.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint directory.

    Survives executor loss (unlike a local checkpoint) and keeps the output
    partitioning, so later joins/aggregations on the same key skip a shuffle.
    The checkpointed relation only records a hash partitioning when the plan
    that produced it was not adaptive, so this one job is planned with AQE
    off (its shuffles, if any, use ``spark.sql.shuffle.partitions``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return df.checkpoint(eager=eager)
    finally:
        spark.conf.set(key, before)


def free_written(spark: SparkSession) -> None:
    """Lets Spark delete the checkpoints and shuffle files that nothing refers to any more.

    It does so when the driver's garbage is collected, which a driver with memory to spare may put off for long, while
    the files of each finished step stay on the disks beside those of the next one.
    """
    gc.collect()
    spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count (the cluster-wide parallelism knob)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized_partitions(spark: SparkSession, size: int) -> int:
    """Shuffle partitions for ``size`` bytes of text: about ``PARTITION_BYTES`` each, at least two a core, never more than
    the session's count (so that large catalogues keep it)."""
    least = max(LEAST_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    return min(shuffle_partitions(spark), max(least, -(-size // PARTITION_BYTES)))


@contextlib.contextmanager
def partitioned(spark: SparkSession, partitions: int | None):
    """Jobs planned within have ``partitions`` shuffle partitions, where the session has more (None: the session's).

    Checkpoint jobs are planned without AQE (see ``cut_lineage``), so nothing coalesces their shuffles: a small catalogue
    would be dealt to hundreds of tasks that take longer to start than to run, in each of a fit's many jobs.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions is None or partitions >= int(before):
        yield
        return
    spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)
