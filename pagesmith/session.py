"""Session helper and the shared scratch location.

Jobs never write to a machine-local temporary folder on a cluster: scratch output goes under the
shared folder named by ``spark.checkpoint.dir``.  Only when that setting is absent (tests, a laptop)
do we create a local one and register it.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch of whole texts: a task holds a batch as rows, as Arrow buffers and as Python strings at once.
TEXT_BATCH = 4 << 20


def bound_batches(spark: SparkSession, most: int = TEXT_BATCH) -> None:
    """From now on batches that cross to Python have at most about ``most`` bytes (a row more); a lower limit of the session stays."""
    now = spark.conf.get(ARROW_BYTES, None)
    if now is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > most:
        spark.conf.set(ARROW_BYTES, str(most))


@contextmanager
def bounded_batches(spark: SparkSession, most: int = TEXT_BATCH):
    """``bound_batches`` for what runs inside."""
    before = spark.conf.get(ARROW_BYTES, None)
    bound_batches(spark, most)
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES) if before is None else spark.conf.set(ARROW_BYTES, before)


def get_session(master: str | None = None, app: str = "pagesmith",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators are tuned for.

    AQE coalesces the small post-shuffle partitions of tiny fixtures and splits skewed ones at scale.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # whole pages and texts cross to Python: batches are bounded by bytes, not rows alone
        ARROW_BYTES: str(32 << 20),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir:  # a folder that the driver and all executors share
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one is made only if none is configured."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pagesmith-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one intermediate table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listed_in_few_tasks(spark: SparkSession):
    """Paths are listed by at most as many tasks as a shuffle has: by default each of up to 10,000 paths is a task of its own."""
    before = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, str(min(int(before or 10_000), int(spark.conf.get("spark.sql.shuffle.partitions")))))
    try:
        yield
    finally:
        spark.conf.unset(LISTING_TASKS) if before is None else spark.conf.set(LISTING_TASKS, before)
