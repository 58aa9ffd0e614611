"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: the
checkpoint folder is read from ``spark.checkpoint.dir``; a temporary
folder is only created when the session runs in local mode and nothing
was configured (tests, laptop runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hash table instead of sorts where all partitions of a side are small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # dimension tables below this size are broadcast by the planner; larger
    # ones fall back to a sort-merge join (a checked size, not a hint)
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.driver.memory": "8g",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "losslens", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("LOSSLENS_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir``.  Only when it is unset *and* the
    session is local is a temporary folder created.  On a cluster an unset
    folder is an error: lineage cuts must land on shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="losslens-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at shared storage "
        "(HDFS / object store) before running losslens jobs on a cluster")


def cut_lineage(df):
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun in here drop their shuffle files when they end, not when the
    driver happens to collect its garbage: for writes of the items' size."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def stored(df, tag: str):
    """The rows as parquet in the shared folder, for frames of the items' size
    that are read more than once: compressed, and a reader takes only the
    columns it needs."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "stored", f"{tag}-{uuid.uuid4().hex[:8]}")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
