"""SparkSession construction and cluster-safe settings."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every cadenza job relies on. UTC keeps hour/day derivations
# identical on every executor; AQE re-plans shuffles at runtime (coalesces
# small partitions, splits skewed ones).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only relations Spark has measured below this size.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Fused stages whose generated method is larger than HotSpot will JIT
    # (8000 bytes) fall back to per-expression code, which does get compiled;
    # wide row-level projections run ~3x faster this way.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A failed task is retried up to 5 attempts before the job fails (the
    # source system's dead-letter policy allows 5 deliveries).
    "spark.task.maxFailures": "5",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "cadenza",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with cadenza's base settings.

    On a cluster, leave ``master`` unset so spark-submit decides, and set
    ``spark.checkpoint.dir`` to the shared folder; it is only filled in here
    when nothing set it (local runs and tests).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir``; only when it is unset (a local run or a
    test) is a private scratch folder made and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="cadenza-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


# Has the shuffles of a statement (of a stream: those of a micro-batch) removed with its end;
# otherwise they stay until the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements that run inside leave no shuffle files; their results must be stored by then."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir (streaming state, tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
