"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on.  They are session-level and
# safe to (re)apply on a session someone else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rank-limit pushdown (WindowGroupLimit) for per-group top-k up to this k
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # the JVM never compiles a method of more bytes: such a stage runs in smaller ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "passante") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("PASSANTE_DRIVER_MEMORY", "16g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        if k == "spark.sql.optimizer.windowGroupLimitThreshold":
            ensure_window_group_limit(spark, int(v))
        else:
            spark.conf.set(k, v)


def ensure_window_group_limit(spark: SparkSession, k: int) -> None:
    """Make sure `row_number() <= k` per group is planned as a partial
    WindowGroupLimit before the shuffle, so no group is shipped whole."""
    cur = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if cur < k:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(k))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a shared file system); without it an
    error is raised.  Only a local session (tests) gets a scratch folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="passante-ckpt-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder under the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a job wrote for itself and that no later step reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written in the block has its shuffle files deleted as soon as it is written,
    not when the driver collects garbage.  For steps that run once: a DataFrame that is
    executed again shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
