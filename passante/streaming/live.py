"""Live aggregates for the map (T9) and the latest event per location
(T10) as stateful streaming aggregations.

Both keep their state in Spark's state store (checkpointed, so they survive
executor loss and restarts) and emit only changed keys per trigger
(``update`` mode).  Each trigger's changes are a delta, written to its own
``deltas/batch_id=N`` folder (idempotent under replay).  Every ``COMPACT_EVERY``
triggers the last snapshot and the deltas after it are merged into
``snapshots/upto=N``.  What says that a snapshot is there is the marker that Spark
writes when its last task is committed: readers take the newest snapshot that has
one, and the deltas after it, so they see no half-written snapshot, and a replayed
compaction sends them back to the one before.  Deltas and snapshots that the last
``KEPT`` snapshots have no use for are deleted, so a reader lists a bounded number of
folders however long the stream has run.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.session import checkpoint_dir
from passante.streaming.warehouse import decode_events


def live_flow(events: DataFrame) -> DataFrame:
    """Σuniques and event count per (location, hour), maintained live."""
    return (events.groupBy("location_id", "impression_hour")
            .agg(F.sum("uniques").alias("flow"), F.count(F.lit(1)).alias("events")))


def latest_per_location(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The most recent event of every location (ties: highest offset)."""
    return (events.groupBy("location_id")
            .agg(F.max_by(F.struct(ts, "partition", "offset", "impression_hour", "uniques", "latitude",
                                   "longitude", "endereco"),
                          F.struct(ts, "offset", "partition")).alias("last"))
            .select("location_id", "last.*"))


#: Triggers between two snapshots, and snapshots whose deltas stay for readers under way.
COMPACT_EVERY, KEPT = 10, 2


def _numbers(spark: SparkSession, folder: str, name: str, marker: str = "") -> list[int]:
    """Values of the sub-folders ``name=value`` (that hold ``marker``), ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}=*{marker}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    folders = [(f.getPath().getParent() if marker else f.getPath()).getName() for f in found]
    return sorted(int(f.split("=")[1]) for f in folders)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _parts(spark: SparkSession, path: str, before: int | None = None) -> tuple[int | None, list[int]]:
    """The newest snapshot (older than batch ``before``) and the deltas after it."""
    found = [n for n in _numbers(spark, f"{path}/snapshots", "upto", "/_SUCCESS") if before is None or n < before]
    base = found[-1] if found else None
    return base, [n for n in _numbers(spark, f"{path}/deltas", "batch_id") if base is None or n > base]


def _merged(spark: SparkSession, path: str, base: int | None, deltas: list[int], keys: list[str]) -> DataFrame:
    """The newest row per key, with the batch it came in."""
    rows = [spark.read.parquet(f"{path}/snapshots/upto={base}")] if base is not None else []
    rows += [spark.read.option("basePath", f"{path}/deltas").parquet(*[f"{path}/deltas/batch_id={n}" for n in deltas])
             .withColumn("batch_id", F.col("batch_id").cast("bigint"))] if deltas else []
    df = functools.reduce(lambda a, b: a.unionByName(b), rows)
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("__v")).select(*keys, "__v.*")


def compact(spark: SparkSession, path: str, batch_id: int, keys: list[str], kept: int = KEPT) -> None:
    """Merge the last snapshot before ``batch_id`` and the deltas up to it."""
    base, deltas = _parts(spark, path, batch_id)
    _merged(spark, path, base, [n for n in deltas if n <= batch_id], keys).write.mode("overwrite").parquet(f"{path}/snapshots/upto={batch_id}")
    snapshots = _numbers(spark, f"{path}/snapshots", "upto", "/_SUCCESS")
    if len(snapshots) > kept:
        oldest = snapshots[-kept]
        for n in snapshots[:-kept]:
            _delete(spark, f"{path}/snapshots/upto={n}")
        for n in _numbers(spark, f"{path}/deltas", "batch_id"):
            if n <= oldest:
                _delete(spark, f"{path}/deltas/batch_id={n}")


def upsert_batch(df: DataFrame, batch_id: int, path: str, keys: list[str], every: int = COMPACT_EVERY) -> None:
    """Write one trigger's changes, and a snapshot when it is time for one."""
    path = path.rstrip("/")
    df.write.mode("overwrite").parquet(f"{path}/deltas/batch_id={batch_id}")
    if (batch_id + 1) % every == 0:
        compact(df.sparkSession, path, batch_id, keys)


KEYS = {"flow": ["location_id", "impression_hour"], "latest": ["location_id"]}


def start_live(env_stream: DataFrame, path: str, which: str = "flow", checkpoint: str | None = None,
               trigger: dict | None = None, every: int = COMPACT_EVERY):
    """Decode the topic stream and maintain one of the live aggregates."""
    spark = env_stream.sparkSession
    ev = decode_events(env_stream).where(F.col("decode_error").isNull())
    agg = live_flow(ev) if which == "flow" else latest_per_location(ev)
    ck = checkpoint or f"{checkpoint_dir(spark)}/live-{which}"
    return (agg.writeStream.outputMode("update")
            .foreachBatch(lambda df, bid: upsert_batch(df, bid, path, KEYS[which], every))
            .option("checkpointLocation", ck)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def read_current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current value per key: the newest snapshot and the deltas after it."""
    path = path.rstrip("/")
    return _merged(spark, path, *_parts(spark, path), keys).drop("batch_id")
