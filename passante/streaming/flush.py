"""Size-or-time flushes (T1) and what is told of them.

Messages of a topic partition are written in flushes.  A flush opens with its
first message and closes when it holds ``FLUSH_SIZE`` messages, or when a
message comes ``FLUSH_INTERVAL`` or more after it was opened; that one opens the next.
:class:`FlushState` keeps, per (topic, partition), the number, the messages and the
opening time of the open flush in Spark's state store and gives every message the number of its
flush.  Time is that of the messages, so a replayed topic gives the same flushes,
however its messages are cut into micro-batches and wherever the stream was
restarted.  How long a message waits is bounded by the stream's trigger: it is stored,
under its flush, with the micro-batch it came in.

Only (offset, time) pairs reach the state operator, and a micro-batch holds of a
partition what its trigger admits (``maxOffsetsPerTrigger``).

Messages of one micro-batch are taken in offset order.  A message without a time,
or with an earlier one than those before it, does not close a flush by time.  One
that arrives behind the last offset joins the open flush.  A message without a
partition or an offset is of no flush.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from passante.schemas import FLUSH_INTERVAL, FLUSH_SIZE
from passante.session import checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PLACED = "topic string, partition int, offset bigint, micros bigint, flush bigint"
#: Before all times.
NEVER = -(1 << 62)


def interval_micros(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1_000_000)


def place(times: np.ndarray, flush: int, events: int, opened: int, size: int, interval: int) -> tuple[np.ndarray, int, int, int]:
    """Flush numbers of messages with the given non-decreasing ``times``, behind an open
    flush of ``events`` messages; and flush, events, opening time after them.
    ``events`` 0: no flush was opened yet."""
    out, at = np.empty(len(times), np.int64), 0
    while at < len(times):
        if events == 0:
            opened = int(times[at])
        elif events >= size or times[at] >= opened + interval:
            flush, events, opened = flush + 1, 0, int(times[at])
        end = min(at + size - events, int(np.searchsorted(times, opened + interval)))
        end = max(end, at + 1)
        out[at:end] = flush
        events, at = events + end - at, end
    return out, flush, events, opened


class FlushState(StatefulProcessor):
    def __init__(self, size: int, interval: int):
        self.size, self.interval = size, interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "flush bigint, events bigint, opened bigint, last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(p["offset"].to_numpy(np.int64), p["micros"].fillna(NEVER).to_numpy(np.int64)) for p in rows]
        offsets, micros = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(offsets, kind="stable")
        offsets, micros = offsets[order], micros[order]
        state = self.open.get() if self.open.exists() else (0, 0, NEVER, NEVER)
        times = np.maximum.accumulate(np.maximum(micros, state[3]))
        flushes, flush, events, opened = place(times, *state[:3], self.size, self.interval)
        self.open.update((flush, events, opened, int(times[-1])))
        yield pd.DataFrame({"topic": key[0], "partition": key[1], "offset": offsets,
                            "micros": pd.Series(micros).where(micros != NEVER).astype("Int64"), "flush": flushes})

    def close(self) -> None:
        pass


def placed(envelope: DataFrame, size: int = FLUSH_SIZE, interval: str = FLUSH_INTERVAL) -> DataFrame:
    """(topic, partition, offset, micros, flush) of the messages of a stream."""
    rows = (envelope.where("partition is not null and offset is not null")
            .select(F.coalesce("topic", F.lit("unknown")).alias("topic"), F.col("partition").cast("int"), F.col("offset").cast("bigint"),
                    F.unix_micros(F.col("timestamp").cast("timestamp")).alias("micros")))
    return rows.groupBy("topic", "partition").transformWithStateInPandas(
        FlushState(size, interval_micros(interval)), PLACED, "Append", "None")


def start_flush_stream(env_stream: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None,
                       size: int = FLUSH_SIZE, interval: str = FLUSH_INTERVAL):
    """Each message with its flush, under ``path``, a folder per micro-batch
    (written over when the batch is replayed)."""
    spark = env_stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # what keyed state operators need
    base = path.rstrip("/")
    ck = checkpoint or f"{checkpoint_dir(spark)}/flush-stream"
    return (placed(env_stream, size, interval).writeStream.outputMode("append")
            .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{base}/batch_id={bid}"))
            .option("checkpointLocation", ck).trigger(**(trigger or {"processingTime": interval})).start())


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{PLACED}, batch_id bigint").parquet(path)


def flush_log(messages: DataFrame, size: int = FLUSH_SIZE) -> DataFrame:
    """One row per flush: events, first and last offset, the micro-batch that
    completed it, why it closed (size, time, or still open), and the partition's lag
    then: the last offset that had arrived less the flush's last."""
    key = ["topic", "partition"]
    flushes = messages.groupBy(*key, "flush").agg(
        F.count("*").alias("events"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.min("micros").alias("opened"), F.max("batch_id").alias("batch_id"))
    # a row per partition and micro-batch
    ends = messages.groupBy(*key, "batch_id").agg(F.max("offset").alias("end"), F.max("flush").alias("newest"))
    so_far, ever = Window.partitionBy(*key).orderBy("batch_id"), Window.partitionBy(*key)
    ends = ends.select(*key, "batch_id", F.max("end").over(so_far).alias("log_end"), F.max("newest").over(ever).alias("newest"))
    why = (F.when(F.col("events") >= size, "size").when(F.col("flush") < F.col("newest"), "time").otherwise("open"))
    return (flushes.join(ends, [*key, "batch_id"])
            .select(*key, "flush", "events", "first_offset", "last_offset", F.timestamp_micros("opened").alias("opened"), "batch_id",
                    why.alias("reason"), (F.col("log_end") - F.col("last_offset")).alias("lag")))
