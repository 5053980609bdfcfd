"""Topic source (S3, S6) and publisher (K5).

The stream operators consume the message envelope
``(topic, partition, offset, timestamp, value, high_watermark)``.  On a
cluster this comes from Spark's Kafka source; ``high_watermark`` (the log
end offset) is not a per-row Kafka column, so it is NULL there and the lag
panels use the source progress (``latestOffset``) instead.  Offline, the
same envelope is read from JSON files by a file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.schemas import ENVELOPE_SCHEMA, FLUSH_INTERVAL, FLUSH_SIZE
from passante.session import shuffles_dropped

ENVELOPE_COLUMNS = ["topic", "partition", "offset", "timestamp", "value", "high_watermark"]
# microsecond timestamps in envelope files (Spark's JSON default keeps milliseconds)
ENVELOPE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def read_topic(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest",
               min_offsets: int = FLUSH_SIZE, max_delay: str = FLUSH_INTERVAL,
               max_offsets: int | None = None, extra: dict | None = None) -> DataFrame:
    """S3 + T1: Kafka stream that fires at ``min_offsets`` new records or
    after ``max_delay`` -- the size-or-time flush rule -- with an optional
    cap per trigger.  One Spark task per topic partition."""
    if not kafka_available(spark):
        raise RuntimeError("the Kafka source is not on the classpath; use read_envelope_files")
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting)
         .option("minOffsetsPerTrigger", str(min_offsets))
         .option("maxTriggerDelay", max_delay.replace(" seconds", "s")))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().select("topic", "partition", "offset", "timestamp",
                           F.col("value").cast("string").alias("value"),
                           F.lit(None).cast("bigint").alias("high_watermark"))


def read_envelope_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, drop_read: bool = False) -> DataFrame:
    """Envelope rows from JSON files as a stream (the offline stand-in for S3).
    ``drop_read`` deletes the files of a batch once it is committed, as a topic's
    retention does: for a topic that one stream reads."""
    r = spark.readStream.schema(ENVELOPE_SCHEMA).option("timestampFormat", ENVELOPE_TS_FORMAT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if drop_read:
        r = r.option("cleanSource", "delete")
    return r.json(path)


def write_envelope_files(env: DataFrame, path: str, files: int = 16, mode: str = "overwrite") -> None:
    """Envelope rows as JSON files (offline topic; a replay source for tests), dealt in
    turn by their offset: a round robin would sort all messages first."""
    dealt = env.repartitionById(files, F.pmod(F.coalesce("offset", F.lit(0)), F.lit(files)).cast("int"))
    with shuffles_dropped(env.sparkSession):
        dealt.write.mode(mode).option("timestampFormat", ENVELOPE_TS_FORMAT).json(path)


def envelope_of(events: DataFrame, topic: str = "geodata", value_col: str = "value") -> DataFrame:
    """Batch helper: events with (partition, offset, timestamp, hw) -> envelope."""
    return events.select(F.lit(topic).alias("topic"), F.col("partition").cast("int"),
                         F.col("offset").cast("bigint"), F.col("timestamp"),
                         F.col(value_col).alias("value"), F.col("high_watermark").cast("bigint"))


def publish(df: DataFrame, bootstrap: str, topic: str) -> None:
    """K5: every row as a JSON message with a random UUID key."""
    (df.select(F.expr("uuid()").alias("key"), F.to_json(F.struct("*")).alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def publish_files(df: DataFrame, path: str, mode: str = "append") -> None:
    """K5 offline: the same messages written as JSON lines (key, value)."""
    (df.select(F.expr("uuid()").alias("key"), F.to_json(F.struct("*")).alias("value"))
     .write.mode(mode).json(path))
