"""Archive stream (T4, N4, N5, K3), date-partitioned scans (S4), daily
compaction (K4), object listing (S5, A18, A19) and catalog search (L5).

Each message becomes one NDJSON line: the original JSON object with a
python-dict ``target`` text parsed into an object (paired-quote rule; left
as text when it still does not parse) and ``_kafka_partition``,
``_kafka_offset``, ``_kafka_timestamp`` (RFC 3339, UTC) added -- keys come
out sorted, like an encoder of a hash map.  Lines are written under
``topic=/year=/month=/day=/batch_id=`` folders (the day of the message
timestamp, or of the write time when the timestamp is missing); a replayed
batch overwrites only its own folder (dynamic partition overwrite).  A
manifest row per (topic, partition, day) and batch keeps the first/last offset;
it lies in a folder per day, so a scan of one day reads that day's manifest and
opens the folders it names, and nothing else of the archive is listed.
"""

from __future__ import annotations

import datetime as dt
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.functions.columns import basename, normalize_quotes, rfc3339
from passante.session import checkpoint_dir

ZERO_TS_TEXT = "0001-01-01T00:00:00Z"


def _variant(c: Column) -> Column:
    return F.variant_get(F.to_variant_object(F.struct(c.alias("v"))), "$.v", "variant")


def _fix_target(k: Column, v: Column) -> Column:
    parsed = F.try_parse_json(normalize_quotes(v.cast("string")))
    return F.when((k == "target") & (F.schema_of_variant(v) == "STRING"), F.coalesce(parsed, v)).otherwise(v)


def enrich_records(env: DataFrame) -> DataFrame:
    """N4 + N5: envelope -> (topic, partition, offset, record, day columns,
    error).  ``record`` is NULL and ``error`` set when the value is not a
    JSON object."""
    m = F.from_json(F.col("value"), "map<string, variant>")
    ts_ok = F.col("timestamp").isNotNull() & (F.year("timestamp") > 1)
    meta = F.create_map(
        F.lit("_kafka_partition"), _variant(F.col("partition").cast("bigint")),
        F.lit("_kafka_offset"), _variant(F.col("offset").cast("bigint")),
        F.lit("_kafka_timestamp"), _variant(F.when(ts_ok, rfc3339(F.col("timestamp"))).otherwise(F.lit(ZERO_TS_TEXT))))
    rec = F.to_json(F.to_variant_object(F.map_concat(F.transform_values(m, _fix_target), meta)))
    day_ts = F.when(ts_ok, F.col("timestamp")).otherwise(F.current_timestamp())
    return env.select(
        "topic", "partition", "offset",
        rec.alias("record"),
        F.when(F.col("value").isNull() | m.isNull(), F.lit("invalid json")).alias("error"),
        F.date_format(day_ts, "yyyy").alias("year"),
        F.date_format(day_ts, "MM").alias("month"),
        F.date_format(day_ts, "dd").alias("day"))


def write_archive_batch(env: DataFrame, batch_id: int, base: str) -> None:
    """K3 for one micro-batch (idempotent under replay)."""
    b = base.rstrip("/")
    rec = enrich_records(env).persist()
    try:
        good = rec.where(F.col("error").isNull()).withColumn("batch_id", F.lit(batch_id))
        # ranges of a day's partitions and offsets: a busy one is written by several tasks
        folder = ["topic", "year", "month", "day"]
        (good.repartitionByRange(*folder, "partition", "offset")
         .sortWithinPartitions(*folder, "batch_id", "partition", "offset")
         .select("record", *folder, "batch_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*folder, "batch_id").text(f"{b}/topics"))
        (good.groupBy("topic", "partition", F.concat_ws("-", "year", "month", "day").alias("date"), "batch_id")
         .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
              F.count(F.lit(1)).alias("records"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "batch_id").parquet(f"{b}/_manifest"))
        (rec.where(F.col("error").isNotNull()).select("topic", "partition", "offset", "error")
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{b}/_errors"))
    finally:
        rec.unpersist()


def start_archive_stream(env_stream: DataFrame, base: str, checkpoint: str | None = None,
                         trigger: dict | None = None, query_name: str | None = None):
    """T4: second, independent query over the same topic (T8 fan-out)."""
    spark = env_stream.sparkSession
    ck = checkpoint or f"{checkpoint_dir(spark)}/archive-stream"
    w = (env_stream.writeStream.foreachBatch(lambda df, bid: write_archive_batch(df, bid, base))
         .option("checkpointLocation", ck))
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


# ------------------------------------------------------------------ S4 / K4


def yesterday_utc() -> dt.date:
    return (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).date()


MANIFEST = "topic string, partition int, first_offset bigint, last_offset bigint, records bigint, batch_id bigint"


def day_manifest(spark: SparkSession, base: str, day: dt.date, topic: str | None = None) -> DataFrame | None:
    """The manifest rows of one day; None if nothing was archived on it."""
    path = f"{base.rstrip('/')}/_manifest/date={day.isoformat()}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    rows = spark.read.schema(MANIFEST).parquet(path)
    return rows.where(F.col("topic") == topic) if topic else rows


def read_archive_day(spark: SparkSession, base: str, day: dt.date | None = None, topic: str | None = None,
                     partition: int | None = None) -> DataFrame:
    """NDJSON lines of one day (default yesterday, UTC).  The day's manifest names
    the folders to read, one per topic and batch; with ``partition``, only those of
    batches that hold some of it, and of these its own lines."""
    b, d = base.rstrip("/"), day or yesterday_utc()
    manifest = day_manifest(spark, b, d, topic)
    schema = "value string, topic string, year int, month int, day int, batch_id bigint"
    if manifest is None:
        return spark.createDataFrame([], schema)
    if partition is not None:
        manifest = manifest.where(F.col("partition") == partition)
    # a row per topic and trigger of the day
    folders = [f"{b}/topics/topic={r.topic}/year={d.year:04d}/month={d.month:02d}/day={d.day:02d}/batch_id={r.batch_id}"
               for r in manifest.select("topic", "batch_id").distinct().orderBy("topic", "batch_id").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    lines = spark.read.option("basePath", f"{b}/topics").text(folders)
    lines = lines.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])
    return lines if partition is None else lines.where(F.get_json_object("value", "$._kafka_partition").cast("int") == partition)


def read_archive(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.text(f"{base.rstrip('/')}/topics")


def compact_day(spark: SparkSession, base: str, out: str, day: dt.date | None = None,
                target_file_bytes: int = 256 * 1024 * 1024) -> dict:
    """K4: rewrite one day's fragments as files of about ``target_file_bytes``, each
    topic's lines in the order of partition and offset, within a file and from file to
    file (never one task for a whole day).  Returns files and bytes read; an empty day is a no-op."""
    d = day or yesterday_utc()
    if day_manifest(spark, base, d) is None:
        return {"day": str(d), "files": 0, "bytes": 0, "written": False}
    day_glob = f"{base.rstrip('/')}/topics/topic=*/year={d.year:04d}/month={d.month:02d}/day={d.day:02d}"
    stats = list_objects(spark, day_glob).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    files, nbytes = int(stats["files"]), int(stats["bytes"])
    n = max(1, math.ceil(nbytes / target_file_bytes))
    place = F.from_json("value", "_kafka_partition bigint, _kafka_offset bigint")
    order = ["topic", "place._kafka_partition", "place._kafka_offset", "value"]
    lines = read_archive_day(spark, base, d).withColumn("place", place)
    (lines.repartitionByRange(n, *order).sortWithinPartitions(*order).select("value", "topic")
     .write.mode("overwrite").partitionBy("topic")
     .text(f"{out.rstrip('/')}/daily/year={d.year:04d}/month={d.month:02d}/day={d.day:02d}"))
    return {"day": str(d), "files": files, "bytes": nbytes, "written": True, "output_files": n}


# ------------------------------------------------------------------ S5 / A18 / A19 / L5


def list_objects(spark: SparkSession, base: str) -> DataFrame:
    """Flat recursive listing (path, length, modificationTime); the file
    content column is pruned, so nothing but metadata is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
            .select("path", "length", "modificationTime"))


def normalize_folder_prefix(folder: str) -> str:
    """``folder`` as a prefix of object names: '' or 'a/b/'."""
    inner = re.fullmatch(r"\s*/?(.*?)/?\s*", folder, re.DOTALL)[1]
    return inner and f"{inner}/"


def list_level(objects: DataFrame, root: str, prefix: str = "") -> DataFrame:
    """Immediate files and sub-folders under ``prefix`` (relative to
    ``root``): (kind, name, id, size, files).  Folders carry the number of
    files and bytes below them."""
    p = normalize_folder_prefix(prefix)
    root_path = "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", root).strip("/") + "/"
    start = root_path + p
    rel = F.regexp_replace(F.col("path"), r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")
    o = objects.withColumn("__rel", rel).where(F.col("__rel").startswith(F.lit(start)))
    o = o.withColumn("__rest", F.substring(F.col("__rel"), len(start) + 1, 1 << 30))
    seg = F.split(F.col("__rest"), "/")
    is_folder = F.size(seg) > 1
    o = o.select(F.when(is_folder, F.lit("folder")).otherwise(F.lit("file")).alias("kind"),
                 F.when(is_folder, F.concat(F.lit(p), seg.getItem(0), F.lit("/")))
                  .otherwise(F.concat(F.lit(p), F.col("__rest"))).alias("id"),
                 "length")
    g = o.groupBy("kind", "id").agg(F.sum("length").alias("size"), F.count(F.lit(1)).alias("files"))
    name = F.when(F.col("kind") == "folder", F.element_at(F.split(F.regexp_replace("id", "/$", ""), "/"), -1)) \
        .otherwise(basename(F.col("id")))
    return g.select("kind", name.alias("name"), "id",
                    F.when(F.col("kind") == "folder", F.lit(-1)).otherwise(F.col("size")).alias("size"),
                    "files")


def listing_summary(level: DataFrame) -> DataFrame:
    """Folders, files and total bytes of a level listing."""
    return level.agg(F.count(F.when(F.col("kind") == "folder", 1)).alias("folders"),
                     F.count(F.when(F.col("kind") == "file", 1)).alias("files"),
                     F.coalesce(F.sum(F.when(F.col("kind") == "file", F.col("size"))), F.lit(0)).alias("bytes"))


def search_sort(level: DataFrame, query: str = "", sort_field: str = "name", ascending: bool = True) -> DataFrame:
    """Case-insensitive name filter; folders always first; then name
    (accent- and case-insensitive Portuguese collation) or size; descending
    flips only the second key."""
    q = query.strip().lower()
    df = level.where(F.lower("name").contains(q)) if q else level
    key = F.collate(F.col("name"), "pt_CI_AI") if sort_field == "name" else F.col("size")
    key = key.asc() if ascending else key.desc()
    type_rank = F.when(F.col("kind") == "folder", 0).otherwise(1)
    return df.orderBy(type_rank.asc(), key, F.col("id").asc())
