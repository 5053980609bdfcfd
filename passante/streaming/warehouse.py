"""Warehouse stream (T2, T3, T5-T8, K1, A20): topic -> five tables.

Per micro-batch (``foreachBatch``):

1. drop re-delivered messages inside the batch by (topic, partition, offset);
2. decode the JSON value with typed checks -- a bad document or a field of
   the wrong JSON type is an error, counted and quarantined, the stream goes
   on (T2);
3. reject incomplete profiles (F14) to the same quarantine;
4. shred the rest into the five tables with uuid5 keys of
   "topic:partition:offset:table" (N1, N2);
5. write each table to its own ``batch_id=N`` folder with overwrite, so a
   replayed batch rewrites exactly what it wrote before (K1, T5);
6. record per-partition lag and the observed counters of the batch (A20).

The decoded batch is stored once and deleted at the end.  The checkpoint
makes the source at-least-once; idempotent writes make the result
exactly-once per batch.  The five writes are not one transaction: the J1
join is INNER, so a half-written batch is invisible to readers until the
geodata write lands (it is written last).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from passante.plans.ingest import STORED, shred, stream_keys, with_keys, with_profile
from passante.schemas import PROFILE_TYPE
from passante.session import checkpoint_dir, drop_path, shuffles_dropped

# --- fixed values: typed fields of the event and their accepted JSON kinds ---
INT_FIELDS = ["impression_hour", "location_id", "numero"]
FLOAT_FIELDS = ["uniques"]
STRING_FIELDS = ["latitude", "longitude", "uf_estado", "cidade", "endereco"]
INT_KINDS = ["BIGINT", "INT", "SMALLINT", "TINYINT"]
NUMBER_PREFIXES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL")

ALL_FIELDS = INT_FIELDS + FLOAT_FIELDS + STRING_FIELDS + ["target"]
VARIANT_ROW = "struct<" + ", ".join(f"{f}: variant" for f in ALL_FIELDS) + ">"


TYPED_ROW = ("struct<" + ", ".join(
    [f"{f}: bigint" for f in INT_FIELDS] + [f"{f}: double" for f in FLOAT_FIELDS]
    + [f"{f}: string" for f in STRING_FIELDS]) + f", target: {PROFILE_TYPE.simpleString()}>")


def decode_events(env: DataFrame) -> DataFrame:
    """Typed decode of ``value`` into the event columns plus ``decode_error``
    (NULL when the message is a valid event document).

    Values come from one typed ``from_json`` (the profile is parsed straight
    into the nested map); a VARIANT parse supplies each field's JSON kind, so
    a field of the wrong JSON type is an error instead of a silent NULL.
    Each kind is computed once, in its own projection."""
    scalars = INT_FIELDS + FLOAT_FIELDS + STRING_FIELDS
    d = env.withColumns({"__obj": F.json_object_keys(F.col("value")).isNotNull(),
                         "__s": F.from_json(F.col("value"), VARIANT_ROW),
                         "__t": F.from_json(F.col("value"), TYPED_ROW)})
    tgt = F.col("__s.target")
    d = d.withColumns({
        **{f"__k_{f}": F.schema_of_variant(F.col(f"__s.{f}")) for f in scalars},
        "__t_present": tgt.isNotNull() & ~F.is_variant_null(tgt),
        **{f: F.col(f"__t.{f}") for f in scalars + ["target"]},
    })

    def kind(f):
        return F.col(f"__k_{f}")

    def present(f):
        return kind(f).isNotNull() & (kind(f) != "VOID")

    errs = [F.when(~F.col("__obj"), F.lit("invalid json or not an object"))]
    for f in INT_FIELDS:
        errs.append(F.when(present(f) & ~kind(f).isin(INT_KINDS), F.lit(f"{f}: not an integer")))
    for f in FLOAT_FIELDS:
        ok = F.lit(False)
        for pfx in NUMBER_PREFIXES:
            ok = ok | kind(f).startswith(pfx)
        errs.append(F.when(present(f) & ~ok, F.lit(f"{f}: not a number")))
    for f in STRING_FIELDS:
        errs.append(F.when(present(f) & (kind(f) != "STRING"), F.lit(f"{f}: not a string")))
    errs.append(F.when(F.col("__t_present") & F.col("target").isNull(),
                       F.lit("target: not a map of maps of numbers")))
    return (d.withColumn("decode_error", F.coalesce(*errs))
            .drop("__s", "__t", "__obj", "__t_present", *[f"__k_{f}" for f in scalars]))


def batch_telemetry(batch: DataFrame) -> DataFrame:
    """A20 for one batch: last offset, high watermark at it and lag per
    (topic, partition), plus message counts."""
    g = batch.groupBy("topic", "partition").agg(
        F.max("offset").alias("last_offset"),
        F.max_by("high_watermark", "offset").alias("high_watermark"),
        F.count(F.lit(1)).alias("messages"))
    return g.withColumn("lag", F.col("high_watermark") - F.col("last_offset"))


#: Tables whose rows are counted while they are written.
COUNTED = ["age", "gender", "social_class", "target", "enriched", "geodata"]
COUNTERS = "topic string, counter string, label string, value bigint"


def read_counters(spark: SparkSession, warehouse: str) -> DataFrame:
    """(batch_id, topic, counter, label, value) of all batches."""
    return spark.read.schema(f"{COUNTERS}, batch_id bigint").parquet(f"{warehouse.rstrip('/')}/_counters")


def write_batch(batch: DataFrame, batch_id: int, warehouse: str) -> dict:
    """K1: idempotent five-table write of one micro-batch.

    A20: what was received, parsed and rejected is observed in the job that decodes the
    batch, the rows of each table in the job that writes it; no row is read again to count.
    The counters are stored with the batch, under its first topic, and returned.
    The decoded batch is stored beside the tables while they are written: a persisted one
    would hold its shuffle for as long as the driver holds the batch."""
    w, began = warehouse.rstrip("/"), time.monotonic()
    spark = batch.sparkSession
    # dealt by the key first: copies are rare, and a partial aggregate would sort all messages twice
    dedup = batch.repartition("topic", "partition", "offset").dropDuplicates(["topic", "partition", "offset"])
    keys = stream_keys("topic", "partition", "offset")
    # decoded, keyed and cut into buckets once, read by every write; only a rejected message keeps its text
    dec = with_profile(with_keys(decode_events(dedup), keys))
    dec = dec.withColumn("value", F.when(F.col("decode_error").isNotNull() | ~F.col("__complete"), F.col("value"))).drop("target")
    decoded = f"{w}/_decoded-{batch_id}"
    try:
        seen = Observation(f"batch-{batch_id}")
        bad, profile = F.col("decode_error").isNotNull(), F.col("__complete")
        counted = dec.observe(seen, F.count(F.lit(1)).alias("received"), F.count_if(bad).alias("document"), F.count_if(~bad & ~profile).alias("profile"),
                              F.count_if(~bad & profile).alias("parsed"), F.min("topic").alias("topic"))
        with shuffles_dropped(spark):
            counted.write.mode("overwrite").option("compression", STORED).parquet(decoded)
        dec = spark.read.schema(dec.schema).parquet(decoded)
        good = dec.where(F.col("decode_error").isNull())
        sh = shred(good, keys, strict=True)
        bad_json = dec.where(F.col("decode_error").isNotNull()).select(
            "topic", "partition", "offset", "timestamp", "value", F.col("decode_error").alias("reason"))
        bad_profile = sh.quarantine.select("topic", "partition", "offset", "timestamp", "value", "reason")
        side = {"_quarantine": bad_json.unionByName(bad_profile), "_telemetry": batch_telemetry(dec)}
        dims = {n: sh.tables()[n] for n in ["age", "gender", "social_class", "target"]} | {"enriched": sh.wide}

        rows = {name: Observation(f"{name}-{batch_id}") for name in COUNTED}

        def put(item):
            name, df = item
            if name in rows:
                df = df.observe(rows[name], F.count(F.lit(1)).alias("rows"))
            df.write.mode("overwrite").option("compression", STORED).parquet(f"{w}/{name}/batch_id={batch_id}")

        # the dimension tables and side outputs are independent jobs: run them
        # concurrently; geodata goes last (readers join INNER from geodata)
        with shuffles_dropped(spark), ThreadPoolExecutor(max_workers=len(dims) + len(side)) as pool:
            list(pool.map(put, list(dims.items()) + list(side.items())))
        put(("geodata", sh.geodata))
        found = seen.get
        counters = [("messages", "received", found["received"]), ("messages", "parsed", found["parsed"]),
                    ("rejected", "document", found["document"]), ("rejected", "profile", found["profile"]),
                    *[("rows", name, observed.get["rows"]) for name, observed in rows.items()],
                    ("milliseconds", "flush", round(1000 * (time.monotonic() - began)))]
        told = spark.createDataFrame([(found["topic"] or "unknown", *c) for c in counters], COUNTERS)
        told.coalesce(1).write.mode("overwrite").parquet(f"{w}/_counters/batch_id={batch_id}")
        return {"batch_id": batch_id, **{f"{counter}.{label}": value for counter, label, value in counters}}
    finally:
        drop_path(spark, decoded)


def start_warehouse_stream(env_stream: DataFrame, warehouse: str, checkpoint: str | None = None,
                           trigger: dict | None = None, query_name: str | None = None,
                           dedupe_within: str | None = None):
    """Envelope stream -> foreachBatch(write_batch), own checkpoint.

    ``trigger`` examples: ``{"processingTime": "30 seconds"}`` (T1 timer),
    ``{"availableNow": True}`` (T6: drain what is there, then stop).
    ``dedupe_within`` (e.g. ``"1 hour"``, opt-in T5): drop a message whose
    (topic, partition, offset) was already seen in an earlier batch within
    that event-time watermark -- bounded state in the state store."""
    spark = env_stream.sparkSession
    if dedupe_within:
        env_stream = (env_stream.withWatermark("timestamp", dedupe_within)
                      .dropDuplicatesWithinWatermark(["topic", "partition", "offset"]))
    ck = checkpoint or f"{checkpoint_dir(spark)}/warehouse-stream"
    w = env_stream.writeStream.foreachBatch(lambda df, bid: write_batch(df, bid, warehouse)) \
        .option("checkpointLocation", ck)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return w.start()


def read_enriched(spark: SparkSession, warehouse: str) -> DataFrame:
    """J3 as the stream wrote it: the analytics on it need no join."""
    return spark.read.parquet(f"{warehouse.rstrip('/')}/enriched").drop("batch_id")


def read_warehouse(spark: SparkSession, warehouse: str):
    """The five tables written by the stream (batch folders unioned by
    partition discovery; the ``batch_id`` column is dropped)."""
    from passante.sources.testdata import Star
    w = warehouse.rstrip("/")
    return Star(*(spark.read.parquet(f"{w}/{t}").drop("batch_id")
                  for t in ["geodata", "target", "age", "gender", "social_class"]))
