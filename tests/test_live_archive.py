import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from passante.streaming import archive as AR
from passante.streaming import live as LV

KEYS = ["location_id"]


def delta(spark, rows):
    return spark.createDataFrame(rows, "location_id bigint, flow double")


def test_current_state_is_one_snapshot_and_the_deltas_after_it(spark, tmp_dir):
    want = {}

    def put(batch, rows):
        LV.upsert_batch(delta(spark, rows), batch, tmp_dir, KEYS, every=3)
        want.update(rows)
        assert {r.location_id: r.flow for r in LV.read_current(spark, tmp_dir, KEYS).collect()} == want

    for batch in range(11):
        rows = [(k, float(100 * batch + k)) for k in range(batch % 4, 12, 3)]
        put(batch, rows)
        if batch in (4, 8):  # delivered again, once as the one that compacts
            put(batch, rows)
    snapshots = sorted(os.path.basename(p) for p in glob.glob(f"{tmp_dir}/snapshots/*"))
    deltas = sorted(int(p.split("=")[1]) for p in glob.glob(f"{tmp_dir}/deltas/*"))
    assert snapshots == ["upto=5", "upto=8"] and deltas == [6, 7, 8, 9, 10]
    read = LV.read_current(spark, tmp_dir, KEYS).inputFiles()
    assert {os.path.basename(os.path.dirname(f)) for f in read} == {"upto=8", "batch_id=9", "batch_id=10"}


def test_a_half_written_snapshot_is_not_read(spark, tmp_dir):
    for batch in range(4):
        LV.upsert_batch(delta(spark, [(batch, 1.0), (9, float(batch))]), batch, tmp_dir, KEYS, every=2)
    os.remove(f"{tmp_dir}/snapshots/upto=3/_SUCCESS")
    assert {r.location_id: r.flow for r in LV.read_current(spark, tmp_dir, KEYS).collect()} == {0: 1.0, 1: 1.0, 2: 1.0, 3: 1.0, 9: 3.0}
    assert all("upto=3" not in f for f in LV.read_current(spark, tmp_dir, KEYS).inputFiles())


def archived(spark, base, batches):
    for b, rows in enumerate(batches):
        env = spark.createDataFrame([("geo", p, o, dt.datetime(2025, 6, day, 12, 0), json.dumps({"n": o})) for p, o, day in rows],
                                    "topic string, partition int, offset bigint, timestamp timestamp, value string")
        AR.write_archive_batch(env, b, base)


def test_a_day_reads_the_folders_its_manifest_names(spark, tmp_dir):
    archived(spark, tmp_dir, [[(p, o, 10 + o % 3) for p in range(3) for o in range(30)], [(1, o, 11) for o in range(30, 40)], [(0, 99, 12)]])
    day = AR.read_archive_day(spark, tmp_dir, dt.date(2025, 6, 11))
    assert day.count() == 40 and {f"{r.year}-{r.month}-{r.day}" for r in day.collect()} == {"2025-6-11"}
    assert all("/month=06/day=11/" in f for f in day.inputFiles())
    manifest = AR.day_manifest(spark, tmp_dir, dt.date(2025, 6, 11))
    assert all("date=2025-06-11" in f for f in manifest.inputFiles())
    assert {(r.partition, r.batch_id): (r.first_offset, r.last_offset, r.records) for r in manifest.collect()} == {
        (0, 0): (1, 28, 10), (1, 0): (1, 28, 10), (2, 0): (1, 28, 10), (1, 1): (30, 39, 10)}
    one = AR.read_archive_day(spark, tmp_dir, dt.date(2025, 6, 11), "geo", partition=2)
    assert one.count() == 10 and all("batch_id=0" in f for f in one.inputFiles())
    assert AR.read_archive_day(spark, tmp_dir, dt.date(2025, 6, 20)).count() == 0
    assert AR.read_archive_day(spark, tmp_dir, dt.date(2025, 6, 11), "other").count() == 0


def test_compacted_lines_are_in_order(spark, tmp_dir):
    rows = [(p, o, 11) for p in range(3) for o in range(200)]
    archived(spark, f"{tmp_dir}/a", [rows[i::4] for i in range(4)])
    told = AR.compact_day(spark, f"{tmp_dir}/a", f"{tmp_dir}/out", dt.date(2025, 6, 11), target_file_bytes=4000)
    files = sorted(glob.glob(f"{tmp_dir}/out/daily/year=2025/month=06/day=11/topic=geo/part-*"))
    assert told["written"] and len(files) > 2
    found = [json.loads(line) for f in files for line in open(f)]
    assert [(r["_kafka_partition"], r["_kafka_offset"]) for r in found] == [(p, o) for p, o, _ in rows]


def test_a_busy_partition_is_archived_by_several_tasks(spark, tmp_dir):
    env = spark.range(60_000).select(F.lit("geo").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
                                      F.lit(dt.datetime(2025, 6, 11)).alias("timestamp"), F.concat(F.lit('{"pad": "'), *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 512) for k in range(4)], F.lit('"}')).alias("value"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        AR.write_archive_batch(env, 0, tmp_dir)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(f"{tmp_dir}/topics/topic=geo/year=2025/month=06/day=11/batch_id=0/part-*")) > 2
