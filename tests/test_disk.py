"""What the loads leave on disk: the tables, and no text, staged rows or shuffle files beside them."""
import datetime as dt
import glob
import os
import time

import pyarrow.parquet as pq
import pytest

from passante.plans import ingest as I
from passante.registry import QUERIES
from passante.sources.topic import read_envelope_files, write_envelope_files
from passante.streaming import warehouse as WH
from tests.conftest import SF_SMALL
from tests.test_ingest_stream import _env, _event, _flow_file, _flow_line

TABLES = ["age", "enriched", "gender", "geodata", "social_class", "target"]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def left_by(spark, run):
    """The shuffle files that ``run`` leaves; they are deleted in the background."""
    before = shuffle_files(spark)
    run()
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def scratch_of(spark, name):
    return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/{name}-*"))


def test_a_csv_load_leaves_the_tables_only(spark, tmp_dir):
    _flow_file(f"{tmp_dir}/in/a.csv", [_flow_line(k % 150) for k in range(200)])
    assert not left_by(spark, lambda: I.load_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/wh", "lenient"))
    assert sorted(os.listdir(f"{tmp_dir}/wh")) == TABLES and os.listdir(f"{tmp_dir}/in") == ["a.csv"]
    parts = glob.glob(f"{tmp_dir}/wh/*/*.parquet")
    assert {pq.read_metadata(p).row_group(0).column(0).compression for p in parts} == {"ZSTD"}
    geo, target, age = (spark.read.parquet(f"{tmp_dir}/wh/{t}") for t in ("geodata", "target", "age"))
    assert geo.join(target.withColumnRenamed("id", "target_id"), "target_id").join(age.withColumnRenamed("id", "age_id"), "age_id").count() == 200


@pytest.mark.parametrize("mode", ["lenient", "bulk"])
def test_a_csv_query_keeps_no_texts(spark, mode):
    name = {"lenient": "csv_lenient_roundtrip", "bulk": "csv_bulk_load"}[mode]
    before, found = scratch_of(spark, f"csv-{mode}"), []
    assert not left_by(spark, lambda: found.append(QUERIES[name][0](spark, SF_SMALL)))
    (root,) = scratch_of(spark, f"csv-{mode}") - before
    assert os.listdir(root) == ["wh"] and sorted(os.listdir(f"{root}/wh")) == TABLES
    assert found[0].count() == spark.read.parquet(f"{root}/wh/geodata").count() > 0


def _messages(spark, n):
    """Some times are those of an unset clock, some messages lack a time or are no JSON."""
    ts = [dt.datetime(2025, 6, 15, 10, 30), None, dt.datetime(1, 1, 1)]
    return _env(spark, [("geodata", k % 3, k, ts[k % 3], "{not json" if k % 7 == 6 else _event(location_id=k), n) for k in range(n)])


def test_a_batch_leaves_its_tables_only(spark, tmp_dir):
    env, told = _messages(spark, 70), []
    assert not left_by(spark, lambda: told.append(WH.write_batch(env, 5, tmp_dir)))
    assert sorted(os.listdir(tmp_dir)) == sorted([*TABLES, "_counters", "_quarantine", "_telemetry"])
    assert (told[0]["messages.received"], told[0]["messages.parsed"], told[0]["rejected.document"]) == (70, 60, 10)
    star = WH.read_warehouse(spark, tmp_dir)
    assert sorted(r.location_id for r in star.geodata.collect()) == [k for k in range(70) if k % 7 != 6]
    rejected = spark.read.parquet(f"{tmp_dir}/_quarantine").selectExpr("offset", "value", "cast(timestamp as string) as at").collect()
    assert {(r.offset, r.value, r.at and r.at[:4]) for r in rejected} == {(k, "{not json", ["2025", None, "0001"][k % 3]) for k in range(6, 70, 7)}


def test_a_read_topic_is_deleted_batch_by_batch(spark, tmp_dir):
    assert not left_by(spark, lambda: write_envelope_files(_messages(spark, 60), f"{tmp_dir}/in", 4))
    files = set(glob.glob(f"{tmp_dir}/in/*.json"))
    assert len(files) == 4
    q = WH.start_warehouse_stream(read_envelope_files(spark, f"{tmp_dir}/in", 1, drop_read=True), f"{tmp_dir}/wh", f"{tmp_dir}/ck", {"availableNow": True})
    q.awaitTermination()
    assert len(q.recentProgress) == 4 and WH.read_warehouse(spark, f"{tmp_dir}/wh").geodata.count() == 52
    assert len(files & set(glob.glob(f"{tmp_dir}/in/*.json"))) <= 1  # the last batch's


def test_the_stream_query_keeps_no_messages(spark):
    before = scratch_of(spark, "stream-warehouse")
    QUERIES["stream_warehouse_ingest"][0](spark, SF_SMALL)
    (root,) = scratch_of(spark, "stream-warehouse") - before
    assert sorted(os.listdir(root)) == ["ck", "wh"] and set(os.listdir(f"{root}/wh")) >= set(TABLES)
    assert not [f for f in os.listdir(f"{root}/wh") if f.startswith("_decoded")]
