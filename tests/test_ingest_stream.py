"""Ingest and streaming: completeness (F14), shredding widths (N1), CSV
scans (S1/S2), stream quarantine, in-batch dedup and replay idempotence
(T2, T5, K1), archive enrichment (N4/N5/K3), listings (A18/A19/L5)."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from passante.plans import ingest as I
from passante.plans.model import snowflake
from passante.plans.sqlguard import UnsafeQuery, run_readonly, validate_sql
from passante.schemas import PROFILE_TYPE
from passante.streaming import archive as AR
from passante.streaming import warehouse as WH

FULL = {"idade": {"18-19": .1, "20-29": .2, "30-39": .15, "40-49": .15, "50-59": .1, "60-69": .1,
                  "70-79": .1, "80+": .1},
        "genero": {"F": .55, "M": .45},
        "classe_social": {"A": .05, "B1": .1, "B2": .15, "C1": .2, "C2": .25, "DE": .25}}


def _profiles(spark, items):
    rows = [(json.dumps(p) if p is not None else None,) for p in items]
    return spark.createDataFrame(rows, "t string").select(F.from_json("t", PROFILE_TYPE).alias("target"))


def test_profile_completeness(spark):
    import copy
    cases = [FULL]
    extra = copy.deepcopy(FULL); extra["idade"]["90+"] = 0.0; cases.append(extra)
    zeros = copy.deepcopy(FULL); zeros["genero"] = {"F": 0.0, "M": 0.0}; cases.append(zeros)
    want = [True, True, True]
    for dim, keys in (("idade", list(FULL["idade"])), ("genero", ["F", "M"]), ("classe_social", list(FULL["classe_social"]))):
        for k in keys:
            c = copy.deepcopy(FULL); del c[dim][k]; cases.append(c); want.append(False)
    cases += [None, {"idade": {}, "genero": {}, "classe_social": {}}]
    want += [False, False]
    got = [r[0] for r in _profiles(spark, cases).select(I.profile_complete(F.col("target"))).collect()]
    assert got == want


def test_shred_widths_and_keys(spark):
    ev = spark.createDataFrame([("geodata", 0, 42, 18, 7, 10.5, "-23.5", "-46.6", "SP", "Sao Paulo", "Rua", None,
                                 json.dumps(FULL))],
                               "topic string, partition int, offset long, impression_hour long, location_id long, "
                               "uniques double, latitude string, longitude string, uf_estado string, cidade string, "
                               "endereco string, numero long, t string")
    ev = ev.withColumn("target", F.from_json("t", PROFILE_TYPE)).drop("t")
    sh = I.shred(ev, I.stream_keys(), strict=True)
    widths = {n: len(df.columns) for n, df in sh.tables().items()}
    assert widths == {"age": 9, "gender": 3, "social_class": 7, "target": 4, "geodata": 11}
    g = sh.geodata.first()
    assert g["numero"] == 0
    assert sh.age.first()["id"] == "1a51c0fc-2b4c-5ebf-a96e-e19e86d08b2c"
    assert sh.target.first()["age_id"] == sh.age.first()["id"]


def test_csv_scans(spark, star, tmp_dir):
    rows = I.to_flow_rows(snowflake(star)).limit(50)
    path = f"{tmp_dir}/flow.csv"
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    lenient = I.read_flow_csv(spark, path, "lenient")
    assert lenient.count() == 50
    assert lenient.where(F.col("target").isNull()).count() == 0
    sh = I.shred(I.numbered(lenient), I.bulk_keys(), strict=False)
    assert sh.geodata.count() == 50 and sh.age.select("id").distinct().count() == 50
    bulk = I.read_flow_csv(spark, path, "bulk")
    assert bulk.count() == 50
    with pytest.raises(ValueError):
        I.require_rows(lenient.limit(0))


def _flow_file(path, lines):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(["impression_hour,location_id,uniques,latitude,longitude,uf_estado,cidade,endereco,numero,target", *lines]) + "\n")


def _flow_line(k, profile=FULL):
    return f"7,{k},{k}.5,-23.5,-46.6,SP,Sao Paulo,Rua {k},9,\"{profile}\""


def test_odd_lines_are_skipped_alike_in_every_use(spark, tmp_dir):
    def share(k):
        return FULL | {"genero": {"F": k / 10, "M": 1 - k / 10}}

    lines = [_flow_line(1, share(1)), _flow_line(2, share(2)) + ",extra", "7,3,3.5", _flow_line(4, share(4)),
             _flow_line(5, share(5)).replace("5.5", "much"), _flow_line(6, "{'idade'"), _flow_line(4, share(4))]
    _flow_file(f"{tmp_dir}/in/a.csv", lines)
    df = I.read_flow_csv(spark, f"{tmp_dir}/in")
    assert df.count() == len(df.collect()) == df.select("location_id").count() == 5
    assert I.rejected_records(spark, f"{tmp_dir}/in").count() == 2
    I.load_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/wh", "lenient")
    from passante.sources.testdata import read_star
    star = read_star(spark, f"{tmp_dir}/wh")
    got = sorted((r.location_id, r.uniques, round(r.feminine, 3)) for r in snowflake(star).collect())
    assert got == [(1, 1.5, 0.1), (4, 4.5, 0.4), (4, 4.5, 0.4), (5, 0.0, 0.5)]
    assert star.geodata.select("id").distinct().count() == 4  # equal rows have ids of their own
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        I.read_flow_csv(spark, f"{tmp_dir}/in", "bulk").collect()


def test_wider_files_are_read_by_position(spark, tmp_dir):
    _flow_file(f"{tmp_dir}/in/a.csv", [])
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write("a,b,c,d,e,f,g,h,i,j,k,l\n" + "\n".join(_flow_line(k) + ",x,y" for k in range(5)) + "\n")
    assert I.read_flow_csv(spark, f"{tmp_dir}/in").where("target is not null").count() == 5


def test_bulk_ids_do_not_depend_on_the_splits(spark, tmp_dir):
    _flow_file(f"{tmp_dir}/in/a.csv", [_flow_line(k % 700) for k in range(1000)])

    def ids(split):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        rows = I.numbered(I.read_flow_csv(spark, f"{tmp_dir}/in"))
        return {r.id for r in I.shred(rows, I.bulk_keys(), strict=False).geodata.select("id").collect()}

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        a, b = ids("128m"), ids("16k")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert a == b and len(a) == 1000


def _env(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, "
                                       "value string, high_watermark long")


def _event(**over):
    e = {"impression_hour": 18, "location_id": 1, "uniques": 100.0, "latitude": "-23.5", "longitude": "-46.6",
         "uf_estado": "SP", "cidade": "Sao Paulo", "endereco": "Av", "numero": 10, "target": FULL}
    e.update(over)
    return json.dumps(e)


def test_stream_batch_quarantine_dedup_replay(spark, tmp_dir):
    ts = dt.datetime(2025, 6, 15, 10, 30)
    missing80 = json.loads(_event()); del missing80["target"]["idade"]["80+"]
    rows = [("geodata", 0, 1, ts, _event(), 9),
            ("geodata", 0, 1, ts, _event(), 9),                       # duplicate position
            ("geodata", 0, 2, ts, "{not json", 9),                     # malformed
            ("geodata", 1, 5, ts, json.dumps(missing80), 8),           # incomplete profile
            ("geodata", 1, 6, ts, _event(impression_hour="2026-02-26 18:00:00"), 8),  # wrong type
            ("geodata", 1, 7, ts, _event(location_id=2), 8)]
    env = _env(spark, rows)
    WH.write_batch(env, 0, tmp_dir)
    WH.write_batch(env, 0, tmp_dir)  # replay: same folders overwritten
    star = WH.read_warehouse(spark, tmp_dir)
    assert star.geodata.count() == 2
    assert snowflake(star).count() == 2
    q = spark.read.parquet(f"{tmp_dir}/_quarantine").toPandas()
    assert sorted(q.offset) == [2, 5, 6]
    tel = spark.read.parquet(f"{tmp_dir}/_telemetry").toPandas().set_index("partition")
    assert tel.loc[0, "last_offset"] == 2 and tel.loc[0, "lag"] == 7
    assert tel.loc[1, "lag"] == 1


def test_file_stream_batches(spark, tmp_dir):
    from passante.sources.topic import read_envelope_files
    ts = dt.datetime(2025, 6, 15, 10, 30)
    from passante.sources.topic import write_envelope_files
    for i in range(3):
        write_envelope_files(_env(spark, [("geodata", i, j, ts, _event(location_id=j), j + 1) for j in range(5)]),
                             f"{tmp_dir}/in", files=1, mode="append")
    q = WH.start_warehouse_stream(read_envelope_files(spark, f"{tmp_dir}/in", 1), f"{tmp_dir}/wh",
                                  f"{tmp_dir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    assert len(q.recentProgress) == 3
    assert WH.read_warehouse(spark, f"{tmp_dir}/wh").geodata.count() == 15


def test_archive_enrichment(spark, tmp_dir):
    ts = dt.datetime(2025, 6, 15, 10, 30)
    rows = [("geodata", 3, 42, ts, json.dumps({"target": "{'idade': {'18-19': 0.5}}", "b": 1}), 50),
            ("geodata", 3, 43, ts, json.dumps({"target": {"k": 1}}), 50),
            ("geodata", 3, 44, ts, json.dumps({"x": 1}), 50),
            ("geodata", 3, 45, ts, "not json", 50),
            ("geodata", 3, 46, ts, json.dumps({}), 50),
            ("geodata", 3, 47, None, json.dumps({"target": "not {parsable"}), 50)]
    rec = {r.offset: r for r in AR.enrich_records(_env(spark, rows)).collect()}
    r42 = json.loads(rec[42].record)
    assert r42["target"] == {"idade": {"18-19": 0.5}}
    assert r42["_kafka_partition"] == 3 and r42["_kafka_offset"] == 42
    assert r42["_kafka_timestamp"] == "2025-06-15T10:30:00Z"
    assert list(r42) == sorted(r42)
    assert json.loads(rec[43].record)["target"] == {"k": 1}
    assert "target" not in json.loads(rec[44].record)
    assert rec[45].record is None and rec[45].error == "invalid json"
    assert json.loads(rec[46].record)["_kafka_offset"] == 46
    r47 = json.loads(rec[47].record)
    assert r47["target"] == "not {parsable" and r47["_kafka_timestamp"] == "0001-01-01T00:00:00Z"
    assert rec[47].year == str(dt.datetime.now(dt.timezone.utc).year)
    # archive write, day scan, replay idempotence, manifest
    env = _env(spark, rows[:3])
    AR.write_archive_batch(env, 7, tmp_dir)
    AR.write_archive_batch(env, 7, tmp_dir)
    day = AR.read_archive_day(spark, tmp_dir, dt.date(2025, 6, 15))
    assert day.count() == 3
    man = spark.read.parquet(f"{tmp_dir}/_manifest").first()
    assert (man["first_offset"], man["last_offset"], man["records"]) == (42, 44, 3)
    stats = AR.compact_day(spark, tmp_dir, f"{tmp_dir}/out", dt.date(2025, 6, 15))
    assert stats["written"] and stats["files"] >= 1
    assert AR.compact_day(spark, tmp_dir, f"{tmp_dir}/out", dt.date(2020, 1, 1))["written"] is False


@pytest.mark.parametrize("raw,want", [("", ""), ("   ", ""), ("data", "data/"), ("data/", "data/"),
                                      ("/data", "data/"), ("/data/", "data/"), ("a/b/c", "a/b/c/")])
def test_folder_prefix(raw, want):
    assert AR.normalize_folder_prefix(raw) == want


def test_listing_level_summary_sort(spark, tmp_dir):
    import os
    for p, size in [("a/x.json", 10), ("a/b/y.json", 20), ("top.txt", 5), ("Ábaco/z.json", 1)]:
        os.makedirs(os.path.dirname(f"{tmp_dir}/root/{p}"), exist_ok=True)
        with open(f"{tmp_dir}/root/{p}", "w") as fh:
            fh.write("x" * size)
    objs = AR.list_objects(spark, f"{tmp_dir}/root")
    lvl = AR.list_level(objs, f"{tmp_dir}/root", "")
    got = {(r.kind, r.name): (r.size, r.files) for r in lvl.collect()}
    assert got == {("folder", "a"): (-1, 2), ("file", "top.txt"): (5, 1), ("folder", "Ábaco"): (-1, 1)}
    s = AR.listing_summary(lvl).first()
    assert (s.folders, s.files, s.bytes) == (2, 1, 5)
    order = [r.name for r in AR.search_sort(lvl).collect()]
    assert order == ["a", "Ábaco", "top.txt"]
    order = [r.name for r in AR.search_sort(lvl, ascending=False).collect()]
    assert order == ["Ábaco", "a", "top.txt"]
    sub = AR.list_level(objs, f"{tmp_dir}/root", "/a")
    assert {(r.kind, r.name) for r in sub.collect()} == {("file", "x.json"), ("folder", "b")}
    assert [r.name for r in AR.search_sort(lvl, "TOP").collect()] == ["top.txt"]


@pytest.mark.parametrize("sql,ok", [
    ("SELECT * FROM table", True), ("WITH cte AS (SELECT 1) SELECT * FROM cte", True),
    ("select id from t", True), ("INSERT INTO t VALUES (1)", False), ("DROP TABLE users", False),
    ("SELECT 1; DROP TABLE users", False), ("", False), ("   ", False),
    ("SELECT * FROM t WHERE name = 'DELETE'", False)])
def test_sql_guard(sql, ok):
    assert (validate_sql(sql) is None) == ok


def test_sql_guard_run(spark, star):
    out = run_readonly(spark, "select id from geodata;", star.as_dict())
    assert out.count() == 100
    assert run_readonly(spark, "select id from geodata limit 3", star.as_dict()).count() == 3
    with pytest.raises(UnsafeQuery):
        run_readonly(spark, "delete from geodata", star.as_dict())


def test_cross_batch_dedupe_within_watermark(spark, tmp_dir):
    from passante.sources.topic import read_envelope_files, write_envelope_files
    ts = dt.datetime(2025, 6, 15, 10, 30)
    first = [("geodata", 0, j, ts, _event(location_id=j), 9) for j in range(4)]
    again = [("geodata", 0, 2, ts, _event(location_id=2), 9), ("geodata", 0, 4, ts, _event(location_id=4), 9)]
    write_envelope_files(_env(spark, first), f"{tmp_dir}/in", files=1, mode="append")
    write_envelope_files(_env(spark, again), f"{tmp_dir}/in", files=1, mode="append")
    q = WH.start_warehouse_stream(read_envelope_files(spark, f"{tmp_dir}/in", 1), f"{tmp_dir}/wh",
                                  f"{tmp_dir}/ck", {"availableNow": True}, dedupe_within="1 hour")
    q.awaitTermination()
    g = WH.read_warehouse(spark, f"{tmp_dir}/wh").geodata
    assert g.count() == 5 and g.select("id").distinct().count() == 5


def test_publish_files_and_kafka_gate(spark, star, tmp_dir):
    from passante.sources import topic as TP
    g = star.geodata.limit(20)
    TP.publish_files(g, f"{tmp_dir}/pub")
    out = spark.read.json(f"{tmp_dir}/pub")
    rows = out.collect()
    assert len(rows) == 20 and len({r.key for r in rows}) == 20
    assert {json.loads(r.value)["id"] for r in rows} == {r.id for r in g.collect()}
    if not TP.kafka_available(spark):
        with pytest.raises(RuntimeError):
            TP.read_topic(spark, "localhost:9092", "geodata")
