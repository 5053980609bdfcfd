"""Dataset contract (F15), upload/switch (S8), export (K6), vocabulary
(J9), embeddings (J8), stream fan-out (T8), live aggregates (T9, T10)."""
import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from passante.operators import embeddings as EM
from passante.operators.vocabulary import brief_filters, term_matches
from passante.plans import datasets as DS


def test_contract_names_missing_column(star):
    with pytest.raises(DS.MissingColumn) as e:
        DS.ingest_summary(star.geodata.drop("uniques"))
    assert e.value.column == "uniques"
    s = DS.ingest_summary(star.geodata).first()
    assert s.records == star.geodata.count() and 0 <= s.min_hour <= s.max_hour <= 23
    bad = star.geodata.where(F.col("latitude").try_cast("double").isNull()).count()
    assert s.bad_coordinates == bad and s.bad_hours == 0


def test_dataset_switch_and_export(spark, star, tmp_dir):
    g = star.geodata
    DS.register_dataset(g.limit(10), tmp_dir, "sp")
    DS.register_dataset(g.limit(7), tmp_dir, "rj")
    DS.register_dataset(g.limit(5), tmp_dir, "sp")  # re-upload replaces only "sp"
    assert [r.dataset for r in DS.list_datasets(spark, tmp_dir).collect()] == ["rj", "sp"]
    assert DS.use_dataset(spark, tmp_dir, "sp").count() == 5
    assert DS.use_dataset(spark, tmp_dir, "rj").count() == 7
    agg = g.groupBy("uf_estado").agg(F.sum("uniques").alias("flow"))
    DS.export_aggregate(agg, f"{tmp_dir}/exp", {"period": "2024-01", "filters": {"uf": ["ASIA"]}, "dataset": "sp"})
    meta = json.loads(spark.read.text(f"{tmp_dir}/exp/_metadata").first()[0])
    assert meta["dataset"] == "sp"
    assert spark.read.option("header", True).csv(f"{tmp_dir}/exp/data").count() == agg.count()


def test_vocabulary(spark):
    msgs = spark.createDataFrame([
        (1, 0, "Quero atingir mulheres jovens da classe média-alta, bem perto do metrô, top 3"),
        (1, 1, "na verdade classe média"),
        (2, 0, "nada relevante aqui"),
    ], "conv_id long, turn long, text string")
    m = term_matches(msgs)
    assert m.where(F.col("conv_id") == 2).count() == 0
    got = {(r.conv_id, r.field): r.value for r in brief_filters(msgs, ["conv_id"]).collect()}
    assert got[(1, "gender")] == "female" and got[(1, "age")] == "18-29"
    assert got[(1, "classes")] == "A,B1"  # longest (most specific) term wins
    assert got[(1, "radius_km")] == "0.5" and got[(1, "limit")] == "3"


def test_embedding_topk_matches_numpy(tables):
    pdf = tables.embeddings.toPandas()
    got = EM.centroid_topk(tables.embeddings, 3).toPandas()
    for lab, g in pdf.groupby("label"):
        m = np.vstack(g.embedding.map(lambda v: np.asarray(v, dtype=np.float64)))
        c = m.mean(axis=0)
        sc = m @ c / (np.linalg.norm(m, axis=1) * np.linalg.norm(c))
        order = sorted(zip(-sc, g.vec_id))[:3]
        want = [v for _, v in order]
        assert list(got[got.label == lab].sort_values("rank").vec_id) == want


def test_fan_out_two_streams(spark, tmp_dir):
    from passante.sources.topic import read_envelope_files, write_envelope_files
    from passante.streaming import archive as AR
    from passante.streaming import warehouse as WH
    from passante.streaming import live as LV
    ts = dt.datetime(2025, 6, 15, 10, 30)
    prof = {"idade": {k: 0.125 for k in ["18-19", "20-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+"]},
            "genero": {"F": 0.5, "M": 0.5}, "classe_social": {k: 1 / 6 for k in ["A", "B1", "B2", "C1", "C2", "DE"]}}
    rows = [("geodata", p, o, ts + dt.timedelta(minutes=o),
             json.dumps({"impression_hour": 8, "location_id": o % 3, "uniques": 1.0 + o, "latitude": "-23.5",
                         "longitude": "-46.6", "uf_estado": "SP", "cidade": "X", "endereco": "Y", "numero": 1,
                         "target": prof}), o + 2)
            for p in range(2) for o in range(6)]
    env = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, "
                                      "value string, high_watermark long")
    write_envelope_files(env, f"{tmp_dir}/in", files=3)
    src = lambda: read_envelope_files(spark, f"{tmp_dir}/in", 1)
    q1 = WH.start_warehouse_stream(src(), f"{tmp_dir}/wh", f"{tmp_dir}/ck1", {"availableNow": True})
    q2 = AR.start_archive_stream(src(), f"{tmp_dir}/ar", f"{tmp_dir}/ck2", {"availableNow": True})
    q3 = LV.start_live(src(), f"{tmp_dir}/live", "flow", f"{tmp_dir}/ck3", {"availableNow": True})
    q4 = LV.start_live(src(), f"{tmp_dir}/latest", "latest", f"{tmp_dir}/ck4", {"availableNow": True})
    for q in (q1, q2, q3, q4):
        q.awaitTermination()
    assert WH.read_warehouse(spark, f"{tmp_dir}/wh").geodata.count() == 12
    assert AR.read_archive(spark, f"{tmp_dir}/ar").count() == 12
    cur = {r.location_id: r.flow for r in LV.read_current(spark, f"{tmp_dir}/live", ["location_id", "impression_hour"]).collect()}
    assert cur == {0: 2 * (1 + 4), 1: 2 * (2 + 5), 2: 2 * (3 + 6)}
    lat = {r.location_id: r.offset for r in LV.read_current(spark, f"{tmp_dir}/latest", ["location_id"]).collect()}
    assert lat == {0: 3, 1: 4, 2: 5}
    from passante.streaming.monitor import flush_histogram, progress_frame, source_lag
    pf = progress_frame(spark, q1).collect()
    assert len(pf) == 3 and sum(r.rows for r in pf) == 12
    hist = {r.le: r["count"] for r in flush_histogram(spark.read.parquet(f"{tmp_dir}/wh/_telemetry")).collect()}
    assert hist[1.0] == 0 and hist[10.0] == 3 and hist[float("inf")] == 3
    fake = [{"batchId": 4, "sources": [{"endOffset": '{"geodata": {"0": 10, "1": 7}}',
                                        "latestOffset": '{"geodata": {"0": 15, "1": 7}}'}]}]
    assert sorted(source_lag(fake)) == [(4, "geodata", 0, 10, 15, 5), (4, "geodata", 1, 7, 7, 0)]


def test_messages_are_those_of_the_joined_tables(spark, tmp_dir):
    """Also of repeated ids, of events without an id or a time; built by one exchange of the events by id."""
    import json

    from passante.sources import fixtures as X
    from passante.sources.testdata import Tables
    from conftest import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_id < 300")
    odd = (ev.unionByName(ev.where("event_id in (3, 96)").withColumn("ts", F.expr("ts + interval 7 hours")))
           .unionByName(ev.where("event_id = 5").withColumn("ts", F.lit(None).cast(ev.schema["ts"].dataType)))
           .unionByName(ev.where("event_id = 6").withColumn("event_id", F.lit(None).cast("bigint"))))
    odd.coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_dir}/{name}.parquet")
    t = Tables(spark, tmp_dir)
    messages = X.fx_messages(t)
    profile = X.fx_target(t).select(F.col("id").alias("target_id"), "age_id", "gender_id").join(
        X.fx_gender(t).withColumnRenamed("id", "gender_id"), "gender_id").join(X.fx_age(t).withColumnRenamed("id", "age_id"), "age_id").join(
        X.fx_social_class(t).select(F.concat(F.lit("t"), F.substring("id", 2, 20)).alias("target_id"), "a_class"), "target_id")
    g, env = X.fx_geodata(t), X.fx_envelope(t)
    want = (g.join(profile.select("target_id", "feminine", "x18_19", "a_class"), "target_id", "left")
            .join(env, g.id == F.concat(F.lit("g"), env.event_id.cast("string"))))
    want = sorted((r.kafka_partition, r.kafka_offset, str(r.kafka_timestamp), r.high_watermark, r.location_id, r.feminine, r.x18_19, r.a_class)
                  for r in want.collect())
    found = []
    for r in messages.collect():
        v = json.loads(r.value)
        p = v.get("target") or {"genero": {}, "idade": {}, "classe_social": {}}
        found.append((r.partition, r.offset, str(r.timestamp), r.high_watermark, v["location_id"], p["genero"].get("F"), p["idade"].get("18-19"), p["classe_social"].get("A")))
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    assert sorted(found, key=key) == sorted(want, key=key)
    # the profile tables are no longer joined: customer, nation, region and the ends of the polls are
    assert messages._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 4
