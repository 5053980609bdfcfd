import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from passante.operators import telemetry
from passante.sources.topic import read_envelope_files, write_envelope_files
from passante.streaming import flush, warehouse

ENVELOPE = "topic string, partition int, offset bigint, timestamp timestamp, value string, high_watermark bigint"


def plain_flushes(rows, size, seconds):
    """The rule, message by message: (partition, offset) -> flush."""
    out = {}
    for p in sorted({r[0] for r in rows}):
        number, held, opened, clock = 0, 0, None, -10**12
        for _, offset, second in sorted(r for r in rows if r[0] == p):
            clock = clock if second is None else max(clock, second)
            if held and (held >= size or clock >= opened + seconds):
                number, held = number + 1, 0
            opened = clock if held == 0 else opened
            held += 1
            out[p, offset] = number
    return out


def messages(spark, rows):
    return spark.createDataFrame([("t", p, o, s, "{}", None) for p, o, s in rows], "topic string, partition int, offset bigint, s double, value string, high_watermark bigint") \
        .select("topic", "partition", "offset", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("timestamp"), "value", "high_watermark")


def drain(spark, parts, root, **options):
    for k, part in enumerate(parts):
        write_envelope_files(messages(spark, part), f"{root}/in/slice={k}", 3)
        flush.start_flush_stream(read_envelope_files(spark, f"{root}/in/slice=*"), f"{root}/out", f"{root}/ck", {"availableNow": True}, **options).awaitTermination()
    return flush.read_placed(spark, f"{root}/out")


@pytest.fixture()
def topic():
    rnd = random.Random(5)
    rows, clock = [], [0.0] * 3
    for offset in range(400):
        for p in range(3):
            clock[p] += rnd.choice([0, 0.5, 1, 4]) * (1, 3, 0.01)[p]
            rows.append((p, offset, None if rnd.random() < 0.02 else clock[p] - (2 if rnd.random() < 0.05 else 0)))
    return rows


def test_flushes_equal_the_rule_however_the_topic_is_cut(spark, topic, tmp_dir):
    want = plain_flushes(topic, 20, 30)
    cuts = {"once": [topic], "thirds": [[r for r in topic if k * 140 <= r[1] < (k + 1) * 140] for k in range(3)]}
    for name, parts in cuts.items():
        found = drain(spark, parts, f"{tmp_dir}/{name}", size=20, interval="30 seconds").collect()
        assert len(found) == len(topic) and {(r.partition, r.offset): r.flush for r in found} == want, name


def test_flush_log_of_a_restarted_stream(spark, topic, tmp_dir):
    parts = [[r for r in topic if r[1] < 150], [r for r in topic if r[1] >= 150]]
    log = flush.flush_log(drain(spark, parts, tmp_dir, size=20, interval="30 seconds"), 20).collect()
    want = plain_flushes(topic, 20, 30)
    for r in log:
        mine = sorted(o for (p, o), f in want.items() if (p, f) == (r.partition, r.flush))
        newest = max(f for (p, _), f in want.items() if p == r.partition)
        assert (r.first_offset, r.last_offset, r.events) == (mine[0], mine[-1], len(mine))
        assert r.reason == ("size" if len(mine) == 20 else "time" if r.flush < newest else "open")
        assert r.lag == (149 if mine[-1] < 150 else 399) - mine[-1]
    assert {r.reason for r in log} == {"size", "time", "open"} and sum(r.events for r in log) == len(topic)


def test_place_of_long_runs():
    times = np.sort(np.random.default_rng(1).integers(0, 10_000, 5000))
    rows = [(0, i, int(t)) for i, t in enumerate(times)]
    for size, interval in ((500, 30), (7, 3), (1, 100), (10_000, 1), (10_000, 10**9)):
        want = plain_flushes(rows, size, interval)
        got, last, events, _ = flush.place(times, 0, 0, flush.NEVER, size, interval)
        assert got.tolist() == [want[0, i] for i in range(len(times))]
        assert last == got[-1] and events == (got == last).sum()
    assert flush.place(times[:0], 3, 2, 5, 10, 10)[1:] == (3, 2, 5)


def test_counters_of_bad_and_empty_batches(spark, tmp_dir):
    rows = [("t", 0, k, "not json") for k in range(7)]
    bad = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string") \
        .select("*", F.current_timestamp().alias("timestamp"), F.lit(None).cast("bigint").alias("high_watermark"))
    told = warehouse.write_batch(bad, 0, tmp_dir)
    assert told["messages.received"] == told["rejected.document"] == 7 and told["messages.parsed"] == told["rows.geodata"] == 0
    empty = warehouse.write_batch(bad.limit(0), 1, tmp_dir)
    assert empty["messages.received"] == empty["rows.age"] == 0
    found = {(r.batch_id, r.counter, r.label): (r.topic, r.value) for r in warehouse.read_counters(spark, tmp_dir).collect()}
    assert found[0, "rejected", "document"] == ("t", 7) and found[1, "messages", "received"] == ("unknown", 0)


def test_merged_sketches_keep_the_rank_error(spark):
    values = spark.range(300_000).select((F.col("id") % 31).alias("part"), F.pow(F.rand(3), 4).alias("v")).persist()
    found = telemetry.sketch_panel(telemetry.quantile_sketches(values, ["part"], "v"), []).first()
    assert found.n == 300_000
    for name, q in telemetry.PANEL.items():
        rank = values.where(F.col("v") <= found[name]).count() / 300_000
        assert abs(rank - q) <= telemetry.RANK_ERROR, (name, rank)
    values.unpersist()


def test_polled_watermark_is_the_last_offset_of_the_poll(tables):
    from passante.sources.fixtures import POLL_HOURS, fx_envelope
    rows = fx_envelope(tables).collect()
    ends = {}
    for r in rows:
        key = (r.kafka_partition, r.kafka_timestamp.day, r.kafka_timestamp.hour // POLL_HOURS)
        ends[key] = max(ends.get(key, -1), r.kafka_offset)
    assert all(r.high_watermark == ends[r.kafka_partition, r.kafka_timestamp.day, r.kafka_timestamp.hour // POLL_HOURS] for r in rows)
