"""Stream telemetry from query progress (T7, S6) and flush histograms.

Progress is pulled from ``StreamingQuery.recentProgress`` (a bounded ring of
the last updates kept by Spark), so no callback server is needed.  For a
Kafka source each progress carries ``endOffset`` (what the batch read up to)
and ``latestOffset`` (the log end when the batch was planned): their
difference per partition is the lag the reference derives from the high
watermark.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.operators.telemetry import cumulative_histogram
from passante.schemas import FLUSH_EVENT_BUCKETS


def _offsets(text) -> dict:
    if not text:
        return {}
    try:
        v = json.loads(text) if isinstance(text, str) else text
    except (TypeError, ValueError):
        return {}
    return v if isinstance(v, dict) else {}


def progress_rows(progress: list[dict]) -> list[tuple]:
    """(batch_id, rows, input_rps, processed_rps, duration_ms) per update."""
    out = []
    for p in progress:
        out.append((int(p.get("batchId", -1)), int(p.get("numInputRows", 0)),
                    float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0),
                    int((p.get("durationMs") or {}).get("triggerExecution", 0))))
    return out


def source_lag(progress: list[dict]) -> list[tuple]:
    """(batch_id, topic, partition, end_offset, latest_offset, lag) for
    every Kafka-style source offset map in the progress updates."""
    out = []
    for p in progress:
        for src in p.get("sources", []):
            end, latest = _offsets(src.get("endOffset")), _offsets(src.get("latestOffset"))
            for topic, parts in end.items():
                if not isinstance(parts, dict):
                    continue
                for part, off in parts.items():
                    lat = (latest.get(topic) or {}).get(part) if isinstance(latest.get(topic), dict) else None
                    out.append((int(p.get("batchId", -1)), topic, int(part), int(off),
                                None if lat is None else int(lat), None if lat is None else int(lat) - int(off)))
    return out


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """The query's recent progress as a small DataFrame (bounded by
    ``spark.sql.streaming.numRecentProgressUpdates``)."""
    return spark.createDataFrame(progress_rows(list(query.recentProgress)),
                                 "batch_id long, rows long, input_rps double, processed_rps double, duration_ms long")


def flush_histogram(telemetry: DataFrame) -> DataFrame:
    """Cumulative histogram of events per flush (micro-batch) from the
    per-(batch, topic, partition) telemetry the warehouse stream writes."""
    per_batch = telemetry.groupBy("batch_id").agg(F.sum("messages").alias("events"))
    return cumulative_histogram(per_batch, "events", FLUSH_EVENT_BUCKETS)
