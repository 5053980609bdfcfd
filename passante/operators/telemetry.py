"""Ingest telemetry as DataFrame operators.

The reference keeps these as process metrics; here they are computed from
the message envelope (topic, partition, offset, timestamp, high watermark)
of a micro-batch or of the whole archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passante.schemas import PARTITION_LAG_BUCKETS


def partition_lag(env: DataFrame, topic: str = "topic", partition: str = "kafka_partition",
                  offset: str = "kafka_offset", hw: str = "high_watermark") -> DataFrame:
    """Per (topic, partition) the last offset seen and the lag of the
    partition at that message: its high watermark minus that offset."""
    g = env.groupBy(topic, partition).agg(
        F.max(offset).alias("last_offset"),
        F.max_by(hw, offset).alias("high_watermark"),
        F.count(F.lit(1)).alias("messages"))
    return g.withColumn("lag", F.col("high_watermark") - F.col("last_offset"))


def message_lag(env: DataFrame, offset: str = "kafka_offset", hw: str = "high_watermark") -> DataFrame:
    return env.withColumn("lag", F.col(hw) - F.col(offset))


def cumulative_histogram(df: DataFrame, value: str, buckets: list[float],
                         group_cols: list[str] | None = None) -> DataFrame:
    """Prometheus-style cumulative buckets: one row per upper bound
    ``le`` (plus +Inf) with the count of values <= le.  One pass of
    conditional sums, partial-aggregated map-side."""
    gc = list(group_cols or [])
    aggs = [F.sum(F.when(F.col(value) <= F.lit(b), 1).otherwise(0)).alias(f"b{i}") for i, b in enumerate(buckets)]
    aggs += [F.count(F.col(value)).alias("b_inf"), F.sum(value).alias("sum")]
    g = df.groupBy(*gc).agg(*aggs) if gc else df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").cast("bigint").alias("count"))
                    for i, b in enumerate(buckets)],
                  F.struct(F.lit(float("inf")).alias("le"), F.col("b_inf").cast("bigint").alias("count")))
    return g.select(*gc, F.inline(arr))


def lag_histogram(env: DataFrame) -> DataFrame:
    return cumulative_histogram(message_lag(env), "lag", PARTITION_LAG_BUCKETS)


def lag_percentiles(env: DataFrame, exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """p50/p95/p99 of per-message lag, by a bounded sketch.  ``exact``
    interpolates between exact ranks; its buffer has an entry per distinct lag,
    so it is for lags that are known to be few."""
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    of = (lambda p: F.percentile("lag", p)) if exact else (lambda p: F.percentile_approx("lag", p, accuracy).cast("double"))
    return message_lag(env).agg(*[of(p).alias(n) for n, p in names.items()], F.count(F.lit(1)).alias("messages"))


def rate_panel(records: DataFrame, ts: str = "kafka_timestamp", error: str = "is_error",
               window: str = "5 minutes") -> DataFrame:
    """Per tumbling window, messages, rate per second and error ratio."""
    import re
    m = re.match(r"(\d+)\s*minutes?", window)
    seconds = int(m.group(1)) * 60 if m else 300
    g = records.groupBy(F.window(F.col(ts), window).alias("w")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.col(error).cast("int")).alias("errors"))
    return g.select(F.col("w.start").alias("window_start"), "messages",
                    (F.col("messages") / F.lit(float(seconds))).alias("rate_per_s"),
                    (F.col("errors") / F.col("messages")).alias("error_ratio"))


#: Quantiles of a panel.
PANEL = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
#: Size of a quantile sketch (KLL): a group of fewer values is kept exactly, of more with
#: a rank error below ``RANK_ERROR`` (at 99 % confidence).
SKETCH_K = 4096
RANK_ERROR = 0.002


def quantile_sketches(records: DataFrame, by: list[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """A mergeable sketch (some 40 KB at most, however many rows) of ``value`` per
    group: what an ingest stores so that a panel need not read the records again."""
    return records.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def sketch_panel(sketches: DataFrame, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """Quantiles per group of ``by`` (coarser than the stored groups), from merged sketches."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in PANEL.items()],
                         F.kll_sketch_get_n_double("sketch").alias("n"))
