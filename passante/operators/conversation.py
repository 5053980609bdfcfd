"""Conversation budget (W3): which messages of a chat would be summarised.

Rule: tokens per message = floor(chars / 4); threshold = int(ratio x
context).  Nothing happens while the total is within the threshold.
Otherwise the split point is the earliest of the last 3, 2 or 1 user turns
whose suffix (that turn to the end) fits the threshold -- trying 3 first;
every message before the split is marked for summarisation.  If no suffix
fits, or the split is the first message, nothing is marked.

Plan: the last three user turns come from one salted top-k, which is joined
once (a row per conversation); suffix sums and counts are one conditional
aggregation, so a huge conversation is still combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passante.functions.topk import top_k_per_group

# --- fixed values: summarisation trigger of the agent ---
DEFAULT_CONTEXT = 128_000
TRIGGER_RATIO = 0.75
KEEP_RECENT_TURNS = 3


def estimate_tokens(text) -> F.Column:
    return F.floor(F.coalesce(F.length(text), F.lit(0)) / 4).cast("bigint")


def conversation_budget(conv: DataFrame, context: int = DEFAULT_CONTEXT,
                        ratio: float = TRIGGER_RATIO) -> DataFrame:
    threshold = int(context * ratio)
    m = conv.select("conv_id", "turn", "role", estimate_tokens(F.col("text")).alias("tokens"))
    # the last three distinct user turns: a salted top-k, so a long conversation is ranked by many tasks
    users = m.where(F.col("role") == "user").select("conv_id", "turn").distinct()
    last = top_k_per_group(users, ["conv_id"], [F.col("turn").desc()], KEEP_RECENT_TURNS, salt_cols=["turn"])
    marks = last.groupBy("conv_id").agg(*[F.max(F.when(F.col("rank") == k, F.col("turn"))).alias(f"u{k}") for k in (1, 2, 3)])
    j = m.join(marks, "conv_id", "left")
    aggs = [F.count(F.lit(1)).alias("n_messages"), F.sum("tokens").alias("total_tokens"),
            F.first("u1", ignorenulls=True).alias("u1"), F.first("u2", ignorenulls=True).alias("u2"),
            F.first("u3", ignorenulls=True).alias("u3")]
    for k in ("u1", "u2", "u3"):
        aggs.append(F.sum(F.when(F.col("turn") >= F.col(k), F.col("tokens"))).alias(f"kept_{k}"))
        aggs.append(F.count(F.when(F.col("turn") < F.col(k), 1)).alias(f"before_{k}"))
    a = j.groupBy("conv_id").agg(*aggs)
    thr = F.lit(threshold)
    triggered = F.col("total_tokens") > thr
    fits = {k: F.col(k).isNotNull() & (F.coalesce(F.col(f"kept_{k}"), F.lit(0)) <= thr) for k in ("u3", "u2", "u1")}
    split = (F.when(~triggered, F.lit(None))
             .when(fits["u3"], F.col("u3")).when(fits["u2"], F.col("u2")).when(fits["u1"], F.col("u1")))
    kept = (F.when(~triggered, F.lit(None))
            .when(fits["u3"], F.col("kept_u3")).when(fits["u2"], F.col("kept_u2")).when(fits["u1"], F.col("kept_u1")))
    before = (F.when(~triggered, F.lit(0))
              .when(fits["u3"], F.col("before_u3")).when(fits["u2"], F.col("before_u2"))
              .when(fits["u1"], F.col("before_u1")).otherwise(F.lit(0)))
    return a.select(
        "conv_id", "n_messages", "total_tokens", F.lit(threshold).cast("bigint").alias("threshold"),
        triggered.alias("triggered"),
        F.when(before > 0, split).cast("bigint").alias("split_turn"),
        F.when(before > 0, kept).cast("bigint").alias("kept_tokens"),
        before.cast("bigint").alias("n_marked"))
