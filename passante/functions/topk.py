"""Skew-safe top-k per group.

``row_number() <= k`` over ``partitionBy(keys)`` is planned with a partial
WindowGroupLimit only when a shuffle on the keys follows; if the input is
already partitioned by the keys (e.g. right after a join on them) one hot
key is ranked by a single task.  The two-stage form first ranks inside
(keys, salt) -- a shuffle that spreads a hot key over ``buckets`` tasks --
keeps k per salt, then ranks the at most ``buckets * k`` survivors per key.
The result is exactly the top-k of the single-stage form (the order columns
must make the ranking total, e.g. end with a unique id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passante.session import ensure_window_group_limit


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    salt_cols: list[str], buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    ensure_window_group_limit(df.sparkSession, k)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(buckets))
    # one column for keys and salt: a partitioning by some of the keys (a join's) does not satisfy it,
    # so the salted stage has its own shuffle, with the group limit before it
    grouped = df.withColumn("__group", F.struct(*keys, salt.alias("__salt")))
    w1 = Window.partitionBy("__group").orderBy(*order)
    first = grouped.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k).drop("__r1", "__group")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return first.withColumn(rank_col, F.row_number().over(w2).cast("bigint")).where(F.col(rank_col) <= k)
