"""Rank of every row within its group, without a task per group.

Rows are cut into ranges of the score (quantiles of all rows, at most ``parts``).  Within
a group, a row's rank is the number of its group's rows in better ranges (a count per group and
range, summed up in order) and its place within its own range.  A score that is frequent enough
to be a quantile is a range of its own, cut again by quantiles of the tie breaker, so
neither a group nor a score with a third of all rows lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 200


def ranked(rows: DataFrame, group: list[str], score: str, tie: str, parts: int = PARTS, rank: str = "rank") -> DataFrame:
    """``rows`` with their 1-based rank by descending ``score`` and ascending ``tie``
    (numbers).  ``rows`` is read three times: pass a stored table.  A null score comes last,
    a null tie first."""
    shares = [k / parts for k in range(1, parts)]
    at = rows.agg(*[F.percentile_approx(c, shares, 100 * parts).alias(n) for c, n in ((score, "scores"), (tie, "ties"))]).first()
    scores, ties = (sorted(set(x or [])) for x in at)  # at most ``parts`` numbers each
    edges = F.array(*[F.lit(x) for x in scores]) if scores else F.array().cast("array<double>")
    cuts = F.array(*[F.lit(x) for x in ties]) if ties else F.array().cast("array<bigint>")
    # even: between two quantiles, odd: on one
    own = F.array_contains(edges, F.col(score)).cast("int")
    area = 2 * F.size(F.filter(edges, lambda x: x < F.col(score))) + own
    # ranges of one score (or of none) are cut by the tie breaker
    alone = F.col(score).isNull() | (own == 1)
    sub = F.when(alone & F.col(tie).isNotNull(), F.size(F.filter(cuts, lambda x: x < F.col(tie)))).when(alone, F.lit(-1)).otherwise(F.lit(0))
    cut = rows.withColumns({"__area": F.coalesce(area, F.lit(-1)), "__sub": sub})
    key = [*group, "__area", "__sub"]
    counts = cut.groupBy(*key).agg(F.count("*").alias("__n"))
    better = Window.partitionBy(*group).orderBy(F.desc("__area"), "__sub").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"__of_{c}") for c in key], F.coalesce(F.sum("__n").over(better), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*key).orderBy(F.col(score).desc_nulls_last(), F.col(tie).asc_nulls_first())
    place = F.row_number().over(within)
    joined = cut.withColumn("__place", place).join(before, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in key])
    return joined.select(*rows.columns, (F.col("__before") + F.col("__place")).alias(rank))
