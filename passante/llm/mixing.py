"""Mixing sources to target weights by entropy balancing.

Each source has a token constraint: its documents' words, times their rates,
sum to its target.  Among all rates that meet the constraints, entropy
balancing takes those closest to 1 for every document; by convex duality they
are exponentially tilted, rate = exp(lambda_source * size / mean size), cut off
at ``MOST`` copies.  The duals are found by Newton iterations: every iteration
is one aggregation over the (source, size) counts of all documents, which give
the constraint's value and slope at the present duals; a bracket per source
replaces a step that would leave it.  Rates are rounded into copies at random
(a hash of the document) and the few words that rounding leaves over are
mended, by a copy more or less of some documents, inside groups of about ``GROUP`` documents, so a source with any share
of all rows is spread over many tasks.

The driver holds one number per source (weights are given per source, at most
``SOURCE_BOUND`` of them), never anything per document.

Defined cases: a null or empty text has size 0, rate 1 and takes no words; a
null source is a source of its own, the last; null ids are ids like any other.
Repeated rows share their copies evenly.  A source of no words has target 0.
An empty table gives an empty result.  All columns of the documents stay in
``mix``; working columns begin with ``__mix``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passante.llm.common import written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often, so no target is larger than this times its source.
MOST = 3
GROUP = 4096
SOURCE_BOUND = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def capped_shares(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Share the sum of ``sizes`` by weight; what is above ``most`` times a size
    is shared again by weight among the others until none is above."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in above:
            targets[i] = float(most * sizes[i])
        open_.difference_update(above)
        left = float(sum(sizes)) - sum(targets)
    return targets


@dataclass
class Plan:
    """One entry per source, in code point order with null last."""

    sources: list[str | None]
    docs: list[int]
    sizes: list[int]
    targets: list[float]
    duals: list[float]

    def frame(self, spark) -> DataFrame:
        """(__mix_source, __mix_s, __mix_total, __mix_target, __mix_scaled, __mix_inverse, __mix_groups): at most SOURCE_BOUND rows."""
        rows = [(s, i, n, t, d * c / n if n else 0.0, c / n if n else 0.0, max(1, math.ceil(c / GROUP)))
                for i, (s, c, n, t, d) in enumerate(zip(self.sources, self.docs, self.sizes, self.targets, self.duals, strict=True))]
        return spark.createDataFrame(rows, "__mix_source string, __mix_s int, __mix_total bigint, __mix_target double, __mix_scaled double, __mix_inverse double, __mix_groups int")


def with_source(df: DataFrame, plan: DataFrame) -> DataFrame:
    return df.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("__mix_source"))).drop("__mix_source")


def rate():
    """exp(lambda * size / mean), at most MOST; __mix_scaled is lambda / mean."""
    return F.exp(F.least(F.col("__mix_scaled") * F.col("__mix_size"), F.lit(math.log(MOST))))


def balance(counts: DataFrame, plan: Plan, tolerance: float = 1e-9, steps: int = 200) -> None:
    """Newton iterations on the duals of ``plan``, in place.  ``counts`` has
    (source, __mix_size, __mix_n)."""
    mean = [n / c if c else 0.0 for n, c in zip(plan.sizes, plan.docs, strict=True)]
    low = [-60.0 * m - 60 for m in mean]  # all rates vanish
    high = [1.2 * m + 1 for m in mean]  # even a single word's rate is MOST
    todo = set()
    for i, (n, t) in enumerate(zip(plan.sizes, plan.targets, strict=True)):
        if n and t >= MOST * n:
            plan.duals[i] = high[i]
        elif n and t != n:
            todo.add(i)
    for _ in range(steps):
        if not todo:
            return
        tilted = F.col("__mix_n") * F.col("__mix_size") * rate()
        z = F.col("__mix_size") * F.col("__mix_inverse")
        # above the cut-off a document's words do not change with the dual
        slope = F.when(F.col("__mix_scaled") * F.col("__mix_size") < math.log(MOST), tilted * z).otherwise(0.0)
        spark = counts.sparkSession
        now = plan.frame(spark).where(F.col("__mix_s").isin(*todo)) if len(todo) < 100 else plan.frame(spark)
        found = (with_source(counts, now)
                 .groupBy("__mix_s").agg(F.sum(tilted).alias("value"), F.sum(slope).alias("slope")).collect())
        for r in found:
            i = r["__mix_s"]
            if i not in todo:
                continue
            off = r.value - plan.targets[i]
            if abs(off) <= tolerance * plan.targets[i] or high[i] - low[i] <= 1e-13 * (1 + abs(low[i])):
                todo.discard(i)
                continue
            if off > 0:
                high[i] = plan.duals[i]
            else:
                low[i] = plan.duals[i]
            step = plan.duals[i] - off / r.slope if r.slope else math.nan
            plan.duals[i] = step if low[i] < step < high[i] else (low[i] + high[i]) / 2
    raise RuntimeError(f"no convergence for {len(todo)} sources in {steps} steps")


def rounded(group: pd.DataFrame) -> pd.DataFrame:
    """Copies of one group's documents; ``n`` equal rows share ``extra`` copies
    beyond ``base`` each."""
    size, n, r, u = (group[c].to_numpy() for c in ("__mix_size", "__mix_n", "__mix_rate", "__mix_u"))
    base = np.floor(r + 1e-12).astype(np.int64)
    part = np.maximum(r - base, 0.0)
    extra = np.where(part > 0, np.floor(part * n + u), 0).astype(np.int64)
    copies = base * n + extra
    left = float(((r * n - copies) * size).sum())  # words still to be taken, or taken too many
    # first between the two whole numbers around a rate, then, for what is left, within 0 and MOST
    for low, high in ((base * n, base * n + np.where(part > 0, n, 0)), (0 * n, MOST * n)):
        for i in np.lexsort((u, -size)):
            if size[i] == 0 or 2 * abs(left) <= size[i]:
                continue
            more = max(int(low[i] - copies[i]), min(int(high[i] - copies[i]), round(left / size[i])))
            copies[i] += more
            left -= more * float(size[i])
    return group[["__mix_key", "__mix_n"]].assign(__mix_base=copies // n, __mix_extra=copies % n)


def row_key():
    """A key of equal rows that is never null."""
    return F.concat_ws("|", F.col("doc_id").isNull().cast("int"), F.col("doc_id").cast("string"), "__mix_s", "__mix_size")


class Mixer:
    """Targets, duals and copies for the documents of a table."""

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = WEIGHTS):
        spark = docs.sparkSession
        sized = written(docs.select("doc_id", "source", word_count("text").alias("__mix_size")), "mix-sizes")
        counts = sized.groupBy("source", "__mix_size").agg(F.count("*").alias("__mix_n"))
        counts = written(counts, "mix-counts")
        totals = (counts.groupBy("source").agg(F.sum("__mix_n").alias("docs"), F.sum(F.col("__mix_n") * F.col("__mix_size")).alias("words"))
                  .orderBy(F.col("source").asc_nulls_last()).limit(SOURCE_BOUND + 1).collect())
        if len(totals) > SOURCE_BOUND:
            raise ValueError(f"more than {SOURCE_BOUND} sources")
        words = [r.words for r in totals]
        targets = capped_shares(words, [weights[i % len(weights)] for i in range(len(totals))])
        self.plan = Plan([r.source for r in totals], [r.docs for r in totals], words, targets, [0.0] * len(totals))
        balance(counts, self.plan)
        self.frame = self.plan.frame(spark)
        self.sized = with_source(sized, self.frame)

    def copies(self) -> DataFrame:
        """(__mix_key, __mix_n, __mix_base, __mix_extra) for every key of equal rows."""
        keyed = (self.sized.groupBy(row_key().alias("__mix_key"), "__mix_s", "__mix_size", "__mix_scaled", "__mix_groups")
                 .agg(F.count("*").alias("__mix_n")))
        u = F.shiftrightunsigned(F.xxhash64(F.lit("u"), "__mix_key"), 11).cast("double") / float(1 << 53)
        return (keyed.select("__mix_key", "__mix_s", "__mix_size", "__mix_n", rate().alias("__mix_rate"), u.alias("__mix_u"),
                             F.pmod(F.xxhash64("__mix_key"), F.col("__mix_groups")).alias("__mix_group"))
                .groupBy("__mix_s", "__mix_group")
                .applyInPandas(rounded, "__mix_key string, __mix_n bigint, __mix_base bigint, __mix_extra bigint"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken and copies of every row."""
        return (self._row_copies(self.sized)
                .select("doc_id", F.col("__mix_size").alias("size"), F.col("__mix_total").alias("source_size"),
                        F.col("__mix_target").alias("target"), (F.col("__mix_copies") * F.col("__mix_size")).alias("taken"),
                        F.col("__mix_copies").alias("copies")))

    def _row_copies(self, rows: DataFrame) -> DataFrame:
        numbered = (rows.withColumn("__mix_key", row_key())
                    .withColumn("__mix_j", F.row_number().over(Window.partitionBy("__mix_key").orderBy("__mix_size"))))
        copies = F.col("__mix_base") + (F.col("__mix_j") <= F.col("__mix_extra")).cast("bigint")
        return numbered.join(self.copies(), "__mix_key").withColumn("__mix_copies", copies)

    def mix(self, docs: DataFrame) -> DataFrame:
        """``docs`` (the table given) with each row as often as it is taken."""
        rows = with_source(docs.withColumn("__mix_size", word_count("text")), self.frame)
        out = self._row_copies(rows).where("__mix_copies > 0")
        return (out.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
                .select(*[F.col(f"`{c}`") for c in docs.columns]))
