"""Exact top-k search by inner product over an impact-ordered index.

Vectors are turned into whole numbers, floor(1024 x).  The index has shards of
about ``SHARD`` vectors; a shard lists the vectors of each dimension by value, cut
into at most about ``LEVELS`` posting segments of equal value range, and keeps the
segments' dimension, level and first posting.  For a query the impact of a segment
is the query's component times the segment's bound.  Score at a time: segments of
all dimensions are read by falling impact, in rounds of growing numbers of
postings, and add their quantised impact to the accumulators of their vectors; a
segment that is not reached is not read.  After a round the best vectors so far are
scored exactly, and the k-th of them is a score that is proven to be reached.  A
vector whose upper bound (a dimension not met yet counts with the impact of the
next segment) stays below it is out.  When few enough possible members are left
they are scored exactly; if there are many, the next round follows, down to the
last segment.  So the result is exact for any data; the bounds only decide when
the work ends.

Queries are packed in blocks of ``QUERIES_PER_BLOCK``, and every block meets every
shard: a stated query set against all rows.  A task holds a block and a shard; each
gives back k rows per query, and the best k of all shards are taken in two steps.

Defined cases: a vector that is null or holds null or non-finite components, or a
row with a null id takes no part; vectors meet those of their own length.  Vectors
with a component beyond 2^14 in absolute value have shards and blocks of their own
and are scored with integers of any size; a score beyond 64 bits counts as the
nearest 64-bit integer.  A row whose id is the query's is not a candidate.  Queries
that share an id have one ranking, in which a candidate is listed for each of them;
candidates that share an id may each be listed.  Equal scores are ranked by the
smaller id.  Fewer than k candidates are all listed; empty tables give an empty
result.  Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passante.llm.common import written

SCALE = 1024
SHARD = 4096
QUERIES_PER_BLOCK = 2048
#: Posting segments of a dimension in a shard.
LEVELS = 64
#: Shares of the postings read at the end of the rounds.
ROUNDS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 1.0)
#: Products of components up to this have sums of 64 bits.
NARROW = float(1 << 14)


def usable(vector: str = "embedding") -> Column:
    """Not null and all components finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)), F.lit(False))


def _rows(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.col("vec_id").isNotNull() & usable() & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.size("embedding").alias("dim"),
        F.exists("embedding", lambda x: F.abs(x) > NARROW).alias("wide"))


def _stacked(vectors) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in vectors])


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int32)


def _any_size(values: np.ndarray) -> np.ndarray:
    """floor(1024 x) as integers of any size."""
    whole = [[math.floor(SCALE * x) if abs(x) < 1 << 53 else SCALE * int(x) for x in row] for row in values.tolist()]
    return np.array(whole, object).reshape(values.shape)


def _shard(group: pd.DataFrame) -> pd.DataFrame:
    """The index of one shard.  Segments are columns (dimension, level, first posting)."""
    group = group.sort_values("vec_id", kind="stable")
    values, wide = _stacked(group["embedding"]), bool(group["wide"].iloc[0])
    bits, postings, segments = 0, b"", b""
    if not wide:
        values = _whole(values)
        n, dim = values.shape
        bits = max(int(np.ptp(values.astype(np.int64), axis=0).max()) // LEVELS, 1).bit_length()
        order = np.argsort(values, axis=0, kind="stable").T
        level = np.take_along_axis(values.T, order, axis=1) >> bits
        first = np.flatnonzero(np.concatenate([np.ones((dim, 1), bool), level[:, 1:] != level[:, :-1]], axis=1))
        postings = np.ascontiguousarray(order, np.int32).tobytes()
        segments = np.stack([first // n, level.reshape(-1)[first], first]).astype(np.int64).tobytes()
    return pd.DataFrame({"dim": [values.shape[1]], "wide": [wide], "shard": [group["shard"].iloc[0]], "ids": [group["vec_id"].to_numpy(np.int64).tobytes()],
                         "vectors": [values.tobytes()], "bits": [bits], "postings": [postings], "segments": [segments]})


def build_index(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """(dim, wide, shard, ids, vectors, bits, postings, segments), written to the
    shared folder; every usable row of ``vectors`` (vec_id, embedding) is in it."""
    rows = _rows(vectors)
    sizes = written(rows.groupBy("dim", "wide").agg(F.ceil(F.count("*") / shard).alias("shards")), "impact-sizes")
    dealt = rows.join(sizes, ["dim", "wide"]).select("vec_id", "embedding", "dim", "wide", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("shards")).alias("shard"))
    schema = "dim int, wide boolean, shard bigint, ids binary, vectors binary, bits int, postings binary, segments binary"
    return written(dealt.groupBy("dim", "wide", "shard").applyInPandas(_shard, schema), "impact-index")


def _query_block(group: pd.DataFrame) -> pd.DataFrame:
    values, wide = _stacked(group["embedding"]), bool(group["wide"].iloc[0])
    return pd.DataFrame({"dim": [values.shape[1]], "wide_query": [wide], "query_ids": [group["vec_id"].to_numpy(np.int64).tobytes()], "query_vectors": [values.tobytes()]})


class Shard:
    """One shard with narrow components, opened for queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bits: int, postings: np.ndarray, segments: np.ndarray):
        self.ids, self.vectors, self.postings = ids, vectors.astype(np.int64), postings
        self.dimension, level, self.start = segments
        self.length = np.diff(np.append(self.start, len(postings)))
        self.low, self.span = level << bits, (1 << bits) - 1
        #: The first segment of each dimension; segments ascend by dimension.
        self.first = np.searchsorted(self.dimension, np.arange(vectors.shape[1]))

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and exact scores of the k best for one query (all if fewer), and the
        number of postings read."""
        n, dim = self.vectors.shape
        rivals = self.ids != own
        read = 0
        possible = rivals
        if np.count_nonzero(rivals) > k:
            weight = query[self.dimension]
            bound = weight * np.where(weight > 0, self.low + self.span, self.low)
            least = np.minimum.reduceat(bound, self.first)
            gain = bound - least[self.dimension]  # the impact above the dimension's least one
            order = np.argsort(-gain, kind="stable")
            ends = np.cumsum(self.length[order])
            base = int(least.sum())
            total, met, done, reached = np.zeros(n), np.zeros(n, np.int64), 0, None
            for share in ROUNDS:
                upto = int(np.searchsorted(ends, share * ends[-1])) + 1
                taken = order[done:upto]
                done = max(done, upto)
                if len(taken):
                    sizes = self.length[taken]
                    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    vector = self.postings[np.repeat(self.start[taken], sizes) + within]
                    total += np.bincount(vector, np.repeat(gain[taken], sizes), n)
                    met += np.bincount(vector, minlength=n)
                    read += len(vector)
                following = int(gain[order[done]]) if done < len(order) else 0
                upper = base + total + (dim - met) * following
                upper += 1 + 1e-12 * (abs(base) + total)  # sums beyond 2^53 are rounded
                upper[~rivals] = -np.inf
                tried = np.argpartition(upper, max(n - 4 * k, 0))[max(n - 4 * k, 0):]
                tried = tried[rivals[tried]]
                scores = self.vectors[tried] @ query
                if len(scores) >= k:
                    found = int(np.partition(scores, len(scores) - k)[len(scores) - k])
                    reached = found if reached is None else max(reached, found)
                if reached is not None:
                    possible = rivals & (upper >= reached)
                    if np.count_nonzero(possible) <= max(4 * k, n // 16):
                        break
        rows = np.flatnonzero(possible)
        scores = self.vectors[rows] @ query
        chosen = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[chosen], scores[chosen], read


def _best_of_any_size(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.flatnonzero(ids != own)
    scores = [min(max(x, -(1 << 63)), (1 << 63) - 1) for x in vectors[rows] @ query]
    chosen = sorted(range(len(rows)), key=lambda i: (-scores[i], ids[rows[i]]))[:k]
    return rows[chosen], np.array([scores[i] for i in chosen], np.int64)


def _searched(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for row in part.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                vectors = np.frombuffer(row.vectors, np.float64 if row.wide else np.int32).reshape(len(ids), row.dim)
                own = np.frombuffer(row.query_ids, np.int64)
                queries = np.frombuffer(row.query_vectors, np.float64).reshape(len(own), row.dim)
                if row.wide or row.wide_query:
                    vectors = _any_size(vectors) if row.wide else vectors.astype(object)
                    queries = _any_size(queries)
                    answers = (_best_of_any_size(ids, vectors, query, q, k) for q, query in zip(own, queries))
                else:
                    shard = Shard(ids, vectors, row.bits, np.frombuffer(row.postings, np.int32), np.frombuffer(row.segments, np.int64).reshape(3, -1))
                    answers = (shard.best(query, q, k)[:2] for q, query in zip(own, _whole(queries).astype(np.int64)))
                out = [pd.DataFrame({"query_id": np.full(len(rows), q), "vec_id": ids[rows], "score": scores}) for q, (rows, scores) in zip(own, answers)]
                if out:
                    yield pd.concat(out)
    return run


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every usable row
    of ``queries`` (vec_id, embedding)."""
    asked = _rows(queries)
    sizes = written(asked.groupBy("dim", "wide").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).alias("blocks")), "impact-queries")
    blocks = (asked.join(sizes, ["dim", "wide"]).withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks")))
              .groupBy("dim", "wide", "block").applyInPandas(_query_block, "dim int, wide_query boolean, query_ids binary, query_vectors binary"))
    blocks = written(blocks, "impact-query-blocks")
    # a block of queries and a shard are about as large; a shard is copied once for 2048 queries
    shards = index.select("dim", "wide", "shard")
    dealt = blocks.join(shards, "dim")
    met = dealt.join(index, ["dim", "wide", "shard"])
    width = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(width, blocks.count() * shards.count())
    found = met.repartition(tasks, F.xxhash64("shard", "query_ids")).mapInPandas(_searched(k), "query_id bigint, vec_id bigint, score bigint")
    salted = found.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    order = (F.desc("score"), "vec_id")
    first = salted.withColumn("r", F.row_number().over(Window.partitionBy("query_id", "salt").orderBy(*order))).where(F.col("r") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
