"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Vectors are compared only within a label (and a length).  Equal vectors are one
representative.  Every unit vector is projected on ``PROJECTIONS`` fixed random
directions.  The first projection sorts a label's vectors into strips, so wide
that a pair at the sought cosine is at most one strip apart (it is missed with
a probability below 1e-5); strips are cut into blocks of about ``BLOCK``
vectors, however many there are, and blocks meet blocks of the same and of the
next strip.  For each vector of a block the others in the window around it are
counted, projection by projection; the count a pair must reach is calibrated so
that a pair at exactly the sought cosine reaches it with a probability of
``RECALL``.  Pairs that reach it are verified by their cosine in double
precision.

A block pair gives back, per vector, how many vectors it links to, and the edges
of a spanning forest; so the rows made grow with the vectors, not with the
square of a group.

Defined cases: vectors that are null, zero or hold null or non-finite
components, and rows with a null label, link with nothing.  Rows with a null id
link with nothing, have a null component and are not kept.  Repeated rows are
vectors of their own, equal ones are linked; rows that share an id are one for
reachability.  An empty table gives an empty result.  Further columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passante.llm.common import written
from passante.llm.components import connected_components

COSINE = 0.93
PROJECTIONS = 32
RECALL = 0.9999
BLOCK = 1024
#: Half width of a window, and width of a strip, in standard deviations of a
#: projected difference at the sought cosine.
WINDOW, STRIP = 1.28, 4.5


def directions(dim: int) -> np.ndarray:
    """Unit vectors, a column each; the first is for the strips."""
    a = np.random.Generator(np.random.Philox([6, dim])).standard_normal((dim, PROJECTIONS + 1))
    return a / np.linalg.norm(a, axis=0)


def calibrated(dim: int) -> int:
    """The largest count that a pair at the sought cosine reaches with a
    probability of RECALL; its windows collide with the probability that a
    coordinate of a random unit vector is small enough."""
    rng = np.random.Generator(np.random.Philox([66, dim]))
    g = rng.standard_normal((20_000, min(dim, 256)))
    p = float(np.mean(np.abs(g[:, 0]) <= WINDOW / math.sqrt(g.shape[1]) * np.linalg.norm(g, axis=1)))
    below, count = 0.0, 0
    while count < PROJECTIONS:
        below += math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)
        if below > 1 - RECALL:
            break
        count += 1
    return count


def usable(vector: str = "embedding") -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _gap(dim: int) -> float:
    """Standard deviation of a projected difference of unit vectors at the sought cosine."""
    return math.sqrt((2 - 2 * COSINE) / dim)


def _strips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in batches:
        out = part[["node", "rep", "label", "mult"]].copy()
        strips, dims, packed = [], [], []
        for x in part["embedding"]:
            v = np.asarray(x, np.float64)
            u = v / np.abs(v).max()  # no overflow in the norm
            at = float(u @ directions_of(len(v))[:, 0]) / float(np.linalg.norm(u))
            strips.append(math.floor(at / (STRIP * _gap(len(v)))))
            dims.append(len(v))
            packed.append(v.tobytes())
        yield out.assign(dim=dims, strip=strips, vector=packed)


_DIRECTIONS: dict[int, np.ndarray] = {}


def directions_of(dim: int) -> np.ndarray:
    if dim not in _DIRECTIONS:
        _DIRECTIONS[dim] = directions(dim)
    return _DIRECTIONS[dim]


def _packed(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": [group["block"].iloc[0]], "dim": [group["dim"].iloc[0]],
                         "nodes": [group["node"].to_numpy(np.int64).tobytes()], "reps": [group["rep"].to_numpy(np.int64).tobytes()],
                         "mults": [group["mult"].to_numpy(np.int64).tobytes()], "vectors": [b"".join(group["vector"])]})


def linked(a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of ``a`` and ``b`` (double precision) whose cosine
    is at least COSINE, among those that share ``least`` windows."""
    dim = a.shape[1]
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    rays = directions_of(dim)[:, 1:]
    pa, pb = (a @ rays / na[:, None]).T.astype(np.float32), (b @ rays / nb[:, None]).T.astype(np.float32)
    half = np.float32(WINDOW * _gap(dim) * (1 + 1e-6))
    sorted_b, orders = np.sort(pb, axis=1), np.argsort(pb, axis=1)
    found_a, found_b = [], []
    for start in range(0, len(a), 128):
        rows = slice(start, min(start + 128, len(a)))
        counts = np.zeros((rows.stop - rows.start, len(b)), np.uint8)
        for i in range(PROJECTIONS):
            q = pa[i, rows]
            # only the sorted part that the windows of these rows reach
            lo, hi = np.searchsorted(sorted_b[i], (q.min() - half, q.max() + half), side="left")
            near = np.abs(sorted_b[i, lo:hi] - q[:, None]) <= half
            if hi - lo < len(b) // 2:
                counts[:, orders[i, lo:hi]] += near
            else:
                whole = np.zeros(counts.shape, bool)
                whole[:, orders[i, lo:hi]] = near
                counts += whole
        x, y = np.nonzero(counts >= least)
        x += start
        if len(x):
            exact = np.einsum("ij,ij->i", a[x], b[y]) / (na[x] * nb[y]) >= COSINE
            found_a.append(x[exact])
            found_b.append(y[exact])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of n items the least item it is linked to, directly or not."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[x], least[y])
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        least = least[least]
        if np.array_equal(before, least):
            return least


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in batches:
        for row in part.itertuples(index=False):
            read = lambda raw, kind: np.frombuffer(raw, kind)
            a = read(row.vectors, np.float64).reshape(-1, row.dim)
            same = row.block == row.block_b
            b = a if same else read(row.vectors_b, np.float64).reshape(-1, row.dim)
            x, y = linked(a, b, calibrated_of(row.dim))
            if same:
                x, y = x[x < y], y[x < y]
            nodes, reps, mults = (read(p, np.int64) if same else np.concatenate([read(p, np.int64), read(q, np.int64)])
                                  for p, q in ((row.nodes, row.nodes_b), (row.reps, row.reps_b), (row.mults, row.mults_b)))
            if not same:
                y = y + len(a)
            links = np.bincount(x, weights=mults[y], minlength=len(nodes)) + np.bincount(y, weights=mults[x], minlength=len(nodes))
            root = _forest(x, y, len(nodes))
            held = np.flatnonzero(links)
            if len(held):
                yield pd.DataFrame({"node": nodes[held], "rep": reps[held], "links": links[held].astype(np.int64), "root": nodes[root[held]]})


_CALIBRATED: dict[int, int] = {}


def calibrated_of(dim: int) -> int:
    if dim not in _CALIBRATED:
        _CALIBRATED[dim] = calibrated(dim)
    return _CALIBRATED[dim]


def representatives(embeddings: DataFrame) -> DataFrame:
    """(label, embedding, rep, node, mult): one row per distinct usable vector of a label."""
    return (embeddings.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable())
            .groupBy("label", "embedding").agg(F.min("vec_id").cast("bigint").alias("node"), F.count("*").alias("mult"))
            .withColumn("rep", F.xxhash64("label", "embedding")))


def block_pairs(reps: DataFrame) -> DataFrame:
    """Blocks that may hold links, side by side, packed."""
    rows = written(reps.mapInPandas(_strips, "node bigint, rep bigint, label string, mult bigint, dim int, strip bigint, vector binary"), "embedding-strips")
    sizes = rows.groupBy("label", "dim", "strip").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / BLOCK))
    sizes = written(sizes, "embedding-sizes")
    part = F.pmod(F.xxhash64("node", "rep", "vector"), F.col("parts"))
    block = F.concat_ws("|", "label", "dim", "strip", "part")
    packed = (rows.join(sizes, ["label", "dim", "strip"]).withColumn("part", part).select(block.alias("block"), "dim", "node", "rep", "mult", "vector")
              .groupBy("block").applyInPandas(_packed, "block string, dim int, nodes binary, reps binary, mults binary, vectors binary"))
    packed = written(packed, "embedding-blocks")
    parts = sizes.select("label", "dim", "strip", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).withColumn("block", block)
    other = parts.select("label", "dim", F.col("strip").alias("strip_b"), F.col("part").alias("part_b"), F.col("block").alias("block_b"))
    pairs = (parts.withColumn("strip_b", F.explode(F.array("strip", F.col("strip") + 1))).join(other, ["label", "dim", "strip_b"])
             .where("strip_b > strip or part_b >= part").select("block", "block_b"))
    pairs = written(pairs, "embedding-block-pairs")
    tasks = max(1, math.ceil(pairs.count() / 32))  # so many packed pairs of about 1 MB in one task
    seconds = packed.select(*[F.col(c).alias(f"{c}_b") for c in ("block", "nodes", "reps", "mults", "vectors")])
    return (pairs.join(packed, "block").join(seconds, "block_b")
            .repartition(max(tasks, embeddings_parallelism(reps)), F.xxhash64("block", "block_b")))


def embeddings_parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def link(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``
    (vec_id, label, embedding)."""
    embeddings = embeddings.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    reps = written(representatives(embeddings), "embedding-representatives")
    found = written(block_pairs(reps).mapInPandas(_compare, "node bigint, rep bigint, links bigint, root bigint"), "embedding-links")
    # rows that share an id are one node
    parts = written(connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))), "embedding-components")
    links = found.groupBy("node", "rep").agg(F.sum("links").alias("links"))
    judged = (reps.join(links, ["node", "rep"], "left").join(parts, "node", "left")
              .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"),
                      F.coalesce("component", "node").alias("component")))
    judged = written(judged, "embedding-judged")
    rows = embeddings.join(judged, ["label", "embedding"], "left")
    alone = F.col("links").isNull() | F.col("vec_id").isNull()
    component = F.when(alone, F.col("vec_id").cast("bigint")).otherwise(F.col("component"))
    return (rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(alone, 0).otherwise(F.col("links")).cast("bigint").alias("n_links"),
                        component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
