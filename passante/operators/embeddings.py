"""Nearest items by embedding (J8), exact cosine, blocked by label.

Each corpus vector is compared only with the query vectors of its own label
(an equi-join on ``label``), never with the other corpus vectors, and the
per-query top-k is ranked in two stages, salted by the item.  Cosine is computed with built-in array functions
(``zip_with`` + ``aggregate``), no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passante.functions.topk import top_k_per_group


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def cosine(a: Column, b: Column) -> Column:
    den = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return _dot(a, b) / F.when(den != 0, den)


def label_centroids(corpus: DataFrame, vec: str = "embedding", label: str = "label") -> DataFrame:
    """Element-wise mean vector per label (posexplode + grouped mean; each
    label's result holds one value per dimension)."""
    pos = corpus.select(label, F.posexplode(F.col(vec).cast("array<double>")).alias("i", "x"))
    means = pos.groupBy(label, "i").agg(F.avg("x").alias("m"))
    return (means.groupBy(label)
            .agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("__p"))
            .select(label, F.transform("__p", lambda s: s["m"]).alias("query_vec")))


def nearest(corpus: DataFrame, queries: DataFrame, k: int, vec: str = "embedding",
            label: str = "label", id_col: str = "vec_id", query_id: str = "query_id") -> DataFrame:
    """Top-k corpus items per query by cosine similarity, within the label."""
    c = corpus.select(id_col, label, F.col(vec).cast("array<double>").alias("__v"))
    j = c.join(queries, label)
    scored = j.select(query_id, label, id_col, cosine(F.col("__v"), F.col("query_vec")).alias("score"))
    # the join has partitioned by label: the salt spreads a label that holds most vectors
    return top_k_per_group(scored, [query_id, label], [F.col("score").desc_nulls_last(), F.col(id_col)], k, salt_cols=[id_col])


def centroid_topk(corpus: DataFrame, k: int) -> DataFrame:
    """The k vectors closest to their own label's centroid."""
    q = label_centroids(corpus).withColumn("query_id", F.col("label"))
    return nearest(corpus, q, k).drop("query_id")
