"""Quality classifier by importance resampling of hashed n-gram models.

Two bag-of-n-gram models over ``BUCKETS`` hashed unigrams and bigrams are
fitted: one on the target text (labelled documents of good quality, a bounded
sample of at most ``LABEL_BOUND`` labels), one on the raw text (all documents).
A document's log importance weight is the sum over its n-grams of
log p_target - log p_raw, or that of its worst passage if this is worse: a few
toxic words weigh little in a long text.  The worst passage is the run of
``PASSAGE`` tokens with the lowest sum of the unigrams' ratios, counted in
``WORD_BUCKETS`` buckets of their own, so that rare words do not share one; its
sum is shifted so that the good documents held back reach both thresholds alike.
``resample`` draws k documents without replacement
with probabilities that follow these weights: it adds Gumbel noise, a fixed
function of seed and document id, and takes the k largest sums.  k defaults to
the number of documents whose weight reaches what all but a few in a thousand of
the good documents of a held-back quarter of the labels reach (``KEEP_GOOD``).

What reaches the driver is of bounded size: two numbers per bucket, a histogram
per selection step, and the weights of the bounded label sample.

Defined cases: a null or empty text has no n-grams and weight 0; a text
of fewer than ``PASSAGE`` tokens is one passage.  A label row
with a null id or null quality is not used; of several labels for one id the
worst counts.  Rows that share the k-th largest sum (repeated rows) are kept
together.  Without labels on both sides the thresholds are 0.  An empty table
gives an empty result.  All columns of the documents stay; working columns
begin with ``__dsir``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from passante.llm.common import text_slices, written

#: Hashed n-grams of the models.
BUCKETS = 1 << 14
#: Hashed unigrams of the models of passages.
WORD_BUCKETS = 1 << 20
#: Tokens of a passage.
PASSAGE = 30
#: Labels that the models and the threshold are fitted on at most.
LABEL_BOUND = 20_000
#: Added to each bucket's count.
SMOOTHING = 1.0
#: Share of the good documents held back that the default k lets pass.
KEEP_GOOD = 0.997

_RANDOM = np.random.Generator(np.random.Philox(20))
_TABLE = _RANDOM.integers(0, 1 << 63, size=(32, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CLASS = np.ones(256, np.uint8)  # words
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
for _b in range(0x21, 0x7F):
    if not chr(_b).isalnum():
        _CLASS[_b] = 2  # marks


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def ngram_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash) of all unigrams and the same of all bigrams of the
    lower-cased texts; a token is a run of word characters or a run of marks."""
    parts = [(t or "").lower().encode("utf-8") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    kind = _CLASS[data]
    new = np.empty(len(data), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    in_token = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    hashes = np.add.reduceat(_TABLE[in_token & 31, data], starts)
    real = kind[starts] != 0
    starts, hashes = starts[real], _mixed(hashes[real])
    ends = np.cumsum([len(p) + 1 for p in parts])
    owner = np.searchsorted(ends, starts, side="right")
    same = owner[1:] == owner[:-1]
    pairs = _mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[same]
    return owner, hashes, owner[1:][same], pairs


def ngram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of all unigrams and bigrams."""
    owner, hashes, pair_owner, pairs = ngram_hashes(texts)
    return np.concatenate([owner, pair_owner]), _bucket(np.concatenate([hashes, pairs]), BUCKETS)


def worst_passages(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The lowest sum of ``PASSAGE`` neighbouring values of each of the n texts
    (of all its values if it has fewer); it does not depend on the other texts."""
    sums = np.bincount(owner, weights=values, minlength=n).astype(np.float64)
    full = np.flatnonzero(owner[PASSAGE - 1:] == owner[:len(owner) - PASSAGE + 1]) if len(owner) >= PASSAGE else owner[:0]
    if len(full):
        total, power, size, at = np.zeros(len(values)), np.append(values, np.zeros(PASSAGE)), 1, 0
        while size <= PASSAGE:  # sums of 1, 2, 4, ... values
            if PASSAGE & size:
                total += power[at:at + len(values)]
                at += size
            power[:-size] = power[:-size] + power[size:]
            size *= 2
        first = np.flatnonzero(np.diff(owner[full], prepend=-1))
        sums[owner[full[first]]] = np.minimum.reduceat(total[full], first)
    return sums


def label_sample(labels: DataFrame, bound: int = LABEL_BOUND) -> DataFrame:
    """(__dsir_id, __dsir_good, __dsir_held): at most ``bound`` labelled ids,
    those with the smallest hashes; good: quality 1 and not toxic; held: a quarter
    that the models do not see, for the threshold."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (labels.where("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").alias("__dsir_id")).agg(F.min(good.cast("int")).alias("__dsir_good"))
            .orderBy(F.xxhash64("__dsir_id"), "__dsir_id").limit(bound)
            .withColumn("__dsir_held", F.pmod(F.xxhash64(F.lit("held"), "__dsir_id"), F.lit(4)) == 0))


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> np.ndarray:
    """log p_target - log p_raw of each bucket, counted over all documents:
    ``BUCKETS`` of unigrams and bigrams, then ``WORD_BUCKETS`` of unigrams."""
    size = BUCKETS + WORD_BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in text_slices(batches, max_bytes=1 << 20):
            owner, hashes, pair_owner, pairs = ngram_hashes(batch.column("text").to_pylist())
            bucket = np.concatenate([_bucket(hashes, BUCKETS), _bucket(pairs, BUCKETS), BUCKETS + _bucket(hashes, WORD_BUCKETS)])
            good = np.array(batch.column("good").to_pylist(), bool)[np.concatenate([owner, pair_owner, owner])]
            np.add.at(raw, bucket, 1)
            np.add.at(target, bucket[good], 1)
        held = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(raw[held]), pa.array(target[held])], ["bucket", "raw", "target"])

    sample = F.broadcast(label_sample(labels, bound))  # at most ``bound`` rows of 12 bytes
    marked = (docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("__dsir_id"), "left")
              .select("text", F.coalesce((F.col("__dsir_good") == 1) & ~F.col("__dsir_held"), F.lit(False)).alias("good")))
    found = (marked.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
             .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    counts = np.full((2, size), SMOOTHING)
    for model, name in zip(counts, ("target", "raw")):
        model[found.column("bucket").to_numpy()] += found.column(name).to_numpy()
    for part in (counts[:, :BUCKETS], counts[:, BUCKETS:]):
        part[:] = np.log(part / part.sum(axis=1, keepdims=True))
    return counts[0] - counts[1]


def weighed(docs: DataFrame, weights: np.ndarray, with_text: bool = True) -> DataFrame:
    """``docs`` with ``__dsir_n`` (n-grams), ``__dsir_whole`` (log importance weight
    of the text) and ``__dsir_passage`` (that of its worst passage) added;
    ``with_text`` False leaves the text out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=1 << 20):
            owner, hashes, pair_owner, pairs = ngram_hashes(batch.column("text").to_pylist())
            n, owners = batch.num_rows, np.concatenate([owner, pair_owner])
            ratios = weights[_bucket(np.concatenate([hashes, pairs]), BUCKETS)]
            sums = np.bincount(owners, weights=ratios, minlength=n).astype(np.float64)  # whole numbers if empty
            worst = worst_passages(owner, weights[BUCKETS + _bucket(hashes, WORD_BUCKETS)], n)
            kept = batch if with_text else batch.drop_columns(["text"])
            yield (kept.append_column("__dsir_n", pa.array(np.bincount(owners, minlength=n)))
                   .append_column("__dsir_whole", pa.array(sums)).append_column("__dsir_passage", pa.array(worst)))

    fields = [f for f in docs.schema.fields if with_text or f.name != "text"]
    added = [StructField("__dsir_n", LongType()), StructField("__dsir_whole", DoubleType()), StructField("__dsir_passage", DoubleType())]
    return docs.mapInArrow(run, StructType([*fields, *added]))


def gumbel(seed: int) -> Column:
    """Gumbel noise that is a fixed function of seed and document id."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, k: int, bins: int = 1024) -> float | None:
    """The k-th largest of the one column of ``values``, exactly: each step
    counts ``bins`` equal ranges and goes on within the one that holds it.
    None if there are fewer than k."""
    name = values.columns[0]
    left = values.where(F.col(name).isNotNull())
    seen = 0
    while True:
        r = left.agg(F.count(name).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).first()
        if r.n + seen < k:
            return None
        if r.low == r.high:
            return r.high
        width = (r.high - r.low) / bins
        at = F.least(F.floor((F.col(name) - r.low) / F.lit(width)), F.lit(bins - 1)) if width > 0 else (F.col(name) > r.low).cast("bigint")
        counts = {x.at: x.n for x in left.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()}
        for b in sorted(counts, reverse=True):
            if seen + counts[b] >= k:
                left = left.where(at == b)
                break
            seen += counts[b]


def thresholds(scores: DataFrame, labels: DataFrame, names: list[str], keep_good: float, bound: int = LABEL_BOUND) -> list[float]:
    """The values of the columns ``names`` that ``keep_good`` of the good documents
    held back reach (0 without labels of both kinds)."""
    sample = F.broadcast(label_sample(labels, bound).where("__dsir_held"))
    good = [F.when(F.col("__dsir_good") == 1, F.col(name)) for name in names]
    r = (scores.join(sample, F.col("doc_id") == F.col("__dsir_id"))
         .agg(F.count(good[0]), F.count("*"), *[F.percentile(g, 1 - keep_good) for g in good]).first())
    return [float(x) for x in r[2:]] if r[0] and r[0] < r[1] else [0.0] * len(names)


class Resampler:
    """A fitted classifier: model weights, and the smallest sum of log weight and
    noise that is among the k largest."""

    def __init__(self, docs: DataFrame, labels: DataFrame, k: int | None = None, keep_good: float = KEEP_GOOD,
                 bound: int = LABEL_BOUND, seed: int = 1):
        self.seed = seed
        self.weights = fit(docs, labels, bound)
        parts = written(weighed(docs.select("doc_id", "text"), self.weights, with_text=False), "importance")
        whole, passage = thresholds(parts, labels, ["__dsir_whole", "__dsir_passage"], keep_good, bound)
        self.shift = whole - passage
        self.scores = self._summed(parts)
        if k is None:
            self.threshold, = thresholds(self.scores, labels, ["__dsir_weight"], keep_good, bound)
            k = self.scores.where(F.col("__dsir_weight") >= self.threshold).count()
        self.k = k
        low = kth_largest(self.scores.select("__dsir_sum"), k) if k > 0 else float("inf")
        self.lowest = float("-inf") if low is None else low

    def _summed(self, parts: DataFrame) -> DataFrame:
        """``__dsir_weight`` (the worse of text and worst passage) and ``__dsir_sum`` (with noise) added."""
        weight = F.when(F.col("__dsir_n") > 0, F.least("__dsir_whole", F.col("__dsir_passage") + F.lit(self.shift))).otherwise(0.0)
        return parts.withColumn("__dsir_weight", weight).withColumn("__dsir_sum", F.col("__dsir_weight") + gumbel(self.seed))

    def sampled_scores(self) -> DataFrame:
        """doc_id, n_ngrams, log_weight, sampling_key of the sampled documents."""
        return (self.scores.where(F.col("__dsir_sum") >= self.lowest)
                .select("doc_id", F.col("__dsir_n").alias("n_ngrams"), F.col("__dsir_weight").alias("log_weight"),
                        F.col("__dsir_sum").alias("sampling_key")))

    def resample(self, docs: DataFrame) -> DataFrame:
        """The sampled rows of ``docs``, with all their columns.  The weights are
        computed again in the scan, so the texts need no shuffle."""
        return (self._summed(weighed(docs, self.weights)).where(F.col("__dsir_sum") >= self.lowest)
                .select(*[F.col(f"`{c}`") for c in docs.columns]))
