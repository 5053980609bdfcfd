"""Toxicity by non-negative positive-unlabelled learning.

Only toxic examples are confirmed; all other text is unlabelled and holds toxic
text too, a share ``prior`` of it.  The classifier is learned in two steps.

1. Evidence of words.  The features of a word are its hash and those of its
   prefixes of ``PREFIXES`` bytes.  In how many confirmed documents each occurs
   is counted exactly; of those in at least ``MIN_DOCS`` (at most ``FEATURES``
   of them) it is counted in how many unlabelled documents they occur, over the
   whole table.  The rate in clean text is what the prior leaves of the
   unlabelled rate, (unlabelled - prior * confirmed) / (1 - prior), not below 0;
   a feature's evidence is the log ratio of the confirmed and the clean rate,
   drawn to 0 by ``SHRINK`` documents, a word's that of its strongest feature.
2. The classifier.  A document is pooled into the number of words, and of different
   words, above each of ``LEVELS`` of evidence, and the number of all its words.  A logistic model on
   the logarithms of these numbers minimises the non-negative risk
   prior * R_confirmed(1) + max(0, R_unlabelled(0) - prior * R_confirmed(0)):
   where the difference falls below 0 the step goes against it.  The risk
   covers all unlabelled documents: numbers are cut to two binary digits,
   so that the table of different pooled rows with their counts is small, however
   many documents there are.  A confirmed document is pooled for this without
   its own part in the counts.

Labels are read only where ``learn`` (a column of the documents) holds; other
rows are neither confirmed nor unlabelled examples.  At most ``LABEL_BOUND``
confirmed ids, those with the smallest hashes, are broadcast.  The driver holds
the counts of at most ``FEATURES`` features and the table of pooled rows.
The prior defaults to the share of toxic ones among the labelled ids to learn from.
Labels and all columns but the text are no inputs of a score.

Defined cases: a null or empty text has no words, and the score of such a text
like any other's pooled row.  Without confirmed examples all scores are 0.  A
null id has no label and is learned from as unlabelled.  Of several labels of
one id the worst counts; a null label is none.  Repeated rows are scored alike.
An empty table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passante.llm.common import text_slices, written

#: Lengths of the prefixes, in UTF-8 bytes.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Confirmed documents a feature must occur in.
MIN_DOCS = 4
#: Features of the model at most, the most frequent in confirmed documents.
FEATURES = 1 << 19
#: Confirmed documents that are learned from at most.
LABEL_BOUND = 20_000
#: Documents that the ratio of rates is drawn to 0 with.
SHRINK = 3.0
#: Levels of evidence at which words are counted.
LEVELS = (0.7, 1.2, 1.7, 2.2, 2.7)
#: Tasks that count the features of the unlabelled, per core.
TASKS_PER_CORE = 2
#: Score from which a document is predicted toxic.
TOXIC = 0.7

_RANDOM = np.random.Generator(np.random.Philox(11))
_TABLE = _RANDOM.integers(0, 1 << 63, size=(64, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
#: The first bits of a hash say whether a feature may be one of the model.
_SIEVE_BITS = 24


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, length) of every word of the lower-cased texts, and
    the sums of the bytes' random numbers before each byte."""
    parts = [(t or "").lower().encode("utf-8") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # the last byte is a line break
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    at = np.arange(len(data), dtype=np.int32)
    begun = np.zeros(len(data), np.int32)
    begun[starts] = starts
    place = (at - np.maximum.accumulate(begun)) & 63
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[place, data], out=sums[1:])
    owner = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), starts, side="right")
    return owner, starts, lengths, sums


def features(starts: np.ndarray, lengths: np.ndarray, sums: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of words, hashes): whole words first, then the prefixes."""
    yield np.arange(len(starts)), _mixed(sums[starts + lengths] - sums[starts])
    for k in PREFIXES:
        long = np.flatnonzero(lengths >= k)
        first = starts[long]
        yield long, _mixed((sums[first + k] - sums[first]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))


def in_documents(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values, each once for every text that has it."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    return values[new]


def rounded(n: np.ndarray) -> np.ndarray:
    """Whole numbers cut to two binary digits."""
    low = np.maximum(np.frexp(n)[1] - 2, 0)
    return (n >> low) << low


class Lexicon:
    """Hashes of the model's features, sorted; ``find`` gives the place of those in it."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[hashes >> np.uint64(64 - _SIEVE_BITS)] = True

    def find(self, starts: np.ndarray, lengths: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of words, place in the lexicon) of all features that it has, and the hashes of all words."""
        at, places, whole = [], [], None
        for word, h in features(starts, lengths, sums):
            whole = h if whole is None else whole
            likely = self.sieve[h >> np.uint64(64 - _SIEVE_BITS)]
            word, h = word[likely], h[likely]
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            real = self.hashes[place] == h
            at.append(word[real])
            places.append(place[real])
        return np.concatenate(at), np.concatenate(places), whole


def confirmed_counts(confirmed: DataFrame, least: int = MIN_DOCS, most: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and document counts of the features of the confirmed texts, by hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=1 << 20):
            owner, starts, lengths, sums = words(batch.column("text").to_pylist())
            found = list(features(starts, lengths, sums))
            each = in_documents(np.concatenate([owner[w] for w, _ in found]), np.concatenate([h for _, h in found]))
            hashes, n = np.unique(each, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    counts = (confirmed.select("text").mapInArrow(count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= least).orderBy(F.desc("n"), "hash").limit(most).toArrow())
    hashes, n = counts.column("hash").to_numpy().view(np.uint64), counts.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order].astype(np.float64)


def seen_by_task(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """(place, n) of the ``hashes`` that a task's documents have, a row per task and
    feature.  The splits are dealt over ``TASKS_PER_CORE`` tasks a core, so these rows
    grow with the cluster and the features, not with the number of splits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, seen = Lexicon(hashes), np.zeros(len(hashes), np.int64)
        for batch in text_slices(batches, max_bytes=1 << 20):
            owner, starts, lengths, sums = words(batch.column("text").to_pylist())
            word, place, _ = lexicon.find(starts, lengths, sums)
            np.add.at(seen, in_documents(owner[word], place), 1)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], ["place", "n"])

    tasks = TASKS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism
    return docs.select("text").coalesce(tasks).mapInArrow(count, "place bigint, n bigint")


def unlabelled_counts(docs: DataFrame, hashes: np.ndarray) -> np.ndarray:
    """In how many documents each of ``hashes`` occurs, over all ``docs``."""
    counts = seen_by_task(docs, hashes).groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(hashes))
    out[counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    return out


def evidence(confirmed: np.ndarray, unlabelled: np.ndarray, n_confirmed: float, n_unlabelled: float, prior: float) -> np.ndarray:
    """Log ratio of the rates in toxic and in clean text of each feature."""
    n_confirmed, n_unlabelled = max(n_confirmed, 1.0), max(n_unlabelled, 1.0)
    clean = np.maximum(unlabelled / n_unlabelled - prior * confirmed / n_confirmed, 0) / (1 - prior)
    return np.log((confirmed + SHRINK) / (n_confirmed * clean + SHRINK))


def pooled(docs: DataFrame, hashes: np.ndarray, values: np.ndarray, without: np.ndarray) -> DataFrame:
    """``docs`` with its text replaced by ``pooled`` (the numbers of words
    above each level, of different ones, and of all words) and ``learned``: the same with the
    evidence ``without`` where ``confirmed`` holds."""

    def numbers(owner: np.ndarray, word: np.ndarray, place: np.ndarray, whole: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        best = np.full(len(owner), -np.inf, of.dtype)
        np.maximum.at(best, word, of[place])
        out = np.empty((n, 2 * len(LEVELS) + 1), np.int64)
        out[:, -1] = np.bincount(owner, minlength=n)
        strong = np.flatnonzero(best > LEVELS[0])
        order = strong[np.lexsort((whole[strong], owner[strong]))]
        new = np.ones(len(order), bool)
        new[1:] = (owner[order][1:] != owner[order][:-1]) | (whole[order][1:] != whole[order][:-1])
        each = order[new]
        for j, level in enumerate(LEVELS):
            out[:, 2 * j] = np.bincount(owner[strong[best[strong] > level]], minlength=n)
            out[:, 2 * j + 1] = np.bincount(owner[each[best[each] > level]], minlength=n)
        return rounded(out)

    def arrays(numbers: np.ndarray) -> pa.Array:
        return pa.FixedSizeListArray.from_arrays(pa.array(numbers.ravel()), numbers.shape[1]).cast(pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(hashes)
        for batch in text_slices(batches, max_bytes=1 << 20):
            n = batch.num_rows
            owner, starts, lengths, sums = words(batch.column("text").to_pylist())
            word, place, whole = lexicon.find(starts, lengths, sums)
            found = numbers(owner, word, place, whole, values, n)
            marked = batch.column("confirmed").to_numpy(zero_copy_only=False).astype(bool)
            learned = found
            if marked.any():
                learned = np.where(marked[:, None], numbers(owner, word, place, whole, without, n), found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learn"), batch.column("confirmed"), arrays(found), arrays(learned)],
                ["doc_id", "learn", "confirmed", "pooled", "learned"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, learn boolean, confirmed boolean, pooled array<bigint>, learned array<bigint>")


def train(confirmed: tuple[np.ndarray, np.ndarray], unlabelled: tuple[np.ndarray, np.ndarray], prior: float,
          steps: int = 1500, rate: float = 0.03, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model of least non-negative risk.  Each
    side is (rows of values, their counts); steps are those of Adam."""
    (p, pn), (u, un) = confirmed, unlabelled
    pn, un = pn / pn.sum(), un / un.sum()
    mean = un @ u
    scale = np.sqrt(un @ (u - mean) ** 2) + 1e-6
    p, u = (np.column_stack([(x - mean) / scale, np.ones(len(x))]) for x in (p, u))
    w, first, second = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for step in range(1, steps + 1):
        zp, zu = np.clip(p @ w, -40, 40), np.clip(u @ w, -40, 40)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        clean_risk = un @ np.logaddexp(0, zu) - prior * (pn @ np.logaddexp(0, zp))
        clean = u.T @ (un * su) - prior * (p.T @ (pn * sp))
        gradient = prior * (p.T @ (pn * (sp - 1))) + clean if clean_risk >= 0 else -clean
        gradient[:-1] += ridge * w[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        w = w - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


class Classifier:
    """A fitted model.  ``learn`` tells the rows of ``docs`` whose labels and
    texts may be learned from."""

    def __init__(self, docs: DataFrame, labels: DataFrame, learn: Column, prior: float | None = None, bound: int = LABEL_BOUND):
        docs = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
        known = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("__tox_id"))
                 .agg(F.max("toxic").alias("toxic")))
        mine = F.col("toxic") == 1
        if prior is None:
            able = known.withColumnRenamed("__tox_id", "doc_id").where(F.coalesce(learn, F.lit(False)))
            share = able.agg(F.avg(mine.cast("int"))).first()[0]
            prior = 0.0 if share is None else float(share)
        self.prior = min(max(prior, 1e-4), 0.5)
        able = known.where(mine).withColumnRenamed("__tox_id", "doc_id").where(F.coalesce(learn, F.lit(False)))
        ids = F.broadcast(able.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)  # at most ``bound`` ids
                          .select(F.col("doc_id").alias("__tox_id"), F.lit(True).alias("__tox_in")))
        marked = docs.join(ids, docs.doc_id == F.col("__tox_id"), "left").select(
            "doc_id", "text", "learn", (F.coalesce(F.col("__tox_in"), F.lit(False)) & F.col("learn")).alias("confirmed"))
        sizes = marked.agg(F.count_if("confirmed"), F.count_if("learn")).first()
        hashes, confirmed = confirmed_counts(marked.where("confirmed"))
        if not len(hashes):
            hashes, confirmed = np.zeros(1, np.uint64), np.zeros(1)
        seen = unlabelled_counts(marked.where("learn"), hashes)
        values = evidence(confirmed, seen, sizes[0], sizes[1], self.prior)
        without = evidence(np.maximum(confirmed - 1, 0), np.maximum(seen - 1, 0), sizes[0] - 1, sizes[1] - 1, self.prior)
        strong = np.flatnonzero(np.maximum(values, without) > LEVELS[0])
        strong = strong if len(strong) else np.array([0])
        self.hashes, self.values = hashes[strong], values[strong]
        self.rows = written(pooled(marked, self.hashes, self.values, without[strong]), "toxicity")
        self.weights, self.bias = None, 0.0
        if sizes[0]:
            self.weights, self.bias = train(self._counted("confirmed"), self._counted("learn"), self.prior)

    def _counted(self, which: str) -> tuple[np.ndarray, np.ndarray]:
        """The different pooled rows to learn from, and how often each occurs."""
        found = self.rows.where(which).groupBy("learned").agg(F.count("*").alias("n")).orderBy("learned").toArrow()
        return np.log1p(np.array(found.column("learned").to_pylist(), np.float64)), found.column("n").to_numpy().astype(np.float64)

    def scores(self) -> DataFrame:
        """doc_id, score of every document."""
        score = F.lit(0.0)
        if self.weights is not None:
            z = F.lit(self.bias)
            for j, w in enumerate(self.weights):
                z = z + F.lit(float(w)) * F.log1p(F.col("pooled")[j].cast("double"))
            score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return self.rows.select("doc_id", score.alias("score"))
