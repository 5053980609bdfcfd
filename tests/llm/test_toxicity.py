import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from passante.llm import toxicity
from tests.llm.helpers import docs, odd_rows, words



def learn():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1


RUDE = [f"rude{k}" for k in range(8)] + ["gremlich"]


def text(i, toxic):
    out, rnd = words(i, 120, 600).split(), random.Random(i)
    for _ in range(rnd.randrange(2, 6) if toxic else 0):
        word = rnd.choice(RUDE)
        out.insert(rnd.randrange(len(out)), word + (rnd.choice(["er", "en", "ung"]) if word == "gremlich" else ""))
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, text(i, i % 9 == 0)) for i in range(2400)]
    marks = spark.createDataFrame([(i, 1, int(i % 9 == 0), "x") for i in range(1500)] + [(None, 1, 1, "x"), (3, 1, None, "x")],
                                  "doc_id bigint, quality int, toxic int, good string")
    return docs(spark, rows), marks


def fold(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 3


def test_held_out_accuracy_and_labels_of_the_fold_are_not_read(spark, corpus):
    table, marks = corpus
    found = {r.doc_id: r.score for r in toxicity.Classifier(table, marks, learn()).scores().collect()}
    assert set(found) == set(range(2400)) and all(0 <= s <= 1 for s in found.values())
    unseen = [i for i in range(2400) if fold(i) == 1]
    assert np.mean([found[i] >= toxicity.TOXIC for i in unseen if i % 9 == 0]) > 0.95
    assert np.mean([found[i] < toxicity.TOXIC for i in unseen if i % 9]) > 0.98
    turned = marks.withColumn("toxic", F.when(F.expr("pmod(crc32(cast(doc_id as string)), 3) = 1"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.Classifier(table, turned, learn()).scores().collect()}
    assert again == found


def plain_features(text):
    """Whole word and prefixes, marked by length."""
    import re
    out = {}
    for w in re.findall(rb"(?:[0-9a-z]|[\x80-\xff])+", (text or "").lower().encode()):
        out.setdefault(w, set()).update({("whole", w), *((k, w[:k]) for k in toxicity.PREFIXES if len(w) >= k)})
    return out


def test_counts_equal_a_plain_count(spark):
    texts = ["Idiot idiots IDIOT", "idiot, the clown", None, "", "clown clown\x00é", "pathé pathétique", "idiotic"]
    table = docs(spark, list(enumerate(texts)))
    hashes, n = toxicity.confirmed_counts(table, least=1)
    want = {}
    for t in texts:
        for f in set().union(*plain_features(t).values()) if plain_features(t) else ():
            want[f] = want.get(f, 0) + 1
    assert sorted(n) == sorted(want.values())
    assert sorted(toxicity.unlabelled_counts(table, hashes)) == sorted(want.values())
    assert toxicity.unlabelled_counts(table, hashes).tolist() == n.tolist()


def test_risk_is_not_negative_and_prior_corrected():
    rnd = np.random.default_rng(3)
    toxic, clean = rnd.normal(2, 1, (400, 1)), rnd.normal(-2, 1, (3600, 1))
    unlabelled = np.concatenate([clean, rnd.normal(2, 1, (400, 1))])
    w, b = toxicity.train((toxic, np.ones(400)), (unlabelled, np.ones(4000)), 0.1)
    z = lambda x: x @ w + b
    assert (z(toxic) > 0).mean() > 0.9 and (z(clean) < 0).mean() > 0.98
    # repeated rows weigh as their counts
    w2, b2 = toxicity.train((toxic[:200], np.full(200, 2.0)), (unlabelled, np.full(4000, 3.0)), 0.1)
    w3, b3 = toxicity.train((np.repeat(toxic[:200], 2, axis=0), np.ones(400)), (unlabelled, np.ones(4000)), 0.1)
    assert w2 == pytest.approx(w3) and b2 == pytest.approx(b3)


def test_evidence_takes_the_toxic_share_off_the_unlabelled_rate():
    # a word of toxic text alone: a tenth of the documents is toxic, half of these have it
    value, = toxicity.evidence(np.array([50.0]), np.array([500.0]), 100, 10_000, 0.1)
    assert value == pytest.approx(np.log((50 + toxicity.SHRINK) / toxicity.SHRINK))
    common, = toxicity.evidence(np.array([50.0]), np.array([5000.0]), 100, 10_000, 0.1)
    assert common == pytest.approx(0.0)


def test_rounded_numbers():
    assert toxicity.rounded(np.arange(20)).tolist() == [0, 1, 2, 3, 4, 4, 6, 6, 8, 8, 8, 8, 12, 12, 12, 12, 16, 16, 16, 16]


def test_odd_rows_no_labels_and_empty_tables(spark, corpus):
    _, marks = corpus
    table = docs(spark, odd_rows())
    found = toxicity.Classifier(table, marks, learn()).scores()
    assert found.count() == len(odd_rows()) and found.where("score is null or not score between 0 and 1").count() == 0
    assert found.groupBy("doc_id").agg(F.count_distinct("score").alias("n")).where("doc_id = 7 and n <> 1").count() == 0
    assert {r.score for r in toxicity.Classifier(table, marks.limit(0), learn()).scores().collect()} == {0.0}
    assert toxicity.Classifier(table.limit(0), marks, learn()).scores().count() == 0


def test_slices_do_not_change_scores(spark, corpus):
    table, marks = corpus
    a = {r.doc_id: r.score for r in toxicity.Classifier(table.repartition(1), marks, learn()).scores().collect()}
    b = {r.doc_id: r.score for r in toxicity.Classifier(table.repartition(13), marks, learn()).scores().collect()}
    assert a == pytest.approx(b)


def test_rows_of_unlabelled_counts_do_not_grow_with_the_splits(spark):
    """A row per feature and task, of a number of tasks that the cores fix; the counts stay exact."""
    texts = ["alpha beta", "beta gamma", "gamma delta alpha", None, ""] * 80
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(300)
    _, starts, lengths, sums = toxicity.words(["alpha beta gamma delta"])
    hashes = np.sort(next(toxicity.features(starts, lengths, sums))[1])
    tasks = toxicity.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert toxicity.seen_by_task(docs, hashes).count() <= tasks * len(hashes)
    assert sorted(toxicity.unlabelled_counts(docs, hashes)) == [80, 160, 160, 160]
