import math
import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from passante.llm import chunks, importance, mixing
from tests.llm.helpers import docs, odd_rows, words


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, good string")


def good_text(seed, n=60):
    return words(seed, n, 300)


def bad_text(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(f"{rnd.choice(['BUY', 'WIN', 'x', 'zz'])}{rnd.choice(['!!', '***', '###'])}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, bad_text(i) if i % 5 == 0 else good_text(i)) for i in range(600)]
    return docs(spark, rows), labels(spark, [(i, int(i % 5 != 0), 0) for i in range(400)] + [(None, 1, 0), (1, None, 0), (2, 1, None)])


def test_held_out_accuracy(corpus):
    table, marks = corpus
    kept = {r.doc_id for r in importance.Resampler(table, marks).sampled_scores().collect()}
    unseen = range(400, 600)
    assert np.mean([(i in kept) == (i % 5 != 0) for i in unseen]) > 0.97
    assert np.mean([i in kept for i in unseen if i % 5]) > 0.97


def test_toxic_passages_of_long_texts_are_left_out(spark):
    rude = [f"rude{k}" for k in range(10)]

    def text(i):
        out, rnd = good_text(i, 200).split(), random.Random(i)
        at = rnd.randrange(170)
        for k in range(3 if i % 8 == 0 else 0):
            out.insert(at + 9 * k, rnd.choice(rude))
        return " ".join(out)

    table = docs(spark, [(i, text(i)) for i in range(1600)])
    fitted = importance.Resampler(table, labels(spark, [(i, 1, int(i % 8 == 0)) for i in range(1200)]))
    kept = {r.doc_id for r in fitted.sampled_scores().collect()}
    assert kept == {r.doc_id for r in fitted.resample(table).collect()}
    unseen = range(1200, 1600)
    assert np.mean([i in kept for i in unseen if i % 8 == 0]) < 0.1
    assert np.mean([i in kept for i in unseen if i % 8]) > 0.97


def test_worst_passage_equals_a_plain_scan():
    rnd, n = np.random.default_rng(1), importance.PASSAGE
    sizes = [0, 1, n - 1, n, n + 1, 0, 5 * n, 3, 0]
    parts = [rnd.normal(size=k) for k in sizes]
    want = [min((float(p[i:i + n].sum()) for i in range(max(1, len(p) - n + 1))), default=0.0) for p in parts]
    got = importance.worst_passages(np.repeat(np.arange(len(sizes)), sizes), np.concatenate(parts), len(sizes))
    assert got == pytest.approx(want)
    alone = [importance.worst_passages(np.zeros(len(p), np.int64), p, 1)[0] for p in parts]
    assert got.tolist() == alone


def test_top_k_equals_sorting(corpus):
    table, marks = corpus
    fitted = importance.Resampler(table, marks, k=100)
    everything = sorted(((r["__dsir_sum"], r.doc_id) for r in fitted.scores.collect()), reverse=True)
    assert {r.doc_id for r in fitted.sampled_scores().collect()} == {i for _, i in everything[:100]}
    kept = fitted.resample(table)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for _, i in everything[:100]}


def test_weights_equal_a_plain_count(spark):
    table = docs(spark, [(1, "Aa bb aa"), (2, "bb cc!!"), (3, None)])
    marks = labels(spark, [(1, 1, 0), (2, 0, 0)])
    if bool(importance.label_sample(marks).where("__dsir_id = 1 and __dsir_held").count()):
        pytest.skip("the only good label is held back")
    weights = importance.fit(table, marks)
    grams = {1: ["aa", "bb", "aa", "aa bb", "bb aa"], 2: ["bb", "cc", "!!", "bb cc", "cc !!"]}
    bucket = {}
    for i, t in ((1, "Aa bb aa"), (2, "bb cc!!")):
        owner, found = importance.ngram_buckets([t])
        assert len(found) == len(grams[i])
        bucket.update(zip(grams[i], found))
    raw, target = defaultdict(int), defaultdict(int)
    for i, gs in grams.items():
        for g in gs:
            raw[bucket[g]] += 1
            target[bucket[g]] += i == 1
    n = importance.BUCKETS
    for b in set(bucket.values()):
        want = math.log((target[b] + 1) / (5 + n)) - math.log((raw[b] + 1) / (10 + n))
        assert weights[b] == pytest.approx(want)


def test_gumbel_noise_samples_by_weight(spark):
    # three items of weights 1, 2 and 5 and k = 1: chances 1/8, 2/8 and 5/8
    log = {1: 0.0, 2: math.log(2), 3: math.log(5)}
    drawn = defaultdict(int)
    frame = spark.createDataFrame([(i,) for i in log], "doc_id bigint")
    noise = [frame.select("doc_id", importance.gumbel(seed).alias("g")) for seed in range(400)]
    together = noise[0].toDF("doc_id", "g0")
    together = frame.select("doc_id", *[importance.gumbel(seed).alias(f"g{seed}") for seed in range(400)]).collect()
    for seed in range(400):
        drawn[max(together, key=lambda r: log[r.doc_id] + r[f"g{seed}"]).doc_id] += 1
    assert abs(drawn[3] / 400 - 5 / 8) < 0.08 and abs(drawn[2] / 400 - 2 / 8) < 0.08


def test_kth_largest(spark):
    rnd = random.Random(1)
    values = [rnd.gauss(0, 10) for _ in range(500)] + [3.0] * 50 + [float(10**12)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 200, 260, 551):
        assert importance.kth_largest(frame, k, bins=8) == ranked[k - 1]
    assert importance.kth_largest(frame, 552) is None


def test_importance_of_odd_rows(spark):
    table = docs(spark, odd_rows())
    fitted = importance.Resampler(table, labels(spark, []))
    assert fitted.threshold == 0.0
    assert fitted.scores.count() == len(odd_rows())
    assert all(r["__dsir_weight"] == 0 for r in fitted.scores.where("__dsir_n = 0").collect())
    assert fitted.resample(table).columns == table.columns
    none = importance.Resampler(docs(spark, []), labels(spark, []))
    assert none.sampled_scores().count() == 0 and none.resample(docs(spark, [])).count() == 0


def plain_targets(sizes, weights):
    """Reshare step by step."""
    left, open_, out = float(sum(sizes)), set(range(len(sizes))), {}
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * unit > 3 * sizes[i]}
        if not full:
            out |= {i: weights[i] * unit for i in open_}
            break
        out |= {i: 3.0 * sizes[i] for i in full}
        left -= sum(out[i] for i in full)
        open_ -= full
    return [out[i] for i in range(len(sizes))]


def test_targets():
    rnd = random.Random(2)
    for _ in range(200):
        n = rnd.randint(1, 9)
        sizes, weights = [rnd.choice([0, 1, 5, 100, 10_000]) for _ in range(n)], [mixing.WEIGHTS[i % 3] for i in range(n)]
        assert mixing.capped_shares(sizes, weights) == pytest.approx(plain_targets(sizes, weights))


def mixed(spark, rows):
    return mixing.Mixer(docs(spark, rows)).taken().collect()


def test_sources_meet_their_targets(spark):
    rnd = random.Random(3)
    rows = [(i, words(i, int(rnd.lognormvariate(4, 1)) + 1), f"s{i % 7 if i % 3 else 0}" if i % 11 else None) for i in range(1500)]
    got = mixed(spark, rows)
    assert sorted(r.doc_id for r in got) == list(range(1500))
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in mixed(spark, rows[::-1]))
    size = {i: len(t.split()) for i, t, _ in rows}
    taken, targets = defaultdict(int), {}
    for r in got:
        assert r.size == size[r.doc_id] and 0 <= r.taken <= 3 * r.size
        taken[rows[r.doc_id][2]] += r.taken
        targets[rows[r.doc_id][2]] = r.target
    order = sorted((s for s in targets if s is not None)) + [None]
    sizes = [sum(size[i] for i, _, s in rows if s == source) for source in order]
    assert [targets[s] for s in order] == pytest.approx(plain_targets(sizes, [mixing.WEIGHTS[k % 3] for k in range(len(order))]))
    for s in order:
        assert taken[s] == pytest.approx(targets[s], rel=0.01)


def test_rates_are_exponentially_tilted(spark):
    rnd = random.Random(4)
    rows = [(i, words(i, rnd.randint(1, 300)), "ab"[i % 2]) for i in range(400)]
    mixer = mixing.Mixer(docs(spark, rows))
    r = mixer.sized.withColumn("rate", mixing.rate()).collect()
    for source, target, dual, n, c in zip(mixer.plan.sources, mixer.plan.targets, mixer.plan.duals, mixer.plan.sizes, mixer.plan.docs):
        own = [x for x in r if x.source == source]
        assert all(x.rate == pytest.approx(min(3, math.exp(dual * x["__mix_size"] * c / n))) for x in own)
        assert sum(x.rate * x["__mix_size"] for x in own) == pytest.approx(target, rel=1e-6)


def test_mixing_odd_rows(spark):
    rows = odd_rows()
    got = mixed(spark, rows)
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
    assert all(r.taken == 0 for r in got if r.size == 0)
    table = docs(spark, rows)
    mixer = mixing.Mixer(table)
    out = mixer.mix(table)
    assert out.columns == table.columns and out.count() == sum(r.copies for r in mixer.taken().collect())
    assert mixed(spark, []) == []
    assert [r.taken for r in mixed(spark, [(1, None), (2, "")])] == [0, 0]
    # many equal rows share their copies
    same = mixed(spark, [(1, "a b c", "x")] * 50 + [(2, words(1, 500), "y")])
    assert sum(r.taken for r in same if r.doc_id == 1) == pytest.approx(450, rel=0.02)


def plain_cuts(text):
    """Content-defined cuts of one text, position by position."""
    g = [0 if b == 0 else int(chunks._GEAR[b]) for b in text]
    h = [sum(g[p - k] << (2 * k) for k in range(16) if p >= k) % (1 << 32) if text[p] else 0 for p in range(len(text))]
    ends = []
    for p in range(len(text)):
        near = h[max(0, p - chunks.REACH):p] + h[p + 1:p + chunks.REACH + 1]
        if h[p] > max(near, default=0):
            ends.append(p + 1)
    moved = []
    for e in ends:
        while e < len(text) and text[e] & 0xC0 == 0x80:
            e += 1
        if e < len(text):
            moved.append(e)
    return sorted({*moved, len(text)}) if text else []


def test_cuts_equal_a_plain_scan():
    texts = [words(1, 80).encode(), "é ñ 日本 ".encode() * 30, b"", b"a", b"a\x00b" * 40, words(2, 5).encode()]
    for t, ends in zip(texts, chunks.cuts(texts)):
        assert ends.tolist() == plain_cuts(t)
    periodic = b"und " * 3000
    ends = chunks.cuts([periodic])[0]
    assert np.diff(ends, prepend=0).max() <= chunks.LONGEST and ends[-1] == len(periodic)


def test_insertions_leave_far_chunks_alone():
    a = words(3, 400).encode()
    b = a[:500] + b" inserted words " + a[500:]
    pieces = lambda t: {t[i:j] for i, j in zip([0, *chunks.cuts([t])[0][:-1]], chunks.cuts([t])[0])}
    assert len(pieces(a) - pieces(b)) <= 4


def test_repeated_passages_are_found_and_clean_documents_are_not(spark):
    passage = [words(5000 + k, 51) for k in range(20)]
    rows = [(i, words(i, 150)) for i in range(200)]
    rows += [(1000 + 2 * k + j, f"{words(9000 + 2 * k + j, 20 * j + 7)} {passage[k]} {words(7000 + 2 * k + j, 33)}") for k in range(20) for j in (0, 1)]
    table = docs(spark, rows + odd_rows())
    got = chunks.repeats(table).collect()
    text = dict(rows)
    found = {r.doc_id for r in got}
    assert found >= set(range(1000, 1040)) and not found & set(range(11, 200))
    for r in got:
        if r.doc_id is not None and r.doc_id >= 1000:
            piece = text[r.doc_id][r.start:r.end]
            assert piece in text[r.doc_id ^ 1] and piece[2:-2].strip() in passage[(r.doc_id - 1000) // 2]
            assert r.words >= 20 and r.is_first == (r.doc_id % 2 == 0) and r.first_doc_id == r.doc_id - r.doc_id % 2
    cut = chunks.without_repeats(table)
    assert cut.columns == table.columns and cut.count() == table.count()
    spans = {r.doc_id: (r.start, r.end) for r in got if not r.is_first}
    for r in cut.collect():
        if r.doc_id is not None and r.doc_id >= 1000:
            a, b = spans.get(r.doc_id, (0, 0))
            assert r.text == text[r.doc_id][:a] + text[r.doc_id][b:]
    assert chunks.repeats(docs(spark, [])).count() == 0


def test_texts_that_share_an_id_are_told_apart(spark):
    passages = [words(600 + k, 90) for k in range(3)]
    rows = [(1, f"{words(700, 30)} {passages[0]}"), (2, f"{words(701, 60)} {passages[1]}"), (3, words(702, 120))]
    rows += [(9, f"{words(710, 40)} {passages[0]} {words(711, 25)}"), (9, f"{words(712, 200)} {passages[1]}"), (9, words(713, 300))]
    rows += [(None, f"{words(720, 15)} {passages[2]}"), (None, f"{words(721, 70)} {passages[2]}"), (None, words(722, 300)), (None, words(722, 300))]
    got = {}
    for r in chunks.without_repeats(docs(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for i, text in rows[:3]:
        assert got[i] == [text]
    shorter = {i: sorted(t for t in got[i] if t not in [x for j, x in rows if j == i]) for i in (9, None)}
    assert len(shorter[9]) == 2 and len(shorter[None]) == 1
    assert got[9].count(rows[5][1]) == 1 and got[None].count(rows[8][1]) == 2
    for begin, end, k in ((words(710, 40), words(711, 25), 0), (words(712, 200), "", 1)):
        cut = next(t for t in shorter[9] if t.startswith(begin))
        assert cut.endswith(end) and len(cut) < len(f"{begin} {end}") + 200 < len(f"{begin} {passages[k]} {end}")


def test_pipeline_end_to_end(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs_now, counts = table, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = corpus_pipeline.written(stage(spark, docs_now, sf), "test-stage")
        assert docs_now.columns == table.columns
        counts.append(docs_now.count())
    assert 0 < counts[1] < counts[0] < table.count() and counts[2] == counts[1]
    last = corpus_pipeline.STAGES[-1][1](spark, docs_now, sf)
    assert last.count() == counts[3]
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in docs_now.select("doc_id").collect()}
    # reruns agree
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, last.collect()))
