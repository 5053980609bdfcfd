import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from passante.llm import embedding_pairs as pairs
from passante.llm import impact_search as impact

SCHEMA = "vec_id bigint, embedding array<float>, label int, node bigint, block string, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, "b", 0.5) for i, v, label in rows], SCHEMA)


def near(rng, centre, n, noise):
    return [centre + noise * rng.standard_normal(len(centre)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    vectors = [rng.standard_normal(16) for _ in range(300)]
    for c in range(6):
        vectors += near(rng, vectors[c], 25, 0.08 + 0.02 * c)
    out = [(i, np.float32(v), i % 3 if i < 300 else 1) for i, v in enumerate(vectors)]
    out += [(900, out[0][1], 0), (900, out[0][1], 0), (901, out[3][1] * 2, 0)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    out += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(1100, out[0][1], None), (None, out[0][1], 0)]
    return out


def test_links_equal_brute_force(spark, rows):
    good = [(k, i, np.asarray(v, np.float64), label) for k, (i, v, label) in enumerate(rows)
            if i is not None and label is not None and v is not None and None not in list(v) and len(v) and np.isfinite(np.float64(v)).all() and np.any(v)]
    linked = {k: set() for k, *_ in good}
    for a, _, va, la in good:
        for b, _, vb, lb in good:
            if a != b and la == lb and len(va) == len(vb) and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= pairs.COSINE:
                linked[a].add(b)
    ids = {k: i for k, i, *_ in good}
    least = {i: i for i in ids.values()}
    for _ in range(40):
        for a, bs in linked.items():
            for b in bs:
                least[ids[a]] = least[ids[b]] = min(least[ids[a]], least[ids[b]])
    want = sorted((i, len(linked.get(k, ())), least[i] if k in linked else i) for k, (i, *_) in enumerate(rows) if i is not None)
    got = pairs.link(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None) == want
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, False)]
    assert pairs.link(table(spark, [])).count() == 0
    assert sum(n for _, n, _ in want) > 1000


def test_blocks_of_any_size_give_the_same_links(spark, rows, monkeypatch):
    want = sorted(map(tuple, pairs.link(table(spark, rows)).where("vec_id is not null").collect()))
    monkeypatch.setattr(pairs, "BLOCK", 16)
    assert sorted(map(tuple, pairs.link(table(spark, rows)).where("vec_id is not null").collect())) == want


def test_count_is_calibrated():
    rng = np.random.default_rng(5)
    dim = 64
    a = rng.standard_normal((4000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    other = rng.standard_normal((4000, dim))
    other -= (other * a).sum(axis=1, keepdims=True) * a
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    b = pairs.COSINE * a + np.sqrt(1 - pairs.COSINE**2) * other * 0.999
    gaps = np.abs((a - b) @ pairs.directions(dim)[:, 1:])
    counts = (gaps <= pairs.WINDOW * pairs._gap(dim)).sum(axis=1)
    assert (counts >= pairs.calibrated(dim)).mean() > 0.998


def test_search_equals_brute_force(spark, rows):
    vectors = table(spark, rows)
    index = impact.build_index(vectors, shard=64)
    got = impact.search(index, vectors.where("vec_id % 7 = 0"), 10).collect()
    good = [(i, np.floor(1024 * np.float64(v)).astype(np.int64)) for i, v, _ in rows
            if i is not None and v is not None and len(v) and None not in list(v) and np.isfinite(np.float64(v)).all()]
    want = []
    for i, q in good:
        if i % 7 == 0:
            scored = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:10]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_search_ties_few_candidates_and_empty_tables(spark):
    same = [(i, [0.5, -0.25], 1) for i in range(1, 40)]
    vectors = table(spark, same)
    got = impact.search(impact.build_index(vectors, shard=8), vectors.where("vec_id = 5"), 3).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 1), (2, 2), (3, 3)]
    few = table(spark, same[:3])
    assert impact.search(impact.build_index(few), few.where("vec_id = 2"), 10).count() == 2
    none = table(spark, [])
    assert impact.search(impact.build_index(none), none, 10).count() == 0
    assert impact.search(impact.build_index(few), none, 10).count() == 0


def test_bounds_stop_early_and_never_lose_a_member():
    rng = np.random.default_rng(1)
    vectors = np.floor(1024 * rng.standard_normal((3000, 32)) / 6).astype(np.int64)
    ids = np.arange(3000)
    index = impact._shard(pd.DataFrame({"vec_id": ids, "embedding": list((vectors + 0.5) / 1024), "wide": False, "shard": 0})).iloc[0]
    assert (np.frombuffer(index.vectors, np.int32).reshape(vectors.shape) == vectors).all()
    shard = impact.Shard(ids, vectors, index.bits, np.frombuffer(index.postings, np.int32), np.frombuffer(index.segments, np.int64).reshape(3, -1))
    assert shard.length.sum() == vectors.size and np.bincount(shard.dimension).max() <= impact.LEVELS + 1
    one = np.zeros(32, np.int64)
    one[3] = 700  # a single dimension: its highest segments are enough
    assert shard.best(one, -1, 10)[2] <= vectors.size // 4
    for q in range(40):
        rows, scores, _ = shard.best(vectors[q], q, 10)
        exact = vectors @ vectors[q]
        exact[q] = exact.min() - 1
        want = np.lexsort((ids, -exact))[:10]
        assert rows.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()


def test_components_of_any_size_and_repeated_queries(spark):
    rng = np.random.default_rng(2)
    held = [(i, [float(np.float32(x)) for x in rng.standard_normal(3)], 1) for i in range(30)]
    held += [(30, [20000.0, -1.5, 0.25], 1), (31, [-1e6, 2e5, 3.0], 1), (32, [3e38, 1.0, -3e38], 1), (33, [16384.0, 0.0, 0.1], 1)]
    held = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in held]
    vectors = table(spark, held)
    got = impact.search(impact.build_index(vectors, shard=8), vectors.where("vec_id % 5 = 0 or vec_id > 29"), 6).collect()
    whole = {i: [math.floor(1024 * Fraction(x)) for x in v] for i, v, _ in held}
    want = []
    for q in whole:
        if q % 5 == 0 or q > 29:
            exact = {i: sum(a * b for a, b in zip(whole[q], v)) for i, v in whole.items() if i != q}
            # a score beyond 64 bits counts as the nearest 64-bit integer
            scores = sorted((-min(max(s, -2**63), 2**63 - 1), i) for i, s in exact.items())[:6]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    twice = table(spark, [held[0], held[0], held[1], held[2]])
    found = impact.search(impact.build_index(twice), twice.where("vec_id = 0"), 6).collect()
    assert sorted(r.vec_id for r in found) == [1, 1, 2, 2] and {r["rank"] for r in found} == {1, 2, 3, 4}
