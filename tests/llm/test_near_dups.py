import itertools
import random
from collections import Counter

import numpy as np

from passante.llm import bagminhash as bag
from passante.llm import components
from passante.llm.components import connected_components
from tests.llm.helpers import docs, odd_rows, words


def multiset(text):
    w = text.encode().split()
    return Counter([tuple(w)]) if 0 < len(w) < 5 else Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def brute(rows):
    """doc_id -> smallest id of its component, over rows with ids."""
    held = [(i, multiset(t or "")) for i, t, *_ in rows if i is not None]
    least = {i: i for i, _ in held}
    links = [(i, j) for (i, a), (j, b) in itertools.combinations(held, 2) if similarity(a, b) >= 0.8]
    for _ in range(len(held)):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    return least


def edited(text, seed, share):
    rnd = random.Random(seed)
    return " ".join(w if rnd.random() > share else f"e{rnd.randrange(9999)}" for w in text.split())


def test_shingles_are_exact_multisets():
    for text in ["", "  ", "one", "a b c d", "a b c d e", "a b c d e f a b c d e f", words(1, 500, 6), "x\u00a0y z\tz\nz z z z"]:
        _, items, counts = bag.shingles([text])
        assert sorted(counts) == sorted(multiset(text).values())
    owner, _, counts = bag.shingles(["a b", "", None, words(2, 30)])
    assert np.bincount(owner, weights=counts, minlength=4).tolist() == [1, 0, 0, 26]


def test_signatures_estimate_the_weighted_jaccard_index_without_bias():
    rng = np.random.default_rng(3)
    gaps = []
    for _ in range(200):
        n = int(rng.integers(1, 50))
        items = rng.integers(1, 1 << 62, n).astype(np.uint64)
        wa, wb = rng.integers(0, 14, n), rng.integers(0, 14, n)
        wb = np.where(rng.random(n) < 0.7, wa, wb)
        if not wa.sum() or not wb.sum():
            continue
        a, b = np.flatnonzero(wa), np.flatnonzero(wb)
        s = bag.signatures(np.r_[a * 0, b * 0 + 1], np.r_[items[a], items[b]], np.r_[wa[a], wb[b]], 2)
        gaps.append((s[0] == s[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
    assert abs(np.mean(gaps)) < 0.01 and np.std(gaps) < 0.06


def test_classes_equal_brute_force(spark):
    rows = list(odd_rows())
    for k in range(12):
        base = words(100 + k, 120)
        rows += [(1000 + 40 * k + j, edited(base, 7 * k + j, (j % 6) * 0.012)) for j in range(30)]
    rows += [(5000 + k, words(900 + k, 60)) for k in range(60)] + [(6000, "x"), (6001, "x"), (6002, "x y")]
    got = bag.classes(docs(spark, rows)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got if r.doc_id is not None)


def test_large_buckets_of_mixed_clusters(spark):
    # copies around several centres that share a half: many members that no leader attracts
    shared = words(50, 100)
    rows = [(100 * c + j, shared + " " + edited(words(60 + c, 60), j, 0.01)) for c in range(40) for j in range(3)]
    got = {r.doc_id: r.class_id for r in bag.classes(docs(spark, rows)).collect()}
    assert got == brute(rows)


def test_one_row_of_each_group_stays(spark):
    rows = odd_rows()
    table = docs(spark, rows)
    kept = bag.deduplicated(table)
    assert kept.columns == table.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # texts without words all stay; 6 copies 5, the second 7 and the row without an id copy 7
    assert got == sorted([(True, 0), (True, 0), *((False, i) for i in (1, 2, 3, 4, 5, 7, 8, 9, 10))])
    assert bag.deduplicated(docs(spark, [])).count() == 0 and bag.classes(docs(spark, [])).count() == 0


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 300) if i % 50] + [(1000, rnd.randrange(2000, 2300)) for _ in range(300)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    least = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(400):
        for u, v in edges:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    assert got == least
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_components_store_each_step_once_and_end_at_stars(spark, monkeypatch):
    kept, stored = components.written, []
    monkeypatch.setattr(components, "written", lambda df, name: stored.append(name) or kept(df, name))

    def found(edges):
        stored.clear()
        frame = spark.createDataFrame([(b"%04d" % u, b"%04d" % v) for u, v in edges], "u binary, v binary")
        return {int(r.node): int(r.component) for r in connected_components(frame).collect()}

    # stars, with repeated and turned edges and loops: no round
    stars = [(10 * c, 10 * c + j) for c in range(1, 20) for j in range(1, 9)]
    assert found(stars + [(v, u) for u, v in stars] + stars[:5] + [(3, 3)]) == {x: x // 10 * 10 for e in stars for x in e}
    assert len(stored) == 2
    # a chain, a star whose centre is its largest node, and two stars that share a leaf
    others = [(i, i + 1) for i in range(100, 140)] + [(300, i) for i in range(200, 230)] + [(400, 450), (401, 450), (400, 440)]
    want = {x: 100 for x in range(100, 141)} | {x: 200 for x in [*range(200, 230), 300]} | dict.fromkeys([400, 401, 440, 450], 400)
    assert found(others) == want
    assert len(stored) <= 2 + 4 * 6  # rounds: the logarithm of 41 nodes
