import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from passante.llm import fim, merkle
from tests.llm.helpers import docs, odd_rows, words


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, arity):
    """Root and the proofs of a list of leaves, by hand."""
    proofs, places, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        runs = [nodes[i:i + arity] for i in range(0, len(nodes), arity)]
        for leaf, at in enumerate(places):
            run, slot = runs[at // arity], at % arity
            proofs[leaf].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        places = [at // arity for at in places]
        nodes = [h(*run) for run in runs]
    return nodes[0], proofs


def plain_manifest(rows, arity):
    """(root, sorted (id, leaf, subroot, proof)) of (id, text, source) rows."""
    groups = {}
    for i, text, source in rows:
        leaf = plain_leaf(i, source, "en", None if text is None else len(text), text)
        groups.setdefault(source, []).append((i, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        found[s] = plain_tree([leaf for _, leaf in groups[s]], arity)
    root, above = plain_tree([found[s][0] for s in names], arity)
    out = [(i, leaf, found[s][0], proof + above[k]) for k, s in enumerate(names) for (i, leaf), proof in zip(groups[s], found[s][1], strict=True)]
    return root, sorted(out, key=repr)


def collected(manifest):
    return sorted(((r.place, r.leaf, r.subroot, [tuple(x) for x in r.proof]) for r in manifest.proofs().collect()), key=repr)


def many():
    sizes = {"hot": 100, "one": 1, "two": 2, "three": 3, "four": 4, "é": 28, None: 10}
    return [(100 * k + i, words(100 * k + i, 5), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_hashing_by_hand(spark, arity):
    manifest = merkle.Manifest(docs(spark, many()).repartition(7), arity=arity)
    root, want = plain_manifest(many(), arity)
    assert manifest.root == root and collected(manifest) == want


def test_odd_rows_and_repeated_rows(spark):
    rows = odd_rows() + [(7, words(7, 40), "b")] * 30
    manifest = merkle.Manifest(docs(spark, rows))
    root, want = plain_manifest(rows, 3)
    assert manifest.root == root and collected(manifest) == want


def test_lone_leaf_and_empty_table(spark):
    table = docs(spark, [(1, "a b", "s")])
    manifest = merkle.Manifest(table)
    leaf = plain_leaf(1, "s", "en", 3, "a b")
    assert manifest.root == leaf and collected(manifest) == [(1, leaf, leaf, [])]
    empty = merkle.Manifest(table.limit(0))
    assert empty.root is None and empty.proofs().count() == 0


def test_only_the_manifest_rows_fold_to_the_root(spark):
    changed = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    claimed = merkle.leaf_hash([changed if c == "text" else F.col(c) for c in merkle.COLUMNS])
    manifest = merkle.Manifest(docs(spark, many()), carried={"claimed": claimed})
    folded = manifest.proofs().select("place", merkle.folded(F.col("claimed"), F.col("proof")).alias("root")).collect()
    assert {r.place for r in folded if r.root != manifest.root} == {i for i, _, _ in many() if i % 3 == 0}


def test_levels_join_each_node_once(spark):
    manifest = merkle.Manifest(docs(spark, many()))
    sizes = [runs.count() for runs in manifest.groups.runs]
    counts = {"hot": 100, "two": 2, "three": 3, "four": 4, "é": 28, None: 10}
    want = []
    while any(n > 1 for n in counts.values()):
        counts = {s: -(-n // 3) for s, n in counts.items() if n > 1}
        want.append(sum(counts.values()))
    assert sizes == want


def plain_fim(doc_id, text, sentinels=fim.SENTINELS, rate=100, suffix_first=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = h(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digits[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or any(s in text for s in sentinels) or h3 % 100 >= rate:
        return text, "plain", n, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    x, y, z = sentinels
    out = y + s + x + p + z + m if h4 % 100 < suffix_first else x + p + y + s + z + m
    return out, "spm" if h4 % 100 < suffix_first else "psm", n, len(p), len(m)


FIM_ROWS = odd_rows() + [(20 + i, t, "s") for i, t in enumerate(
    ["\n", "\n\n\n", "a\nb", "a\nb\n", "x <P> y\nz", "<S>", "a\n<M>", "<\n<<\nS>\nP>\n", "é\n\U0001F600\nú\n" * 40, "\n" * 50_000, "a\r\nb\r\n", "q" * 100_000])]


@pytest.mark.parametrize("options", [{}, {"rate": 40}, {"suffix_first": 0}, {"sentinels": ("[PRE]", "{SUF}", "#MID"), "seed": 3}])
def test_fim_equals_slicing_of_lists_and_restores(spark, options):
    out = fim.transform(docs(spark, FIM_ROWS), **options)
    back = fim.restored(sentinels=options.get("sentinels", fim.SENTINELS))
    rows = out.withColumn("back", back).collect()
    got = sorted(((r.doc_id, r.fim_text, r.fim_form, r.fim_n, r.fim_prefix_chars, r.fim_middle_chars) for r in rows), key=repr)
    assert got == sorted(((i, *plain_fim(i, t, **options)) for i, t, _ in FIM_ROWS), key=repr)
    assert all(r.back == (r.text or "") for r in rows)
    assert out.limit(0).count() == 0 and fim.transform(docs(spark, FIM_ROWS).limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 17, 400, 5000])
def test_skip_list_offsets_equal_prefix_sums(n):
    widths = np.random.default_rng(n).integers(1, 60, n)
    lines, sums = fim.SkipList(widths), np.append(0, np.cumsum(widths))
    assert [lines.offset(r) for r in range(n + 1)] == sums.tolist()
    assert n < 100 or len(lines.units) > 3
    for lane in range(len(lines.units)):
        assert lines.units[lane].sum() == n and lines.chars[lane].sum() == sums[-1]
    with pytest.raises(IndexError):
        lines.offset(n + 1)


def test_overlapping_sentinels_are_refused(spark):
    for bad in (("<P>", "<P>", "<M>"), ("", "b", "c"), ("aa", "b", "c"), ("ab", "bc", "d")):
        with pytest.raises(ValueError):
            fim.transform(docs(spark, []), sentinels=bad)


def test_crc_in_spark_is_the_unsigned_one(spark):
    ids = [0, 1, 17, 123456789]
    found = spark.createDataFrame([(i,) for i in ids], "i bigint").select("i", F.crc32(F.col("i").cast("string")).alias("c")).collect()
    assert [r.c for r in found] == [zlib.crc32(str(i).encode()) for i in ids]
