"""MinHash near-dedup of multisets of word shingles with BagMinHash.

A document is the multiset of its five-word shingles; the similarity of two
documents is the weighted Jaccard index of the multisets.  A signature has 125
registers.  Every shingle starts Poisson processes over its weight axis, which
is laid out in the intervals [0, 1), [1, 2), [2, 4), [4, 8) ...; an interval's
process has a rate as large as the interval is long.  A point falls on a random
register and, by random halvings of the interval, on a weight level; it counts
if the level is below the shingle's multiplicity.  A register keeps the time of
its earliest point, and a process ends when its time is past all registers, so
a signature costs about as many points as there are shingles plus a fixed
number.  Two documents agree in a register with a probability equal to their
weighted Jaccard index: all weights are whole numbers, so the levels are exact
and the estimate is unbiased.

Candidates are documents that agree in one of 25 bands of 5 registers (a pair
at 0.8 is missed with a probability of 5e-5).  Equal word sequences are one node
from the start; texts of a task that were signed before are not signed again.
Within a band bucket nobody compares all pairs: every member is verified against
the bucket's least node, by the exact multisets.  What that leaves open are links
between two other members.  The buckets' stars join their nodes into families; a
family in which not all nodes hang on one head is dealt into blocks of about
``MEMBERS`` nodes, and a task holds two of its blocks.  There the registers of
nodes under different heads are compared, and those that agree in at least
``LIKELY`` of 125 (a pair at 0.8 is missed with a probability below 1e-6) are
verified exactly, the likeliest first; a link joins two heads, whose other pairs
are then not needed.  A task emits only the links that join something, so no link
that could change a group is lost but for that chance.

Defined cases: a text of one to four words is one shingle of all its words; a
null text or one without words is in no group.  Repeated rows and equal texts
are in one group.  Null ids take part and never name a group that has another
id.  An empty table gives an empty result.  Further columns are not read by
``classes``; ``deduplicated`` keeps all columns (working columns begin with
``__bag``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from passante.llm.common import text_slices, written
from passante.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Nodes of a family that a block holds, and bytes of their texts, on average.
MEMBERS, BLOCK_BYTES = 512, 8 << 20
#: Digests of texts that a task remembers as signed.
REMEMBERED = 100_000
#: A pair at SIMILARITY agrees in a smaller share of its registers with a probability below 1e-6.
LIKELY = 0.62

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.Generator(np.random.Philox(10)).integers(0, 1 << 63, size=(32, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, multiplicity), ordered by the first two."""
    parts = [(t or "").encode("utf-8") for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    inside = ~_SPACE[data]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    empty = np.zeros(0, np.int64)
    if not len(starts):
        return empty, empty.astype(np.uint64), empty
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    sizes = ends - starts
    letters = np.flatnonzero(inside)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    words = _mix(np.add.reduceat(_TABLE[place & 31, data[letters]], first) + sizes.astype(np.uint64))
    owner = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), starts, side="right")
    n_words = np.bincount(owner, minlength=len(parts))
    width = np.minimum(n_words, SHINGLE)[owner]  # a short text is one shingle
    last = np.cumsum(n_words)[owner]
    at = np.arange(len(words))
    held = at + width <= last
    whole = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        use = held & (k < width)
        i = at[use]
        whole[i] = _mix(whole[i] + _GOLD + words[i + k])
    owner, whole = owner[held], whole[held]
    order = np.lexsort((whole, owner))
    owner, whole = owner[order], whole[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])]))
    return owner[new], whole[new], np.diff(np.append(new, len(whole)))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(owner: np.ndarray, items: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """The registers of ``n`` bags given as (bag, item, whole weight): earliest
    point times, infinite for an empty bag."""
    registers = np.full(n * REGISTERS, np.inf)
    # one process for each interval that begins below the weight
    count = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1
    item = np.repeat(np.arange(len(items)), count)
    interval = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    bag, weight = owner[item], weights[item]
    low = np.where(interval > 0, 1 << np.maximum(interval - 1, 0), 0)
    length = np.where(interval > 0, np.maximum(low, 1), 1)
    seed = _mix(items[item] + _GOLD * (interval.astype(np.uint64) + np.uint64(1)))
    time = np.zeros(len(item))
    step = 0
    while len(bag):
        step += 1
        base = seed + np.uint64(int(_GOLD) * step % (1 << 64))
        time = time - np.log(_uniform(_mix(base))) / length
        place = _mix(base + _M1)
        level = low + (place >> np.uint64(32)).astype(np.int64) * length // (1 << 32)
        counts = level < weight
        slot = bag * REGISTERS + ((place & np.uint64(0xFFFFFFFF)).astype(np.int64) * REGISTERS >> 32)
        np.minimum.at(registers, slot[counts], time[counts])
        latest = registers.reshape(n, REGISTERS).max(axis=1)
        go = time < latest[bag]
        bag, weight, low, length, seed, time = bag[go], weight[go], low[go], length[go], seed[go], time[go]
    return registers.reshape(n, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each bag and band; the band's number is part of it."""
    bits = registers.view(np.uint64).reshape(len(registers), BANDS, ROWS)
    keys = np.broadcast_to(_GOLD * np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2])
    for k in range(ROWS):
        keys = _mix(keys + bits[:, :, k])
    return keys.view(np.int64)


def register_marks(registers: np.ndarray) -> np.ndarray:
    """16 bits of each register, enough to estimate a similarity."""
    return (_mix(registers.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def word_digests(texts: list[str | None]) -> list[bytes | None]:
    """A 16-byte digest of each word sequence; null without words."""
    words = [b" ".join((t or "").encode("utf-8").split()) for t in texts]
    return [hashlib.md5(w).digest() if w else None for w in words]


def _text_key() -> Column:
    return F.xxhash64("text")


def _has_words() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, node, bands, marks) for every row: the text's hash, the digest
    of its words and, for the first text of a task with these words, its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in text_slices(batches, max_bytes=1 << 20):
            texts = batch.column("text").to_pylist()
            nodes = word_digests(texts)
            fresh = []
            for i, node in enumerate(nodes):
                if node is not None and node not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(node)
                    fresh.append(i)
            bands, marks = [None] * len(nodes), [None] * len(nodes)
            if fresh:
                registers = signatures(*shingles([texts[i] for i in fresh]), len(fresh))
                for i, keys, mark in zip(fresh, band_keys(registers), register_marks(registers)):
                    bands[i], marks[i] = keys, mark.tobytes()
            columns = [batch.column("doc_id"), batch.column("key"), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "node", "bands", "marks"])

    schema = StructType([docs.schema["doc_id"], StructField("key", LongType()), StructField("node", BinaryType()),
                         StructField("bands", ArrayType(LongType())), StructField("marks", BinaryType())])
    return docs.select("doc_id", _text_key().alias("key"), "text").mapInArrow(run, schema)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two bags given as sorted items and their weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    return shingles([text])[1:]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in text_slices(batches, "text_b", 1 << 20):
            similar = []
            for a, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if a != last:  # neighbours often share it
                    last, bag = a, _bag(text_a)
                similar.append(weighted_jaccard(bag, _bag(text_b)) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(similar, pa.bool_()))

    members = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = members.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def _joining_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links between nodes under different heads, of one block or of two blocks of a
    family: enough of them to join all heads that any link joins."""
    nodes, parts = group["node"].tolist(), group["part"].to_numpy()
    two = parts.min() != parts.max()
    if not two and group["i"].iloc[0] != group["j"].iloc[0]:  # the other block is empty
        return pd.DataFrame({"a": [], "b": []}, dtype=object)
    marks = np.stack([np.frombuffer(m, np.uint16) for m in group["marks"]])
    under = pd.factorize(group["head"])[0]
    owner, items, weights = shingles(group["text"].tolist())
    ends = np.searchsorted(owner, np.arange(len(nodes) + 1))
    total = np.add.reduceat(weights, ends[:-1])
    out = []
    for r in np.flatnonzero(parts == parts.min()):
        partners = np.flatnonzero(parts != parts[r]) if two else np.arange(r + 1, len(nodes))
        partners = partners[under[partners] != under[r]]
        if not len(partners):
            continue
        share = (marks[partners] == marks[r]).mean(axis=1)
        likely = share >= LIKELY
        partners = partners[likely][np.argsort(-share[likely], kind="stable")]
        own, own_weights = items[ends[r]:ends[r + 1]], weights[ends[r]:ends[r + 1]]
        step = 4
        while len(partners):
            tried, partners = partners[:step], partners[step:]
            step = min(2 * step, 64)
            held = np.concatenate([np.arange(ends[c], ends[c + 1]) for c in tried])
            starts = np.cumsum([0, *(ends[tried + 1] - ends[tried])[:-1]])
            place = np.minimum(np.searchsorted(own, items[held]), len(own) - 1)
            both = np.add.reduceat(np.where(own[place] == items[held], np.minimum(own_weights[place], weights[held]), 0), starts)
            similarity = both / (total[r] + total[tried] - both)
            for c in tried[similarity >= SIMILARITY]:
                if under[c] != under[r]:
                    out.append((nodes[r], nodes[c]))
                    under[under == under[c]] = under[r]
            partners = partners[under[partners] != under[r]]
    return pd.DataFrame(out, columns=["a", "b"], dtype=object)


def _family_links(pairs: DataFrame, links: DataFrame, marks: DataFrame, texts: DataFrame) -> DataFrame:
    """The links that ``links``, those with the least nodes of buckets, leave open."""
    families = connected_components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("component", "family")
    heads = written(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("head")), "bag-heads")
    higher = heads.select(F.col("node").alias("head"), F.col("head").alias("above"))
    heads = heads.join(higher, "head", "left").select("node", F.coalesce("above", "head").alias("head"))
    members = written(families.join(heads, "node", "left").select("family", "node", F.coalesce("head", "node").alias("head"))
                      .join(texts.select("node", F.octet_length("text").alias("size")), "node"), "bag-members")
    parts = F.ceil(F.greatest(F.count("*") / MEMBERS, F.sum("size") / BLOCK_BYTES)).cast("int")
    open_ones = written(members.groupBy("family").agg(F.count("*").alias("n"), F.min("head").alias("least"), F.max("head").alias("last"), parts.alias("parts"))
                        .where("n > 2 and least <> last").select("family", "parts"), "bag-families")
    dealt = (members.join(open_ones, "family").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    dealt = dealt.join(marks, "node").join(texts, "node").select(
        "family", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "head", "part", "marks", "text")
    return dealt.groupBy("family", "i", "j").applyInPandas(_joining_links, "a binary, b binary")


def _components(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    signed = rows.where("bands is not null")
    entries = signed.select("node", F.explode("bands").alias("bucket"))
    hashed = F.xxhash64("node")  # repeated nodes are one
    shared = written(entries.groupBy("bucket").agg(F.min(hashed).alias("least"), F.max(hashed).alias("last")).where("least <> last").select("bucket"), "bag-buckets")
    entries = written(entries.join(shared, "bucket").distinct(), "bag-entries")
    leaders = written(entries.groupBy("bucket").agg(F.min("node").alias("a")), "bag-leaders")
    pairs = written(entries.join(leaders, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "bag-pairs")
    # the texts of the nodes that have a bucket mate, one row each
    asked = written(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "bag-asked")
    chosen = rows.join(asked, "node").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"), F.max("marks").alias("marks"))
    chosen = written(chosen.select("node", "marks", F.col("first.doc_id").alias("c_id"), F.col("first.key").alias("c_key")), "bag-chosen")
    texts = (docs.select("doc_id", "text", _text_key().alias("key"))
             .join(chosen.select("node", "c_id", "c_key"), (F.col("key") == F.col("c_key")) & F.col("doc_id").eqNullSafe(F.col("c_id")))
             .select("node", "text").dropDuplicates(["node"]))
    texts = written(texts, "bag-texts")
    links = written(_verified(pairs, texts), "bag-links")
    more = written(_family_links(pairs, links, chosen.select("node", "marks"), texts), "bag-more")
    return connected_components(links.union(more).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (node, class_id, class_key, class_node): the first row of
    each node's component (smallest id; its text's hash) and its node."""
    rows = written(_signed(docs.select("doc_id", "text")), "bag-rows")
    parts = written(_components(docs, rows), "bag-components")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node", "key"))
    nodes = written(rows.where("node is not null").groupBy("node").agg(first.alias("first")), "bag-nodes")
    # only the nodes that have a link are grouped
    joined = nodes.join(parts, "node")
    least = written(joined.groupBy("component").agg(F.min("first").alias("least")), "bag-first")
    linked = written(parts.join(least, "component").select(F.col("node").alias("l_node"), "least"), "bag-linked")
    named = nodes.join(linked, F.col("node") == F.col("l_node"), "left").select("node", F.coalesce("least", "first").alias("first"))
    return rows, named.select("node", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key"), F.col("first.node").alias("class_node"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, kept) for every row: the group's smallest id, and whether
    it is this row's.  A text without words is a group of its own."""
    rows, named = _named(docs)
    rows = rows.select("doc_id", "node").join(written(named, "bag-classes"), "node", "left")
    class_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return rows.select("doc_id", class_id.alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of each group: its smallest id (one of equal
    rows).  Texts without words all stay."""
    named = _named(docs)[1]
    first = written(named.where(F.col("node") == F.col("class_node")).select(
        F.col("node").alias("__bag_node"), F.col("class_id").alias("__bag_id"), F.col("class_key").alias("__bag_first")), "bag-first")
    marked = docs.withColumn("__bag_key", _text_key())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = (marked.join(first, (F.col("__bag_key") == F.col("__bag_first")) & F.col("doc_id").eqNullSafe(F.col("__bag_id")))
            .dropDuplicates(["__bag_node"]))
    return kept.select(*columns).union(docs.where(~_has_words()))
