"""Substring dedup by content-defined chunks with a gear rolling hash.

The hash of a position is the gear sum of the last 16 bytes (each step shifts
the 32-bit hash by two bits, so older bytes have left it).  A chunk ends where
the hash is the largest of the ``REACH`` positions on either side; so a cut
depends on the bytes near it alone, the chunks of a passage are the same
wherever it stands, and an insertion changes the chunks around it only.  A
stretch without such a position (periodic text) is cut at ``LONGEST`` bytes.
Cuts move to the next character boundary.

Chunks are compared by a 128-bit digest.  Digests are grouped (and counted
before the shuffle), those found in two documents or more are joined back to
their occurrences, and neighbouring repeated chunks of a document are joined
into runs.  A run of at least ``RUN_WORDS`` words is reported.  A passage of more
than 50 words that two documents share mostly holds such a run, but this is not
guaranteed: about 125 bytes at its ends are cut off, and a periodic passage has
cuts that depend on what stands before it.

Defined cases: null and empty texts have no chunks.  Repeats inside one document
are not reported.  Rows that share id (null or not) and text are one document;
other texts under the same id are documents of their own, told apart by a 64-bit
hash of the text.  An empty table gives an empty result.  Further columns are not read by ``repeats``;
``without_repeats`` keeps all columns (working columns begin with ``__cdc``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from passante.llm.common import text_slices, written

REACH = 24
LONGEST = 1024
RUN_WORDS = 20
_DIGEST = 16

_GEAR = np.random.Generator(np.random.Philox(4)).integers(1, 1 << 32, size=256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes up to each position; a zero byte adds nothing."""
    h = np.where(data == 0, np.uint32(0), _GEAR[data])
    for k in (1, 2, 4, 8):
        h[k:] = h[k:] + (h[:-k] << np.uint32(2 * k))
    return h


def _largest(h: np.ndarray, n: int) -> np.ndarray:
    """Maximum of the n values from each position on."""
    out, have = h.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[:-step] = np.maximum(out[:-step], out[step:])
        have += step
    return out


def cuts(texts: list[bytes]) -> list[np.ndarray]:
    """End offsets of the chunks of each text."""
    gap = 2 * REACH + 16
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + gap) - sizes  # a gap of zeros before each text
    data = np.zeros(int((sizes + gap).sum()) + gap, np.uint8)
    for t, s in zip(texts, starts):
        data[s:s + len(t)] = np.frombuffer(t, np.uint8)
    h = gear_hashes(data)
    h[data == 0] = 0  # the gaps have no cuts
    after = np.zeros_like(h)
    after[:-1] = _largest(h, REACH)[1:]
    before = np.zeros_like(h)
    before[REACH:] = _largest(h, REACH)[:-REACH]
    tops = np.flatnonzero((h > before) & (h > after))
    out = []
    parts = np.searchsorted(tops, np.stack([starts, starts + sizes]))
    for k, t in enumerate(texts):
        ends = tops[parts[0, k]:parts[1, k]] - starts[k] + 1
        body = data[starts[k]:starts[k] + sizes[k]]
        ends = ends[ends < len(t)]
        for _ in range(3):  # to the next first byte of a character
            inner = (body[ends] & 0xC0) == 0x80
            ends = ends + inner
            ends = ends[ends < len(t)]
        ends = np.unique(np.append(ends, len(t)))
        if len(t) and np.diff(ends, prepend=0).max() > LONGEST:
            more = [np.arange(a + LONGEST, b, LONGEST) for a, b in zip(np.append(0, ends[:-1]), ends) if b - a > LONGEST]
            more = np.concatenate(more)
            for _ in range(3):
                more = more + ((body[np.minimum(more, len(t) - 1)] & 0xC0) == 0x80)
            ends = np.unique(np.concatenate([ends, more[more < len(t)]]))
        out.append(ends if len(t) else ends[:0])
    return out


def chunk_rows(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """(text number, chunk number, start, end, words) as arrays, and the digests;
    starts and ends count characters, words are those that begin in the chunk."""
    parts = [(t or "").encode("utf-8") for t in texts]
    ends = cuts(parts)
    counts = np.array([len(e) for e in ends])
    starts = [np.append(0, e[:-1])[:len(e)] for e in ends]
    columns: list[list[np.ndarray]] = [[], [], []]
    digests = []
    for t, a, b in zip(parts, starts, ends):
        if not len(b):
            continue
        data = np.frombuffer(t, np.uint8)
        characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        space = _SPACE[data]
        words = np.append(0, np.cumsum(~space & np.append(True, space[:-1])))
        for c, x in zip(columns, (characters[a], characters[b], words[b] - words[a])):
            c.append(x)
        digests += [hashlib.blake2b(t[i:j], digest_size=_DIGEST).digest() for i, j in zip(a.tolist(), b.tolist())]
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return owner, number, *joined, digests


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, number, start, end, words, digest) of all chunks of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=1 << 20):
            owner, *numbers, digests = chunk_rows(batch.column("text").to_pylist())
            columns = [*(batch.column(k).take(pa.array(owner)) for k in (0, 1)), *(pa.array(x.astype(np.int32)) for x in numbers), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    schema = StructType([docs.schema["doc_id"], StructField("text_key", LongType()), *(StructField(n, IntegerType()) for n in ("number", "start", "end", "words")), StructField("digest", BinaryType())])
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def _spans(docs: DataFrame, run_words: int) -> DataFrame:
    """:func:`repeats` with the ``text_key`` of the document."""
    # a null id counts as the smallest
    found = written(chunks(docs), "cdc-chunks")
    document = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "text_key")
    shared = found.groupBy("digest").agg(F.min(document).alias("low"), F.max(document).alias("high")).where("low <> high")
    shared = written(shared.select("digest", F.col("low.doc_id").alias("first_doc_id"), F.col("low.text_key").alias("first_key")), "cdc-shared")
    own = ["doc_id", "text_key"]
    first = F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_key") == F.col("first_key"))
    marked = (found.join(shared, "digest").select(*own, "number", "start", "end", "words", "first_doc_id", first.alias("is_first"))
              .dropDuplicates([*own, "number"]))
    run = F.col("number") - F.row_number().over(Window.partitionBy(*own).orderBy("number"))
    runs = marked.withColumn("run", run)
    runs = runs.withColumn("run_words", F.sum("words").over(Window.partitionBy(*own, "run"))).where(F.col("run_words") >= run_words)
    part = F.col("number") - F.row_number().over(Window.partitionBy(*own, "run", "is_first").orderBy("number"))
    return (runs.withColumn("part", part).groupBy(*own, "run", "is_first", "part")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.min("first_doc_id").alias("first_doc_id"))
            .select(*own, "start", "end", "words", "first_doc_id", "is_first"))


def repeats(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, start, end, words, first_doc_id, is_first): the stretches of text
    that are repeated in another document, as parts of runs of at least
    ``run_words`` words; is_first: no document with a smaller id (or, under the
    same id, a smaller text hash) has them."""
    return _spans(docs, run_words).drop("text_key")


def without_repeats(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with every repeated stretch cut out of all documents but its first."""
    spans = (_spans(docs, run_words).where(~F.col("is_first")).groupBy(F.col("doc_id").alias("__cdc_id"), F.col("text_key").alias("__cdc_key"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cdc_spans")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    pieces = F.expr("""transform(sequence(0, size(__cdc_spans)), i -> substring(text,
      if(i = 0, 0, __cdc_spans[i - 1].end) + 1,
      if(i = size(__cdc_spans), length(text), __cdc_spans[i].start) - if(i = 0, 0, __cdc_spans[i - 1].end)))""")
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("__cdc_id")) & (F.xxhash64(F.col("text")) == F.col("__cdc_key")), "left")
    cut = F.when(F.col("__cdc_spans").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return joined.withColumn("text", cut).select(*columns)
