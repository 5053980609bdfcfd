"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The word counts of the whole corpus are taken in one Spark job; the most
frequent ``lexicon_size`` words (a fixed bound) are encoded once on the driver
and compiled into a minimal acyclic automaton over their UTF-8 bytes.  Words
that share prefixes or suffixes share states; each arc carries the number of
words that sort before it, so that a walk ends at the word's number, which
indexes the id sequences.  The compiled file is sent out with ``addFile``, and
every Python worker maps it into memory.  A word outside the lexicon is merged
exactly by the vocabulary's merge ranks.

Vocabulary files: the ``tokenizers`` JSON format with NFC + white space +
lower-case normaliser, letters / single number / other pre-tokeniser and byte
level alphabet with a word-end suffix (``word_bpe_49k.json``).

Defined cases: a null or empty text has no ids and decodes to ''.  The strings
of the added tokens are found in the raw text and become their ids.  Rows are
handled one by one: repeated rows and null ids stay as they are.  An empty
table gives an empty table.  Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from passante.llm.common import local_file, text_slices, written

#: Words the automaton holds at most.
LEXICON_SIZE = 150_000
#: Bytes of texts that a worker has at a time, about.
SLICE = 1 << 20

# White space of the vocabulary's regular expression engine (fixed values).
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
# The same for texts whose characters are all below U+0250; a few times faster.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_NEAR_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t\n\x0b\x0c\r \x85\xa0{_LETTER}{_NUMBER}]+")
_FAR = re.compile("[^\x00-\u024f]")


def words_of(text: str) -> list[str]:
    """The pre-tokens of a text that holds no added token."""
    text = unicodedata.normalize("NFC", text)
    if not text.isascii():
        text = text.replace("\u03a3", "\u03c3")  # lower-casing goes character by character, without the final form
    text = text.lower()
    return (_WORD if _FAR.search(text) else _NEAR_WORD).findall(text)


def byte_alphabet() -> list[str]:
    """Byte -> printable character of the byte-level alphabet."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(0x100 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class Vocabulary:
    """Merge ranks, ids and added tokens of a vocabulary file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.alphabet = byte_alphabet()
        found = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.added_at = re.compile(f"({found})") if found else None

    def _merged(self, parts: list[str]) -> list[str]:
        """The merges of a short word, by a scan for the lowest rank."""
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
        return parts

    def merge(self, word: str) -> list[int]:
        """Exact ids of one pre-token: the pair of lowest rank merges first, the
        leftmost of equals, until no pair has a rank."""
        parts = [self.alphabet[b] for b in word.encode("utf-8")]
        parts[-1] += self.suffix
        if len(parts) <= 40:
            return [self.ids[p] for p in self._merged(parts)]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue  # one side was merged meanwhile
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := ranks.get((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [self.ids[p] for p in parts if p is not None]

    def pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between added tokens, and the added tokens with their ids."""
        if self.added_at is None or "<" not in text:
            yield text, None
            return
        for k, part in enumerate(self.added_at.split(text)):
            if k % 2:
                yield part, self.added[part]
            elif part:
                yield part, None


def compile_lexicon(entries: Iterable[tuple[str, list[int]]]) -> bytes:
    """The automaton file of (word, ids) pairs.

    Incremental construction over the words in byte order: when the next word
    leaves a branch, the branch's states are replaced by equal registered ones,
    from the end backwards.
    """
    ordered = sorted((w.encode("utf-8"), ids) for w, ids in dict(entries).items())
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def fixed(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    # path[d]: the open state at depth d: final, closed arcs; label[d] leads to path[d + 1]
    path: list[list] = [[False, []]]
    last = b""
    for word, _ in ordered:
        common = 0
        while common < len(last) and common < len(word) and last[common] == word[common]:
            common += 1
        for d in range(len(last), common, -1):
            final, arcs = path.pop()
            path[d - 1][1].append((last[d - 1], fixed(final, arcs)))
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    for d in range(len(last), 0, -1):
        final, arcs = path.pop()
        path[d - 1][1].append((last[d - 1], fixed(final, arcs)))
    root = fixed(*path[0])

    counts = [0] * len(states)
    first, labels, targets, skips = [0], bytearray(), [], []
    for s, (final, arcs) in enumerate(states):  # targets come before their sources
        total = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(total)
            total += counts[target]
        counts[s] = total
        first.append(len(labels))
    offsets, flat = [0], []
    for _, ids in ordered:
        flat += ids
        offsets.append(len(flat))
    head = struct.pack("<5I", root, len(states), len(labels), len(ordered), len(flat))
    ints = lambda xs: struct.pack(f"<{len(xs)}I", *xs)
    return b"".join([head, ints(first), ints(targets), ints(skips), ints(offsets), ints(flat),
                     bytes(f for f, _ in states), bytes(labels)])


_BYTES = [bytes((b,)) for b in range(256)]


class Lexicon:
    """A compiled lexicon, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, n, arcs, words, flat = struct.unpack_from("<5I", self.map)
        view, at = memoryview(self.map), 20
        parts = []
        for size in (n + 1, arcs, arcs, words + 1, flat):
            parts.append(view[at:at + 4 * size].cast("I"))
            at += 4 * size
        self.first, self.targets, self.skips, self.offsets, self.flat = parts
        self.final_at, self.labels_at = at, at + n

    def get(self, word: str) -> list[int] | None:
        state, number = self.root, 0
        first, targets, skips, base, find = self.first, self.targets, self.skips, self.labels_at, self.map.find
        for b in word.encode("utf-8"):
            arc = find(_BYTES[b], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            number += skips[arc]
            state = targets[arc]
        if not self.map[self.final_at + state]:
            return None
        return self.flat[self.offsets[number]:self.offsets[number + 1]].tolist()


class Encoder:
    """Vocabulary, lexicon and a bounded memory of the words met last: when the
    newer half is full it becomes the older one, which is forgotten.  What counts is
    characters and ids, and ``ENTRY`` for the objects that hold them."""

    REMEMBERED, ENTRY = 48 << 20, 150

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.packed: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def word(self, word: str) -> bytes:
        ids = self.lexicon.get(word) if self.lexicon else None
        if ids is None:
            ids = self.vocabulary.merge(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        for part, added in self.vocabulary.pieces(text or ""):
            if added is not None:
                out.append(struct.pack("<I", added))
                continue
            words = words_of(part)
            distinct = set(words)
            if self.held > self.REMEMBERED:
                self.packed, self.older, self.held = {}, self.packed, 0
            packed, older = self.packed, self.older
            for w in distinct.difference(packed):
                packed[w] = found = older.get(w) or self.word(w)
                self.held += len(w) + len(found) + self.ENTRY
            out.extend(map(packed.__getitem__, words))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The vocabulary has no decoder of its own: token strings, joined by a space."""
        return " ".join(map(self.vocabulary.token_of.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read())


@lru_cache(maxsize=4)
def _encoder(vocabulary_file: str, lexicon_file: str | None) -> Encoder:
    return Encoder(_vocabulary(SparkFiles.get(vocabulary_file)),
                   Lexicon(SparkFiles.get(lexicon_file)) if lexicon_file else None)


def _sent(df: DataFrame, kind: str, data: bytes) -> str:
    """Send a file to all executors; its name follows its content."""
    name = f"{kind}-{hashlib.sha256(data).hexdigest()[:16]}"
    context = df.sparkSession.sparkContext
    if not any(x.endswith(f"/{name}") for x in context.listFiles):
        context.addFile(local_file(name, data))
    return name


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all pre-tokens of all texts; words are counted within a
    task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        held: Counter = Counter()
        for batch in text_slices(batches, max_bytes=SLICE):
            for t in batch.column(0).to_pylist():
                if t:
                    held.update(words_of(t))
                if len(held) > 100_000:
                    yield emit(held)
                    held = Counter()
        if held:
            yield emit(held)

    return (docs.select(F.col(text).alias("text")).where("text is not null")
            .mapInArrow(count, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text: str = "text",
                  lexicon_size: int = LEXICON_SIZE) -> bytes:
    """Compile the most frequent words of the corpus: all words above the count
    that keeps them within ``lexicon_size``."""
    counts = written(word_counts(docs, text), "bpe-words")
    # words by their count: the driver reads the table only down to the bound
    above, least = 0, None
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if above + r.words > lexicon_size:
            break
        above, least = above + r.words, r.n
    if least is None:
        return compile_lexicon([])
    top = counts.where(F.col("n") >= least).select("word").toLocalIterator()
    return compile_lexicon((r.word, vocabulary.merge(r.word)) for r in top)


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", key: str = "doc_id",
           lexicon_size: int = LEXICON_SIZE, decoded: bool = False) -> DataFrame:
    """(key, token_ids): the ids of every whole text, packed as little-endian
    unsigned 32-bit integers; with ``decoded``, also what :func:`decode` makes of these
    ids, by the same worker, so a task holds one and not two.

    ``vocabulary_path`` is a file of the driver; it is sent to the executors.
    """
    with open(vocabulary_path, "rb") as f:
        data = f.read()
    vocabulary_file = _sent(docs, "vocabulary", data)
    lexicon_file = _sent(docs, "lexicon", build_lexicon(docs, Vocabulary(data), text, lexicon_size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_file, lexicon_file)
        for batch in text_slices(batches, max_bytes=SLICE):
            packed = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column(0), pa.array(packed, pa.binary())]
            if decoded:
                columns.append(pa.array([encoder.decode(x) for x in packed], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    source = docs.select(F.col(key), F.col(text).alias("text"))
    schema = StructType([docs.schema[key], StructField("token_ids", BinaryType()), *[StructField("decoded", StringType())] * decoded])
    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary_path: str, key: str = "doc_id") -> DataFrame:
    """(key, token_ids, decoded) of packed ids."""
    with open(vocabulary_path, "rb") as f:
        vocabulary_file = _sent(encoded, "vocabulary", f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_file, None)
        for batch in text_slices(batches, "token_ids", SLICE):
            texts = pa.array([encoder.decode(x) for x in batch.column("token_ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], [key, "token_ids", "decoded"])

    schema = StructType([encoded.schema[key], StructField("token_ids", BinaryType()), StructField("decoded", StringType())])
    return encoded.select(key, "token_ids").mapInArrow(run, schema)


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of packed ids and decoded text, per document."""
    return decoded.select(key, F.expr("cast(octet_length(token_ids) div 4 as bigint)").alias("n_tokens"),
                          F.sha2("token_ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
