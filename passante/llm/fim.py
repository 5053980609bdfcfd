"""Fill-in-middle documents, cut by an indexable skip list.

A text is a list of lines.  The list is indexed by a skip list whose links, on
every express lane, carry two widths: how many lines and how many code points
they pass.  The two cuts are ranks of lines; descending from the highest lane,
a search adds up widths as long as the rank is not passed and so reaches the
cut exactly, with its offset in code points, in a logarithmic number of steps.
Towers have fixed random heights (a hash of the line's number), so reruns agree.

The cuts and the form of a document are functions of seed and id:
h1 to h4 are the first four 32-bit words of sha256("seed:id").  The prefix ends after the
smaller of h1 % (n + 1) and h2 % (n + 1) of n lines, the middle after the larger.

Defined cases: a null text is an empty one; empty texts, and those that
hold a sentinel, stay plain.  A null id is hashed as no digits.  Repeated rows
give equal rows.  A single line of any length is one link.  An empty table gives
an empty result.  All columns stay; the added ones begin with ``fim_`` and must
not be among them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from passante.llm.common import text_slices

#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 7
#: Of a hundred documents, how many are cut, and how many of these put the suffix first.
RATE, SUFFIX_FIRST = 100, 50

_TOP = 24
_HEIGHTS = np.random.Generator(np.random.Philox(13)).geometric(0.75, size=1 << 12).clip(1, _TOP)


def heights(n: int) -> np.ndarray:
    """Heights of the towers of n nodes: each further lane holds about a quarter of them."""
    number = np.arange(n, dtype=np.uint64)
    mixed = number * np.uint64(0x9E3779B97F4A7C15)
    return _HEIGHTS[(mixed ^ (mixed >> np.uint64(29))) >> np.uint64(52)]


class SkipList:
    """Nodes in order, each with a width in code points; on lane k, ``units[k][i]``
    and ``chars[k][i]`` are the widths of the link to the lane's node i + 1 and
    ``below[k][i]`` is the node's place on the lane below.  Place 0 is the head."""

    def __init__(self, widths: np.ndarray):
        n = len(widths)
        tall = np.append(_TOP + 1, heights(n))  # the head is on all lanes
        place = np.arange(n + 1)  # of the lane's nodes among all
        self.units, self.chars, self.below = [np.append(np.ones(n, np.int64), 0)], [np.append(widths, 0)], [place]
        while len(place) > 2:
            up = np.flatnonzero(tall[place] > len(self.units))
            if len(up) == len(place):
                break
            self.units.append(np.add.reduceat(self.units[-1], up))
            self.chars.append(np.add.reduceat(self.chars[-1], up))
            self.below.append(up)
            place = place[up]
        self.size = n

    def offset(self, rank: int) -> int:
        """Code points of the first ``rank`` nodes."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        units = chars = at = 0
        for lane in range(len(self.units) - 1, -1, -1):
            width, points = self.units[lane], self.chars[lane]
            while at < len(width) and width[at] and units + width[at] <= rank:
                units += int(width[at])
                chars += int(points[at])
                at += 1
            if lane:
                # a lane ends at its last node, whose link runs to the end of the list
                at = int(self.below[lane][at]) if at < len(width) else len(self.units[lane - 1])
        return chars


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, its line break included."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 10) + 1
    if text and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return np.diff(ends, prepend=0)


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[i:i + 8], 16) for i in (0, 8, 16, 24))


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """A mark found from the left must be one that was put there: marks may not overlap."""
    if len(set(sentinels)) != 3 or any(not s or s[0] in other[1:] for s in sentinels for other in sentinels):
        raise ValueError("sentinels must differ, and the first character of each must not occur further on in any")


def transform(docs: DataFrame, key: str = "doc_id", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
              sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` with fim_text, fim_form (plain, psm or spm), fim_n (lines),
    fim_prefix_chars and fim_middle_chars (null if plain) added."""
    check_sentinels(sentinels)
    p, s, m = sentinels

    def one(doc_id, text: str | None) -> tuple[str, str, int, int | None, int | None]:
        text = text or ""
        widths = line_widths(text)
        n = len(widths)
        h1, h2, h3, h4 = draws(doc_id, seed)
        if not text or any(mark in text for mark in sentinels) or h3 % 100 >= rate:
            return text, "plain", n, None, None
        lines = SkipList(widths)
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = lines.offset(first), lines.offset(second)
        if h4 % 100 < suffix_first:
            return "".join((s, text[b:], p, text[:a], m, text[a:b])), "spm", n, a, b - a
        return "".join((p, text[:a], s, text[b:], m, text[a:b])), "psm", n, a, b - a

    added = pa.schema([("fim_text", pa.string()), ("fim_form", pa.string()), ("fim_n", pa.int64()),
                       ("fim_prefix_chars", pa.int64()), ("fim_middle_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=1 << 20):
            rows = [one(i, t) for i, t in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist(), strict=True)]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), added, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added.names])

    fields = [StructField(f.name, LongType() if f.type == pa.int64() else StringType()) for f in added]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def restored(text: str = "fim_text", form: str = "fim_form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text a document was made from, by its output and form alone."""
    parts = F.split(F.col(text), "|".join(map(re.escape, sentinels)), -1)
    return (F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(F.col(text)))
