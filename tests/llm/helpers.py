"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random

# further columns, named like columns the operators work with
EXTRA = "node string, label string, size bigint, good boolean, digest string, key string, rate double"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"


def docs(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", None, 7, None, "d", "k", 0.5) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(seed: int, n: int, kinds: int = 4000) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(kinds)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = words(5, 20_000)
    return [(None, None, None), (None, "", None), (1, None, "a"), (2, "", "a"), (3, "   \n\t", "a"), (4, "x", None), (5, long, "b"), (6, long, "b"),
            (7, words(7, 40), "b"), (7, words(7, 40), "b"), (8, "é" * 3000, "c"), (None, words(7, 40), "c"), (9, "und " * 500, "c"), (10, "\x00 a\x00b", "c")]
