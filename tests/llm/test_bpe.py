import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from passante.llm import bpe
from tests.llm.helpers import docs, odd_rows, words

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_automaton_holds_its_words_and_no_others(tmp_path, vocabulary):
    entries = {w: vocabulary.merge(w) for w in words(1, 3000).split() + ["a", "ab", "abc", "straße", "日本", "reading", "riding", "a" * 300]}
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compile_lexicon(entries.items()))
    lexicon = bpe.Lexicon(str(path))
    assert all(lexicon.get(w) == ids for w, ids in entries.items())
    assert [lexicon.get(w) for w in ("", "w", "abcd", "zz", "readin", "日")] == [None] * 6


def test_states_are_minimal(vocabulary, tmp_path):
    # two words with one suffix share its states: root, 2 branches, n-g end
    data = bpe.compile_lexicon([("xing", [1]), ("ying", [2])])
    assert struct.unpack_from("<5I", data)[1] == 5


def test_encoder_equals_the_library(vocabulary, library):
    rnd = random.Random(2)
    pool = [chr(i) for i in range(1, 0x250)] + list("  \n'sabcdefgh0123ΣσςİéÀ日本 \x85\x1ć") + ["<|endoftext|>", "<|startoftext|>", "'LL", "'re "]
    encoder = bpe.Encoder(vocabulary, None)
    for _ in range(3000):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert packed == struct.pack(f"<{len(ids)}I", *ids)
        assert encoder.decode(packed) == library.decode(ids, skip_special_tokens=False)
    long = "ab" * 5000  # one word, merged with the heap
    assert list(memoryview(encoder.encode(long)).cast("I")) == library.encode(long, add_special_tokens=False).ids


def test_whole_table(spark, library):
    rows = odd_rows() + [(20, "The <|endoftext|> end's <|startoftext|>", "z")]
    got = bpe.decode(bpe.encode(docs(spark, rows), PATH), PATH).collect()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, bytes(r.token_ids), r.decoded) for r in got), key=key) == sorted(want, key=key)
    at_once = bpe.encode(docs(spark, rows), PATH, decoded=True).collect()
    assert sorted(((r.doc_id, bytes(r.token_ids), r.decoded) for r in at_once), key=key) == sorted(want, key=key)
    assert bpe.digests(bpe.decode(bpe.encode(docs(spark, []), PATH), PATH)).count() == 0
    assert bpe.digests(bpe.encode(docs(spark, []), PATH, decoded=True)).count() == 0


def test_a_small_memory_of_words_changes_nothing(vocabulary):
    small, large = bpe.Encoder(vocabulary, None), bpe.Encoder(vocabulary, None)
    small.REMEMBERED = 2000
    for k in range(60):
        text = " ".join("abcdefghij"[(k * i) % 10] + "klmnopqrst"[i % 10] * (i % 7) for i in range(40))
        assert small.encode(text) == large.encode(text)
    assert len(small.packed) + len(small.older) < len(large.packed)


def test_lexicon_bound_keeps_the_most_frequent(spark, vocabulary, tmp_path):
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.build_lexicon(docs(spark, [(1, "a a a b b c"), (2, "a d")]), vocabulary, lexicon_size=3))
    lexicon = bpe.Lexicon(str(path))
    assert [lexicon.get(w) is not None for w in "abcd"] == [True, True, False, False]
