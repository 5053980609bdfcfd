import random

import pytest
from pyspark.sql import functions as F

from passante.operators import places


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def fold(t):
    import unicodedata
    return " ".join("".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn").split())


def search(spark, queries, names):
    asked = spark.createDataFrame([(q,) for q in queries], "query string")
    known = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, place bigint")
    return sorted((r.query, r.distance, r.name, r.place) for r in places.find_places(asked, known).collect())


def plain(queries, names):
    out = []
    for q in {q for q in queries if q and fold(q)}:
        for k, n in enumerate(names):
            if n and fold(n) and (d := distance(fold(q), fold(n))) <= min(2, len(fold(q)) // 4):
                out.append((q, d, n, k))
    return sorted(out)


def test_accents_case_and_misspellings(spark):
    names = ["São Paulo", "Avenida Brigadeiro Faria Lima", "Rua Augusta", "Santo André", "Sé", "Praça da Sé", "Itú", "São Paulo"]
    queries = ["sao paulo", "SÃO PAOLO", "avenida brigadero farialima", "augusta", "rua agusta", "santo  andre", "se", "so", "praca da se", "itu", "", None, "São Paulo"]
    found = search(spark, queries, names)
    assert found == plain(queries, names)
    assert {q for q, *_ in found} == {"sao paulo", "SÃO PAOLO", "avenida brigadero farialima", "rua agusta", "santo  andre", "se", "praca da se", "itu", "São Paulo"}


def test_equals_all_pairs_of_random_names(spark):
    rnd = random.Random(2)

    def name():
        return "".join(rnd.choice("ab ") if rnd.random() < 0.5 else rnd.choice("abcé") for _ in range(rnd.randrange(1, 14)))

    names = [name() for _ in range(250)] + ["aaaaaaaaaa", "aaaaaaaa", "abababab", "babababa", None, "", " "]

    def spoil(n):
        for _ in range(rnd.randrange(3)):
            k = rnd.randrange(len(n) + 1)
            n = rnd.choice([n[:k] + n[k + 1:], n[:k] + rnd.choice("abcx") + n[k:], n[:k] + "b" + n[k + 1:]])
        return n

    queries = [spoil(n) for n in names if n] + ["aaaaaaaaa", "abababa"]
    assert search(spark, queries, names) == plain(queries, names)


def test_candidates_come_from_an_equi_join(spark):
    names = spark.createDataFrame([(f"rua {k}",) for k in range(50)], "name string")
    plan = places.find_places(names.select(F.col("name").alias("query")), names)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("empty", ["queries", "names"])
def test_empty_sides(spark, empty):
    assert search(spark, [] if empty == "queries" else ["rua"], [] if empty == "names" else ["rua"]) == []


def test_candidates_of_numbered_names_grow_with_the_names(spark):
    """Numbered names share nearly all pairs of letters; their pairs are not candidates."""
    def count(n):
        names = spark.range(n).select(F.format_string("customer#%09d", "id").alias("__text"))
        asked = names.select(F.regexp_replace("__text", "#", "").alias("text"))
        return places.candidates(asked, names).count()

    assert count(4000) < 6 * count(1000)


@pytest.mark.parametrize("text", ["", "a", "ab", "aab", "abcde"])
def test_texts_with_letters_removed(spark, text):
    import itertools
    for k in range(3):
        found = spark.createDataFrame([(text, k)], "t string, k int").select(places.without(F.col("t"), F.col("k"))).first()[0]
        assert sorted(found) == sorted({"".join(c) for c in itertools.combinations(text, len(text) - k)} if len(text) >= k else set())
