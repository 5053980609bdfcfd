"""Places found by free text, with misspellings and without accents.

Names and queries are folded (case, accents, white space).  A query of n letters may
be off by ``allowed(n)`` edits.  Names are found by an inverted table of their texts with
letters removed: a query of l letters and a name of l + k within d edits are the same text
once d - |k| letters, and -k more of the query or k more of the name, are removed from each.
Each pair of lengths thus asks for one number of removed letters on either side.  The
equi-join on the hashes of what is left gives the candidates, and the edit distance decides.
Names that share most of their letters (numbered ones) are told apart by it, so the
candidates grow with the names that lie about two edits away, not with the pairs of names.

Names are made distinct first, so events add nothing to the index.  Null and empty queries
and names find nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: accented letters of Portuguese and its neighbours, and what they fold to ---
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"
#: Letters per allowed edit, and edits at most.
LETTERS_PER_EDIT, MOST_EDITS = 4, 2


def folded(text: Column) -> Column:
    """Lower case, without accents (also combining ones), single spaces."""
    bare = F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def allowed(text: Column) -> Column:
    """Edits that a folded query may be off by: 0 below 4 letters, 1 below 8, else 2."""
    return F.least(F.lit(MOST_EDITS), F.floor(F.length(text) / LETTERS_PER_EDIT)).cast("int")


def without(text: Column, letters: Column) -> Column:
    """The different texts that are left when 0, 1 or 2 ``letters`` are removed from ``text``."""
    n = F.length(text)

    def cut(i: Column, j: Column) -> Column:
        return F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, j - i - 1), F.substr(text, j + 1))

    one = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))
    two = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(F.sequence(i + 1, n), lambda j: cut(i, j))))
    return F.array_distinct(F.when(letters == 0, F.array(text)).when((letters == 1) & (n >= 1), one).when((letters == 2) & (n >= 2), two)
                            .otherwise(F.array().cast("array<string>")))


def candidates(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(text, __text): pairs of a folded query of ``texts`` and a folded name of ``names``
    that may be close, each as often as they share a text with letters removed."""
    more = F.explode(F.sequence(-F.col("edits"), F.col("edits")))
    rest = F.col("edits") - F.abs("more")
    shapes = (texts.select(F.length("text").alias("letters"), allowed(F.col("text")).alias("edits")).distinct().select("letters", "edits", more.alias("more"))
              .select("letters", (F.col("letters") + F.col("more")).alias("name_letters"),
                      (rest + F.greatest(F.lit(0), -F.col("more"))).alias("cut"), (rest + F.greatest(F.lit(0), F.col("more"))).alias("name_cut")))
    # a row or some per length of a text that there is
    shapes = shapes.join(F.broadcast(names.select(F.length("__text").alias("name_letters")).distinct()), "name_letters")
    wanted = texts.withColumn("letters", F.length("text")).join(F.broadcast(shapes), "letters")
    wanted = wanted.select("text", "name_cut", F.explode(without(F.col("text"), F.col("cut"))).alias("left"))
    index = names.withColumn("name_letters", F.length("__text")).join(F.broadcast(shapes.select("name_letters", "name_cut").distinct()), "name_letters")
    index = index.select("__text", "name_cut", F.explode(without(F.col("__text"), F.col("name_cut"))).alias("left"))
    key = F.xxhash64("name_cut", "left").alias("key")
    return wanted.select("text", key).join(index.select("__text", key), "key").select("text", "__text")


def find_places(queries: DataFrame, places: DataFrame, query: str = "query", name: str = "name") -> DataFrame:
    """Every pair of a query and a place's name within the allowed edits: (``query``,
    distance, and the columns of ``places``)."""
    asked = queries.select(query).distinct().withColumn("text", folded(F.col(query))).where("text <> ''")
    known = places.withColumn("__text", folded(F.col(name))).where("__text <> ''")
    close = F.levenshtein("text", "__text", MOST_EDITS)  # -1 beyond
    matched = (candidates(asked.select("text").distinct(), known.select("__text").distinct()).withColumn("distance", close)
               .where((F.col("distance") >= 0) & (F.col("distance") <= allowed(F.col("text")))).distinct())
    return asked.join(matched, "text").join(known, "__text").select(query, "distance", *places.columns)
