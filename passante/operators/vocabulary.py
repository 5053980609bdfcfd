"""Brief vocabulary (J9): informal campaign terms in chat messages mapped
to campaign filters (age range, classes, gender, radius, result count).

The vocabulary is a fixed, small table, so it is compiled into column
expressions (one ``contains`` test per term) instead of being joined:
each message yields the array of terms it mentions, exploded into rows.
"Most specific wins" per field: the longest matching term decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: informal term -> filter field and value ---
VOCABULARY = [
    ("jovens", "age", "18-29"), ("público jovem", "age", "18-29"),
    ("adultos", "age", "30-59"), ("público adulto", "age", "30-59"),
    ("idosos", "age", "60-120"), ("terceira idade", "age", "60-120"), ("melhor idade", "age", "60-120"),
    ("universitários", "age", "18-25"), ("millennials", "age", "28-43"),
    ("geração z", "age", "18-28"), ("gen z", "age", "18-28"),
    ("classe alta", "classes", "A"), ("alto poder aquisitivo", "classes", "A"), ("premium", "classes", "A"),
    ("classe média-alta", "classes", "A,B1"), ("classe média", "classes", "B1,B2"),
    ("classe popular", "classes", "C1,C2"), ("massa", "classes", "C1,C2"),
    ("mulheres", "gender", "female"), ("feminino", "gender", "female"), ("público feminino", "gender", "female"),
    ("homens", "gender", "male"), ("masculino", "gender", "male"), ("público masculino", "gender", "male"),
    ("bem perto", "radius_km", "0.5"), ("ao lado", "radius_km", "0.5"), ("na porta", "radius_km", "0.5"),
    ("perto", "radius_km", "1.0"), ("próximo", "radius_km", "1.0"), ("nas redondezas", "radius_km", "1.0"),
    ("região", "radius_km", "3.0"), ("área de", "radius_km", "3.0"), ("arredores", "radius_km", "3.0"),
    ("o melhor ponto", "limit", "1"), ("o ponto ideal", "limit", "1"), ("top 1", "limit", "1"),
    ("top 3", "limit", "3"), ("os 3 melhores", "limit", "3"), ("top 5", "limit", "5"),
    ("os 5 melhores", "limit", "5"), ("meia dúzia", "limit", "5"), ("20 melhores", "limit", "20"),
    ("todos os pontos", "limit", "50"), ("lista completa", "limit", "50"),
]


def term_matches(messages: DataFrame, text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """One row per (message, matched term): keys + term, field, value."""
    keys = keys or [c for c in messages.columns if c != text]
    low = F.lower(F.col(text))
    hits = F.array(*[F.when(low.contains(t), F.struct(F.lit(t).alias("term"), F.lit(f).alias("field"),
                                                      F.lit(v).alias("value")))
                     for t, f, v in VOCABULARY])
    return messages.select(*keys, F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("m")) \
        .select(*keys, "m.term", "m.field", "m.value")


def brief_filters(messages: DataFrame, group: list[str], text: str = "text") -> DataFrame:
    """Per group (e.g. conversation): for each field, the value of the most
    specific (longest) term mentioned; ties go to the later text order."""
    m = term_matches(messages.select(*group, text), text, group)
    return (m.groupBy(*group, "field")
            .agg(F.max_by("value", F.struct(F.length("term"), F.col("term"))).alias("value"),
                 F.sort_array(F.collect_set("term")).alias("terms")))
