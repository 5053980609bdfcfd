"""Map/compare API operators: points (N6, L1), demographic summary (A1, N9),
compare (A2-A4), filter options (A8, L4) and coverage metadata (A9).

All of them start from the J1 join (or geodata alone for the option lists)
and are single declarative plans: filter -> (group) -> aggregate.  Partial
aggregation happens map-side, so a hot group never travels whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passante.functions.columns import dominant_label, gender_label, scalar_struct, try_double
from passante.operators.filters import GeoFilters, clamp_limit, valid_coordinates
from passante.plans.model import snowflake
from passante.schemas import (
    AGE_COLUMNS, AGE_FILTER_LABELS, CLASS_COLUMNS, CLASS_FILTER_LABELS, GENDER_COLUMNS,
    COLUMN_LABELS, SHARE_COLUMNS,
)
from passante.sources.testdata import Star


def _joined(star: Star | DataFrame) -> DataFrame:
    return snowflake(star) if isinstance(star, Star) else star


def point_rows(star: Star | DataFrame, filters: GeoFilters = GeoFilters()) -> DataFrame:
    """N6 without the limit: id, double coordinates, ``uniques`` as value,
    over filtered J1 rows whose coordinates parse."""
    j = filters.apply(_joined(star)).where(valid_coordinates())
    return j.select("id", try_double("latitude").alias("latitude"),
                    try_double("longitude").alias("longitude"), F.col("uniques").alias("value"))


def geo_points(star: Star | DataFrame, filters: GeoFilters = GeoFilters(),
               limit: int | None = None) -> DataFrame:
    """N6 + L1: the point query, limit clamped to (0, 10000] with default
    5000.  The reference's LIMIT has no ORDER BY; we order by ``id`` so the
    result is deterministic (planned as TakeOrderedAndProject, a bounded
    per-partition top-k followed by a merge of at most limit x partitions)."""
    n = clamp_limit(filters.limit if limit is None else limit)
    return point_rows(star, filters).orderBy("id").limit(n)


def _avg_columns(round_to: int | None):
    out = []
    for c in SHARE_COLUMNS:
        e = F.avg(c)
        out.append((F.round(e, round_to) if round_to is not None else e).alias(c))
    return out


def demographics(star: Star | DataFrame, filters: GeoFilters = GeoFilters(),
                 round_to: int | None = None) -> DataFrame:
    """A1: one row, COUNT(*) and the 16 unweighted averages.  On zero rows the
    averages are NULL and the count is 0."""
    j = filters.apply(_joined(star))
    return j.agg(F.count(F.lit(1)).alias("count"), *_avg_columns(round_to))


GROUP_BY_MODES = ("genero", "faixa_etaria", "classe_social")


def group_label(group_by: str):
    """A3/A4: the CASE label of a compare mode; unknown mode is an error."""
    if group_by == "genero":
        return gender_label()
    if group_by == "faixa_etaria":
        return dominant_label(AGE_COLUMNS, AGE_FILTER_LABELS)
    if group_by == "classe_social":
        return dominant_label(CLASS_COLUMNS, CLASS_FILTER_LABELS)
    raise ValueError(f"invalid group_by value: {group_by}")


def compare(star: Star | DataFrame, group_by: str, filters: GeoFilters = GeoFilters(),
            round_to: int | None = None) -> DataFrame:
    """A2: A1 per label, ordered by label."""
    label = group_label(group_by)
    j = filters.apply(_joined(star)).withColumn("label", label)
    return (j.groupBy("label")
            .agg(F.count(F.lit(1)).alias("count"), *_avg_columns(round_to))
            .orderBy("label"))


def nested_summary(df: DataFrame) -> DataFrame:
    """Reshape an A1/A2 row into count + nested age/gender/class structs."""
    keep = [c for c in df.columns if c not in SHARE_COLUMNS and c != "count"]
    return df.select(
        *keep,
        F.col("count"),
        F.struct(*[F.col(c) for c in AGE_COLUMNS]).alias("age"),
        F.struct(*[F.col(c) for c in GENDER_COLUMNS]).alias("gender"),
        F.struct(*[F.col(c) for c in CLASS_COLUMNS]).alias("social_class"),
    )


def distinct_values(geodata: DataFrame, column: str, where=None) -> DataFrame:
    """L4: ordered distinct non-NULL values of one column of geodata."""
    df = geodata if where is None else geodata.where(where)
    return (df.select(column).where(F.col(column).isNotNull())
            .distinct().orderBy(column))


def filter_options(geodata: DataFrame, filters: GeoFilters = GeoFilters()) -> dict[str, DataFrame]:
    """States; cities given the chosen states; addresses given the chosen
    cities (not states) -- three small distinct plans over geodata."""
    states = distinct_values(geodata, "uf_estado")
    city_cond = None
    if filters.uf_estado:
        v = list(filters.uf_estado)
        city_cond = F.col("uf_estado") == v[0] if len(v) == 1 else F.col("uf_estado").isin(v)
    cities = distinct_values(geodata, "cidade", city_cond)
    addr_cond = None
    if filters.cidade:
        v = list(filters.cidade)
        addr_cond = F.col("cidade") == v[0] if len(v) == 1 else F.col("cidade").isin(v)
    addresses = distinct_values(geodata, "endereco", addr_cond)
    return {"estados": states, "cidades": cities, "enderecos": addresses}


def demographic_options(star: Star) -> dict[str, list[str]]:
    """A8 static part: the bucket columns other than ``id``, relabelled.
    Read from the table schemas (metadata only, no data is scanned)."""
    return {
        "horarios": [f"{h:02d}" for h in range(24)],
        "faixas_etarias": [COLUMN_LABELS.get(c, c) for c in star.age.columns if c != "id"],
        "generos": [COLUMN_LABELS.get(c, c) for c in star.gender.columns if c != "id"],
        "classes_sociais": [COLUMN_LABELS.get(c, c) for c in star.social_class.columns if c != "id"],
    }


def coverage_metadata(enriched_df: DataFrame, max_cities: int = 500) -> DataFrame:
    """COUNT(DISTINCT location_id) and the first ``max_cities`` distinct
    cities in order (the 500 cap is the reference's feature).

    Cities are de-duplicated by a shuffle, cut to the first N with a bounded
    top-k, and only those N strings are folded into one row.
    """
    total = enriched_df.agg(F.countDistinct("location_id").alias("total_points"))
    first = (enriched_df.select("cidade").where(F.col("cidade").isNotNull()).distinct()
             .orderBy("cidade").limit(max_cities))
    cities = scalar_struct(first.agg(F.count(F.lit(1)).alias("n_cities"),
                                     F.array_join(F.sort_array(F.collect_list("cidade")), "|").alias("cities")))
    return (total.withColumn("__c", cities)
            .select("total_points", F.col("__c.n_cities").alias("n_cities"), F.col("__c.cities").alias("cities")))
