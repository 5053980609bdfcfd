"""Dashboard operators over the enriched view: joint distribution (R2),
unpivots (R1, U1), KPIs (A10-A12), compositions (A13, A14), generic
group-by (A15), area comparison (A16), result facets (A17), address label
(N7).

Every operator is a projection / generate followed by a grouped
aggregation, so map-side partial aggregation bounds what each hot group
sends through the shuffle.  Label filters are applied to the generated
array *before* it is exploded (the ×96 table never materialises rows the
caller will throw away).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passante.functions.columns import address_label, bbox_predicate, dominant_label, gender_label, haversine_m, scalar_struct
from passante.schemas import (
    AGE_COLUMNS, AGE_COUNT_COLUMNS, AGE_FILTER_LABELS, CLASS_COLUMNS, CLASS_COUNT_COLUMNS,
    CLASS_FILTER_LABELS, GENDER_COLUMNS, GENDER_COUNT_COLUMNS, JOINT_AGE_LABELS, JOINT_CLASS_LABELS,
    JOINT_GENDER_LABELS,
)

JOINT_CLASS_COL = dict(zip(JOINT_CLASS_LABELS, CLASS_COLUMNS))
JOINT_GENDER_COL = dict(zip(JOINT_GENDER_LABELS, GENDER_COLUMNS))
JOINT_AGE_COL = dict(zip(JOINT_AGE_LABELS, AGE_COLUMNS))

GEO_KEEP = ["id", "impression_hour", "location_id", "uniques", "latitude", "longitude",
            "uf_estado", "cidade", "endereco", "numero"]


def _pick(all_labels: list[str], wanted) -> list[str]:
    if not wanted:
        return list(all_labels)
    w = set(wanted)
    return [x for x in all_labels if x in w]


def joint_distribution(df: DataFrame, classes=None, genders=None, ages=None,
                       keep: list[str] | None = None) -> DataFrame:
    """R2: one row per (event, class, gender, age) combination with
    ``joint_count = uniques * P(class) * P(gender) * P(age)`` (96 per event
    when unfiltered).  Σ joint_count over the 96 rows equals ``uniques``
    only when each dimension's shares sum to 1 -- shares are never
    renormalised."""
    keep = [c for c in (keep or GEO_KEEP) if c in df.columns]
    combos = []
    for c in _pick(JOINT_CLASS_LABELS, classes):
        for g in _pick(JOINT_GENDER_LABELS, genders):
            for a in _pick(JOINT_AGE_LABELS, ages):
                jc = F.col("uniques") * F.col(JOINT_CLASS_COL[c]) * F.col(JOINT_GENDER_COL[g]) * F.col(JOINT_AGE_COL[a])
                combos.append(F.struct(F.lit(c).alias("class_label"), F.lit(g).alias("gender_label"),
                                       F.lit(a).alias("age_label"), jc.alias("joint_count")))
    if not combos:
        raise ValueError("label filters leave no combination")
    return df.select(*keep, F.inline(F.array(*combos)))


def joint_counts(classes=None, genders=None, ages=None) -> Column:
    """An event's joint counts as an array: they can be summed within the row."""
    return F.array(*[F.col("uniques") * F.col(JOINT_CLASS_COL[c]) * F.col(JOINT_GENDER_COL[g]) * F.col(JOINT_AGE_COL[a])
                     for c in _pick(JOINT_CLASS_LABELS, classes) for g in _pick(JOINT_GENDER_LABELS, genders)
                     for a in _pick(JOINT_AGE_LABELS, ages)])


def joint_aggregate(df: DataFrame, keys: list[str] | None = None, classes=None, genders=None,
                    ages=None) -> DataFrame:
    """Σ joint_count per (keys, class, gender, age) without materialising the
    ×96 rows.  Each event is expanded only over the (class, gender) pairs
    (12 at most) carrying ``uniques * P(class) * P(gender)``; one grouped
    aggregation then keeps one accumulator per age band (map-side partial
    sums), and the few result rows are unpivoted over the age bands.  Same
    products, in the same order, as ``joint_distribution``."""
    keys = list(keys or [])
    cg = [(c, g) for c in _pick(JOINT_CLASS_LABELS, classes) for g in _pick(JOINT_GENDER_LABELS, genders)]
    age_labels = _pick(JOINT_AGE_LABELS, ages)
    if not cg or not age_labels:
        raise ValueError("label filters leave no combination")
    pairs = F.array(*[F.struct(F.lit(c).alias("class_label"), F.lit(g).alias("gender_label"),
                               (F.col("uniques") * F.col(JOINT_CLASS_COL[c]) * F.col(JOINT_GENDER_COL[g])).alias("w"))
                      for c, g in cg])
    x = df.select(*keys, *[F.col(JOINT_AGE_COL[a]).alias(f"__a{i}") for i, a in enumerate(age_labels)],
                  F.inline(pairs))
    g = x.groupBy(*keys, "class_label", "gender_label").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(F.col("w") * F.col(f"__a{i}")).alias(f"__j{i}") for i in range(len(age_labels))])
    arr = F.array(*[F.struct(F.lit(a).alias("age_label"), F.col(f"__j{i}").alias("joint_count"))
                    for i, a in enumerate(age_labels)])
    return g.select(*keys, "class_label", "gender_label", F.inline(arr), F.col("__n").alias("n_rows"))


# --- fixed values: long-form dimension names and labels ---
LONG_FORM = (
    [("class", lab, col) for lab, col in zip(JOINT_CLASS_LABELS, CLASS_COUNT_COLUMNS)]
    + [("gender", lab, col) for lab, col in zip(JOINT_GENDER_LABELS, GENDER_COUNT_COLUMNS)]
    + [("age", lab, col) for lab, col in zip(JOINT_AGE_LABELS, AGE_COUNT_COLUMNS)]
)


def unpivot_dimension(df: DataFrame, dimension: str = "class", ids: list[str] | None = None) -> DataFrame:
    """One dimension's counts as rows ``(tipo, valor)``."""
    ids = [c for c in (ids or GEO_KEEP) if c in df.columns]
    pairs = [(lab, col) for dim, lab, col in LONG_FORM if dim == dimension]
    renamed = df.select(*ids, *[F.col(col).alias(lab) for lab, col in pairs])
    return renamed.unpivot(ids, [lab for lab, _ in pairs], "tipo", "valor")


def long_form(df: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """Class, gender and age rows stacked as ``(tipo, label, valor)``.
    Each event appears in all three dimensions -- never sum across tipo."""
    ids = [c for c in (ids or GEO_KEEP) if c in df.columns]
    arr = F.array(*[F.struct(F.lit(dim).alias("tipo"), F.lit(lab).alias("label"), F.col(col).alias("valor"))
                    for dim, lab, col in LONG_FORM])
    return df.select(*ids, F.inline(arr))


# ------------------------------------------------------------------ KPIs


def flow_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("uniques").alias("flow"))


def peak_hour(df: DataFrame) -> DataFrame:
    """A10: hour with the largest Σuniques, lowest hour on ties."""
    return (flow_by(df, "impression_hour")
            .orderBy(F.col("flow").desc(), F.col("impression_hour").asc()).limit(1))


def top_address(df: DataFrame) -> DataFrame:
    """Address with the largest Σuniques (ties: address ascending)."""
    return (flow_by(df.where(F.col("endereco").isNotNull()), "endereco")
            .orderBy(F.col("flow").desc(), F.col("endereco").asc()).limit(1))


def people_per_day(records: DataFrame, ts: str = "kafka_timestamp") -> DataFrame:
    """Σuniques per UTC day of the record time (the archive's day folder)."""
    return records.groupBy(F.to_date(F.col(ts)).alias("day")).agg(F.sum("uniques").alias("flow"))


def avg_people_per_day(records: DataFrame, ts: str = "kafka_timestamp") -> DataFrame:
    """Mean over days of Σuniques per day."""
    return people_per_day(records, ts).agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("flow").alias("total_flow"),
        F.avg("flow").alias("avg_per_day"))


def composition(df: DataFrame, dimension: str = "class") -> DataFrame:
    """Σcount per label and its share of the dimension's total.  The
    total is taken over the (few) aggregated label rows only."""
    pairs = [(lab, col) for dim, lab, col in LONG_FORM if dim == dimension]
    sums = df.agg(*[F.sum(col).alias(lab) for lab, col in pairs])
    rows = sums.unpivot([], [lab for lab, _ in pairs], "label", "value")
    tot = scalar_struct(sums.select(
        sum((F.coalesce(F.col(f"`{lab}`"), F.lit(0.0)) for lab, _ in pairs), F.lit(0.0)).alias("total")))
    j = rows.withColumn("total", tot["total"])  # one-row total, no join
    return j.select("label", "value", (F.col("value") / F.when(F.col("total") != 0, F.col("total"))).alias("share"))


def gender_by_hour(df: DataFrame) -> DataFrame:
    """Σfeminine_count and Σmasculine_count per hour, long form."""
    g = df.groupBy("impression_hour").agg(F.sum("feminine_count").alias("Feminine"),
                                          F.sum("masculine_count").alias("Masculine"))
    return g.unpivot(["impression_hour"], ["Feminine", "Masculine"], "gender_label", "value")


def people_by_hour(df: DataFrame) -> DataFrame:
    """Σuniques per hour."""
    return flow_by(df, "impression_hour")


def group_measures(df: DataFrame, dims: list[str], measure: str = "uniques",
                   exact_scale: int | None = None) -> DataFrame:
    """Group by any columns; sum, mean and peak of a measure.

    With ``exact_scale`` (the measure's decimal places) the mean is averaged
    as a decimal: exact, rounded half-up at ``exact_scale + 4`` places, and
    independent of summation order."""
    mean = (F.avg(F.col(measure).cast(f"decimal(30,{exact_scale})")).cast("double")
            if exact_scale is not None else F.avg(measure))
    return df.groupBy(*dims).agg(F.sum(measure).alias("sum"), mean.alias("mean"),
                                 F.max(measure).alias("peak"), F.count(F.lit(1)).alias("n"))


def area_compare(df: DataFrame, area_a: tuple[float, float, float], area_b: tuple[float, float, float],
                 dimension: str = "class") -> DataFrame:
    """Per label of a dimension, its share of flow inside area A and
    inside area B (centre lat, centre lon, radius m) and the percentage
    difference (b - a) / a * 100.  A point inside both areas counts in
    both; the area tag is generated, not joined.  The areas' bounding boxes are
    plain comparisons, so the reader skips what lies outside both."""
    def box(a):
        return bbox_predicate("latitude", "longitude", *a)

    def inside(a):
        lat, lon, r = a
        return box(a) & (haversine_m("latitude", "longitude", lat, lon) <= F.lit(float(r)))
    tags = F.array(F.when(inside(area_a), F.lit("A")), F.when(inside(area_b), F.lit("B")))
    pairs = [(lab, col) for dim, lab, col in LONG_FORM if dim == dimension]
    tagged = (df.where(box(area_a) | box(area_b))
              .select("uniques", *[c for _, c in pairs],
                      F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("area")))
    sums = tagged.groupBy("area").agg(F.sum("uniques").alias("flow"),
                                      *[F.sum(c).alias(lab) for lab, c in pairs])
    long = sums.unpivot(["area", "flow"], [lab for lab, _ in pairs], "label", "value")
    long = long.withColumn("share", F.col("value") / F.when(F.col("flow") != 0, F.col("flow")))
    wide = long.groupBy("label").pivot("area", ["A", "B"]).agg(F.first("share"))
    return wide.select("label", F.col("A").alias("share_a"), F.col("B").alias("share_b"),
                       ((F.col("B") - F.col("A")) / F.when(F.col("A") != 0, F.col("A")) * 100).alias("pct_diff"))


def result_facets(joined: DataFrame) -> DataFrame:
    """Which dominant age bands, classes, gender labels and streets
    occur in a result set, and how often."""
    facets = joined.select(
        dominant_label(AGE_COLUMNS, AGE_FILTER_LABELS).alias("faixa_etaria"),
        dominant_label(CLASS_COLUMNS, CLASS_FILTER_LABELS).alias("classe_social"),
        gender_label().alias("genero"), F.col("endereco"))
    long = facets.unpivot([], ["faixa_etaria", "classe_social", "genero", "endereco"], "facet", "value")
    return long.where(F.col("value").isNotNull()).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def address_labels(df: DataFrame) -> DataFrame:
    """Location -> ``trim(endereco), numero — cidade``."""
    return df.select("location_id", address_label().alias("endereco_ref")).distinct()

