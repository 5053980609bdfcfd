"""Segment comparison grid (A5) and shared density domain.

The dashboard runs one point query per segment value (each overriding the
same-dimension filter) and caps every card at 2000 points.  Here all
segments come from one scan: each joined row carries the array of segment
values it satisfies (segments overlap, thresholds are independent), the
array is exploded, and the per-segment cap is a salted two-stage top-k, so
a segment that holds most rows is ranked by many tasks.  The density domain
is a statistic of all points, not of those that a card shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passante.functions.columns import try_double
from passante.functions.topk import top_k_per_group
from passante.operators.filters import GeoFilters, valid_coordinates
from passante.operators.geo import density_domain, hexbin
from passante.schemas import AGE_FILTER_LABELS, CLASS_FILTER_LABELS, GENDER_FILTER_LABELS

MODE_FIELD = {"gender": "genero", "age": "faixa_etaria", "socialClass": "classe_social"}
# --- fixed values: default compare values per mode ---
DEFAULT_VALUES = {
    "gender": GENDER_FILTER_LABELS,
    "age": AGE_FILTER_LABELS,
    "socialClass": CLASS_FILTER_LABELS,
}
CARD_LIMIT = 2000


# --- fixed value: segments a mode shows at most ---
MOST_SEGMENTS = {"gender": 2}


def compare_values(mode: str, selected: list[str] | None = None) -> list[str]:
    """The distinct values asked for, or the mode's own."""
    asked = dict.fromkeys(map(str.strip, selected or DEFAULT_VALUES[mode]))
    asked.pop("", None)
    return list(asked)[:MOST_SEGMENTS.get(mode)]


def segment_rows(joined: DataFrame, mode: str, base: GeoFilters = GeoFilters(),
                 selected: list[str] | None = None) -> DataFrame:
    """(segment, id, latitude, longitude, value, location_id): every valid point
    once for each segment it belongs to."""
    field = MODE_FIELD[mode]
    df = base.with_(**{field: ()}).apply(joined).where(valid_coordinates())
    tags = []
    for v in compare_values(mode, selected):
        p = GeoFilters(**{field: (v,)}).predicate()
        # an unknown value imposes no condition, like a filter on its own
        tags.append(F.when(p if p is not None else F.lit(True), F.lit(v)))
    return (df.withColumn("segment", F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())))
            .select("segment", "id", try_double("latitude").alias("latitude"), try_double("longitude").alias("longitude"),
                    F.col("uniques").alias("value"), "location_id"))


def segment_points(joined: DataFrame, mode: str, base: GeoFilters = GeoFilters(),
                   selected: list[str] | None = None, limit: int = CARD_LIMIT) -> DataFrame:
    """A5: at most ``limit`` points per segment, first by id (the card's limit)."""
    return top_k_per_group(segment_rows(joined, mode, base, selected), ["segment"], [F.col("id")], limit, salt_cols=["id"]).drop("rank")


def segment_hexbins(points: DataFrame, radius_m: float) -> DataFrame:
    return hexbin(points, radius_m, group_cols=["segment"])


def shared_domain(bins: DataFrame) -> DataFrame:
    """A6 (over the bins of :func:`segment_rows`): per-segment domains, then min of mins / max of maxes (valid ones)."""
    per = density_domain(bins, ["segment"])
    ok = per.where(F.col("domain_max") >= F.col("domain_min"))
    return ok.agg(F.min("domain_min").alias("domain_min"), F.max("domain_max").alias("domain_max"),
                  F.count(F.lit(1)).alias("n_segments"))
