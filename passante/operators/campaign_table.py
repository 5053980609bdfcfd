"""W2 and Q4 for campaigns that come as a table: the plan does not depend on their number.

A campaign meets the places it can apply to by an equi-join, by what it says of a place:

* a point and a radius: both sides are put into the cells of a grid as coarse as the
  radius (edges are powers of two, a place lies in one cell of each that occurs, at most
  some 25), the campaign into its cell and the 26 around it; the distance decides;
* else a city: the city's name;
* neither: all places.  Such campaigns differ only in what they select and in the street;
  each different selection is ranked once, whatever the number of campaigns that make it.

Places are rolled up before, so events do not meet campaigns.  A campaign that names a
city without data is, with ``city_fallback``, taken without the city and flagged.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passante.functions.columns import address_label, haversine_m
from passante.functions.topk import top_k_per_group
from passante.operators.campaign import (
    DEFAULT_RADIUS_KM, DEFAULT_TOP_K, GROUP_KEYS, PRE_KEYS, SELECTABLE, CampaignSpec, _ratios, location_rollup, rank_order,
)
from passante.schemas import EARTH_RADIUS_M

SPEC_SCHEMA = ("campaign_id string, gender string, age_min int, age_max int, classes array<string>, city string, endereco string, "
               "latitude double, longitude double, radius_km double, limit int")


def spec_row(spec: CampaignSpec) -> tuple:
    return (spec.campaign_id, spec.gender, spec.age_min, spec.age_max, list(spec.classes) if spec.classes else None, spec.city,
            spec.endereco, spec.latitude, spec.longitude, spec.radius_km, spec.limit)


def _chosen() -> Column:
    """Per count column, in the order of ``SELECTABLE``: does the campaign select it?"""
    codes = F.transform(F.coalesce("classes", F.array().cast("array<string>")), lambda c: F.upper(c))
    said = {"gender": lambda code: F.upper("gender") == code, "class": lambda code: F.array_contains(codes, F.lit(code))}
    marks = [said[dimension](code) if code else F.greatest("age_min", F.lit(low)) <= F.least("age_max", F.lit(high))
             for dimension, code, low, high, _ in SELECTABLE]
    # least and greatest pass over nulls: both ages are needed
    both = F.col("age_min").isNotNull() & F.col("age_max").isNotNull()
    return F.array(*[F.coalesce(m if code else m & both, F.lit(False)) for m, (_, code, *_) in zip(marks, SELECTABLE, strict=True)])


def prepared(specs: DataFrame, cities: DataFrame, city_fallback: bool) -> DataFrame:
    """campaign_id, chosen, street, city (null: any), city_found, point, radius, k."""
    named = specs.select(
        "campaign_id", _chosen().alias("chosen"), F.lower(F.nullif("endereco", F.lit(""))).alias("street"),
        F.lower(F.nullif("city", F.lit(""))).alias("city"), F.col("latitude").alias("spec_lat"), F.col("longitude").alias("spec_lon"),
        (F.coalesce(F.nullif("radius_km", F.lit(0.0)), F.lit(DEFAULT_RADIUS_KM)) * 1000.0).alias("radius"),
        F.coalesce(F.nullif("limit", F.lit(0)), F.lit(DEFAULT_TOP_K)).alias("k"))
    if not city_fallback:
        return named.withColumn("city_found", F.lit(None).cast("boolean"))
    known = cities.select(F.lower("cidade").alias("city"), F.lit(True).alias("known")).distinct()
    found = named.join(known, "city", "left").withColumn("city_found", F.col("city").isNull() | F.coalesce("known", F.lit(False)))
    return found.withColumn("city", F.when(F.col("city_found"), F.col("city"))).drop("known")


def _cells(lat: Column, lon: Column, level: Column) -> Column:
    la, lo, edge = F.radians(lat), F.radians(lon), F.pow(F.lit(2.0), level)
    axes = [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]
    return F.struct(*[F.floor(F.lit(EARTH_RADIUS_M) * a / edge).cast("bigint").alias(n) for a, n in zip(axes, "xyz")])


def near(specs: DataFrame, places: DataFrame) -> DataFrame:
    """Campaigns with a point and the places within their radius (and in their city)."""
    placed = (specs.where("spec_lat is not null and spec_lon is not null")
              .withColumn("level", F.greatest(F.ceil(F.log2("radius")), F.lit(0)).cast("int")))
    levels = placed.agg(F.array_sort(F.collect_set("level")).alias("levels"))  # powers of two up to the earth's size
    steps = F.array(*[F.struct(*[F.lit(d).alias(n) for d, n in zip(step, "xyz")])
                      for step in ((i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1))])
    cell = _cells(F.col("spec_lat"), F.col("spec_lon"), F.col("level"))
    around = (placed.withColumn("c", cell).withColumn("d", F.explode(steps))
              .select(*placed.columns, *[(F.col(f"c.{n}") + F.col(f"d.{n}")).alias(f"cell_{n}") for n in "xyz"]))
    valid = places.where(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))
    gridded = (valid.withColumn("level", F.explode(levels.scalar())).withColumn("c", _cells(F.col("latitude"), F.col("longitude"), F.col("level")))
               .select(*places.columns, "level", *[F.col(f"c.{n}").alias(f"cell_{n}") for n in "xyz"]))
    met = around.join(gridded, ["level", "cell_x", "cell_y", "cell_z"])
    distance = haversine_m(F.col("latitude"), F.col("longitude"), F.col("spec_lat"), F.col("spec_lon"))
    return met.where((distance <= F.col("radius")) & (F.col("city").isNull() | (F.lower("cidade") == F.col("city"))))


def _scored(met: DataFrame, keys: list[str]) -> DataFrame:
    """Affinity of every place for what the rows' ``chosen`` selects, on its street."""
    on_street = F.col("street").isNull() | F.expr("lower(endereco) like concat('%', street, '%')")

    def total(dimension: str) -> Column:
        mine = [(k, column) for k, (d, *_, column) in enumerate(SELECTABLE) if d == dimension]
        some = functools.reduce(operator.or_, [F.col("chosen")[k] for k, _ in mine])
        counts = functools.reduce(operator.add, [F.when(F.col("chosen")[k], F.col(column)).otherwise(0.0) for k, column in mine])
        return F.when(some, counts).otherwise(F.col("uniques"))

    agg = (met.where(on_street).groupBy(*keys, *GROUP_KEYS)
           .agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"), F.sum("uniques").alias("total_flow"),
                F.sum(total("gender")).alias("_g"), F.sum(total("age")).alias("_a"), F.sum(total("class")).alias("_c")))
    affinity, target = _ratios(F.col("total_flow"), F.col("_g"), F.col("_a"), F.col("_c"))
    return agg.select(*keys, "location_id", address_label().alias("endereco_ref"), "cidade", "latitude", "longitude",
                      "total_flow", affinity.alias("affinity"), target.alias("target_audience"))


def rank_campaigns(enriched_df: DataFrame, specs: DataFrame, city_fallback: bool = True) -> DataFrame:
    """The rows of ``campaign.multi_campaign``, for campaigns in a table of ``SPEC_SCHEMA``."""
    places = location_rollup(enriched_df)
    wanted = prepared(specs, enriched_df.select("cidade"), city_fallback)
    most = wanted.agg(F.max("k")).first()[0] or 1
    pointed = F.col("spec_lat").isNotNull() & F.col("spec_lon").isNotNull()
    keys = ["campaign_id", "city_found", "k"]
    of_place = [c for c in places.columns if c in PRE_KEYS or c == "uniques" or c in {s[-1] for s in SELECTABLE}]
    columns = [*keys, "chosen", "street", *of_place]
    in_city = (wanted.where(~pointed & F.col("city").isNotNull())
               .join(places.withColumn("__city", F.lower("cidade")), F.col("city") == F.col("__city")))
    met = near(wanted, places).select(*columns).unionByName(in_city.select(*columns))
    mine = top_k_per_group(_scored(met, keys), ["campaign_id"], rank_order(), most, salt_cols=["location_id", "endereco_ref"])

    anywhere = wanted.where(~pointed & F.col("city").isNull())
    selections = anywhere.select(F.struct("chosen", "street").alias("selection")).distinct().agg(F.collect_list("selection").alias("all"))
    each = places.withColumn("selection", F.explode(selections.scalar())).select("selection", "selection.chosen", "selection.street", *of_place)
    shared = top_k_per_group(_scored(each, ["selection"]), ["selection"], rank_order(), most, salt_cols=["location_id", "endereco_ref"])
    theirs = anywhere.select(*keys, F.struct("chosen", "street").alias("wish"))
    shared = shared.join(theirs, F.col("selection").eqNullSafe(F.col("wish"))).select(*mine.columns)
    return mine.unionByName(shared).where("rank <= k").drop("k")
