"""Geospatial operators: radius join (J4), per-location profile (J5),
three-tier screen enrichment (J6), gazetteer lookup (J7), centre ranking (H5),
hex binning (H1) with density domain (H3) and colour classes (H4).

Radius join without a cartesian product
---------------------------------------
Both sides are mapped to 3-D points on a sphere of radius R and bucketed
into cubes whose edge equals the search radius d.  The chord between two
points is never longer than their great-circle distance, so every pair
within d lies in the same or an adjacent cube along each axis.  The (small)
probe side is replicated into its 27 neighbour cubes, the (large) build side
is not replicated at all, the sides are equi-joined on the cube key and the
exact haversine filter removes the rest.  The cube grid has no special cases
at the poles or the antimeridian.  A hot cube (a dense city centre) is a
skewed join key, which AQE's skew-join handling splits at run time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passante.functions.columns import haversine_m, scalar_struct
from passante.schemas import (
    COUNT_COLUMNS, EARTH_RADIUS_M, SCREEN_SHARE_COLUMNS, SHARE_COLUMNS, SHARE_TO_COUNT,
)
from passante.functions.ranking import ranked as rank_rows
from passante.functions.topk import top_k_per_group
from passante.session import scratch_path

# ----------------------------------------------------------------------------- J4


def _xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    R = F.lit(EARTH_RADIUS_M)
    return R * F.cos(la) * F.cos(lo), R * F.cos(la) * F.sin(lo), R * F.sin(la)


def _cells(lat: str, lon: str, size_m: float) -> list[Column]:
    return [F.floor(c / F.lit(size_m)).cast("bigint") for c in _xyz(F.col(lat), F.col(lon))]


def radius_join(probe: DataFrame, build: DataFrame, radius_m: float,
                probe_lat: str = "latitude", probe_lon: str = "longitude",
                build_lat: str = "latitude", build_lon: str = "longitude",
                distance_col: str = "distance_m") -> DataFrame:
    """All (probe, build) pairs with haversine distance <= ``radius_m``.

    Column names of the two sides must be disjoint.  Rows with NULL
    coordinates on either side never match.  ``probe`` is the side that gets
    replicated 27x -- pass the smaller one.
    """
    offs = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"), F.lit(k).alias("dz"))
                     for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    px, py, pz = _cells(probe_lat, probe_lon, radius_m)
    p = (probe.where(F.col(probe_lat).isNotNull() & F.col(probe_lon).isNotNull())
         .withColumns({"__px": px, "__py": py, "__pz": pz})
         .withColumn("__o", F.explode(offs))
         .withColumns({"__cx": F.col("__px") + F.col("__o.dx"), "__cy": F.col("__py") + F.col("__o.dy"),
                       "__cz": F.col("__pz") + F.col("__o.dz")})
         .drop("__px", "__py", "__pz", "__o"))
    bx, by, bz = _cells(build_lat, build_lon, radius_m)
    b = (build.where(F.col(build_lat).isNotNull() & F.col(build_lon).isNotNull())
         .withColumns({"__cx": bx, "__cy": by, "__cz": bz}))
    j = p.join(b, ["__cx", "__cy", "__cz"]).drop("__cx", "__cy", "__cz")
    d = haversine_m(F.col(probe_lat), F.col(probe_lon), F.col(build_lat), F.col(build_lon))
    return j.withColumn(distance_col, d).where(F.col(distance_col) <= F.lit(float(radius_m)))


# ----------------------------------------------------------------------------- J5


def location_sums(enriched_df: DataFrame) -> DataFrame:
    """Σuniques, Σ(share x uniques) and coordinates (min) per location."""
    aggs = [F.sum("uniques").alias("uniques"), F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude")]
    aggs += [F.sum(SHARE_TO_COUNT[c]).alias(SHARE_TO_COUNT[c]) for c in SHARE_COLUMNS]
    return enriched_df.groupBy("location_id").agg(*aggs)


def _shares_of(sums: DataFrame, keep: list[str]) -> DataFrame:
    denom = F.when(F.col("uniques") != 0, F.col("uniques"))
    return sums.select(*keep, *[(F.col(SHARE_TO_COUNT[c]) / denom).alias(c) for c in SHARE_COLUMNS])


def location_profile(enriched_df: DataFrame) -> DataFrame:
    """One row per location -- Σuniques and the 16 shares averaged with
    weight ``uniques`` (Σ share*uniques / Σuniques), coordinates via min."""
    return _shares_of(location_sums(enriched_df), ["location_id", "latitude", "longitude", "uniques"])


def global_profile(enriched_df: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Global weighted mean of the 16 shares (one row).  Given the per-location
    sums it is a second-level sum of those (the shuffle is shared)."""
    src = sums if sums is not None else enriched_df
    g = src.agg(F.sum("uniques").alias("uniques"), *[F.sum(c).alias(c) for c in COUNT_COLUMNS])
    return _shares_of(g, [])


# ----------------------------------------------------------------------------- J6


def enrich_screens(screens: DataFrame, enriched_df: DataFrame, radius_m: float = 500.0,
                   fallback_m: float = 5000.0) -> DataFrame:
    """Every screen gets 16 ``p_*`` shares and a match type.

    * exact: locations within ``radius_m`` weighted by ``uniques``;
    * fallback: otherwise locations within ``fallback_m`` weighted by
      ``uniques / distance`` (all distances exceed ``radius_m`` here, so no
      division by zero);
    * global_avg: otherwise the global weighted mean.

    Two radius joins against per-location profiles (J5, pre-aggregated: one row
    per location, not per event): all screens within ``radius_m``, and only the
    screens without a match there within ``fallback_m``.  Every screen is kept by
    a left join.
    """
    sums = location_sums(enriched_df)
    loc = _shares_of(sums, ["location_id", "latitude", "longitude", "uniques"]).select(
        F.col("location_id").alias("__loc"), F.col("latitude").alias("__lat"),
        F.col("longitude").alias("__lon"), F.col("uniques").alias("__u"),
        *[F.col(c).alias("__" + c) for c in SHARE_COLUMNS])
    sc = screens.select("screen_id", F.col("latitude").alias("__slat"), F.col("longitude").alias("__slon"))

    def matched(which, within, weight):
        pairs = radius_join(which, loc, within, "__slat", "__slon", "__lat", "__lon", "__d")
        total = F.sum(weight)
        return pairs.groupBy("screen_id").agg(*[(F.sum(weight * F.col("__" + c)) / F.when(total != 0, total)).alias("__p_" + c) for c in SHARE_COLUMNS])

    exact = matched(sc, radius_m, F.col("__u")).withColumn("__match", F.lit("exact"))
    others = sc.join(exact.select("screen_id"), "screen_id", "left_anti")
    fallback = matched(others, fallback_m, F.col("__u") / F.col("__d")).withColumn("__match", F.lit("fallback"))
    per = exact.unionByName(fallback)
    glob = scalar_struct(global_profile(enriched_df, sums))  # one row, no join
    out = (screens.join(per, "screen_id", "left").withColumn("__g", glob)
           .withColumns({"__g_" + c: F.col("__g")[c] for c in SHARE_COLUMNS}).drop("__g"))
    found = F.col("__match").isNotNull()
    return out.select(*screens.columns, F.coalesce("__match", F.lit("global_avg")).alias("match_type"),
                      *[F.when(found, F.col("__p_" + c)).otherwise(F.col("__g_" + c)).alias(SCREEN_SHARE_COLUMNS[k])
                        for k, c in enumerate(SHARE_COLUMNS)])


# ----------------------------------------------------------------------------- J7 / H5


def gazetteer(enriched_df: DataFrame, key: str = "cidade", mean=F.avg) -> DataFrame:
    """Name -> mean / min / max coordinates over the distinct locations
    carrying that name (valid coordinates only)."""
    locs = (enriched_df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .select(key, "location_id", "latitude", "longitude").distinct())
    return locs.groupBy(key).agg(
        mean("latitude").alias("lat"), mean("longitude").alias("lon"),
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max"),
        F.count(F.lit(1)).alias("n_locations"))


def place_reach(places: DataFrame, enriched_df: DataFrame, radius_m: float = 2000.0,
                name: str = "place") -> DataFrame:
    """J7 + F7: for each looked-up place (name, lat, lon), the locations and
    flow within ``radius_m`` -- the per-place radius filter as one job."""
    loc = location_profile(enriched_df).select(
        F.col("location_id").alias("__loc"), F.col("latitude").alias("__lat"),
        F.col("longitude").alias("__lon"), F.col("uniques").alias("__u"))
    pr = places.select(F.col(name).alias("__name"), F.col("lat").alias("__plat"), F.col("lon").alias("__plon"))
    pairs = radius_join(pr, loc, radius_m, "__plat", "__plon", "__lat", "__lon", "__d")
    agg = pairs.groupBy("__name").agg(F.count(F.lit(1)).alias("n_locations"),
                                      F.sum("__u").alias("flow"))
    return (places.select(F.col(name).alias("__name")).join(agg, "__name", "left")
            .select(F.col("__name").alias(name), F.coalesce("n_locations", F.lit(0)).alias("n_locations"),
                    F.coalesce("flow", F.lit(0.0)).alias("flow")))


def centre_ranking(enriched_df: DataFrame, radius_m: float = 5000.0, k: int | None = None) -> DataFrame:
    """H5 (our definition): per city, locations within ``radius_m`` of the
    city's centre ranked by Σuniques / max(distance, 1 m); all of them, or the first
    ``k`` per city."""
    centres = gazetteer(enriched_df).select("cidade", F.col("lat").alias("__clat"), F.col("lon").alias("__clon"))
    loc = (enriched_df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
           .groupBy("cidade", "location_id")
           .agg(F.sum("uniques").alias("flow"), F.min("latitude").alias("latitude"),
                F.min("longitude").alias("longitude")))
    d = haversine_m(F.col("latitude"), F.col("longitude"), F.col("__clat"), F.col("__clon"))
    j = (loc.join(centres, "cidade").withColumn("distance_m", d)
         .where(F.col("distance_m") <= F.lit(radius_m))
         .withColumn("score", F.col("flow") / F.greatest(F.col("distance_m"), F.lit(1.0))))
    order = [F.col("score").desc(), F.col("location_id")]
    if k is None:
        # one row per location is stored, then ranked by ranges of the score
        path = scratch_path(j.sparkSession, "centre-ranking")
        j.select("cidade", "location_id", "flow", "distance_m", "score").write.parquet(path)
        ranked = rank_rows(j.sparkSession.read.parquet(path), ["cidade"], "score", "location_id")
    else:
        # the join already partitions by city: rank with the salted two-stage
        # top-k so a city holding most locations is not ranked by one task
        ranked = top_k_per_group(j, ["cidade"], order, k, salt_cols=["location_id"])
    return ranked.select("cidade", "rank", "location_id", "flow", "distance_m", "score")


# ----------------------------------------------------------------------------- H1 / H3 / H4

# --- fixed values: hex radius curve of the map (km slider -> metres) ---
HEX_DISTANCE_MIN_KM = 1
HEX_DISTANCE_MAX_KM = 30
HEX_DISTANCE_DEFAULT_KM = 5
HEX_RADIUS_MIN_M = 120
HEX_RADIUS_MAX_M = 3000
HEX_CURVE_EXPONENT = 1.25
# map default centre latitude, used as the projection's reference latitude
HEX_REFERENCE_LAT = -23.5505


def hex_radius_m(max_distance_km: float = HEX_DISTANCE_DEFAULT_KM) -> float:
    """Hexagon radius in metres for a slider position in km: a power curve from
    HEX_RADIUS_MIN_M at the slider's low end to HEX_RADIUS_MAX_M at its high end;
    positions beyond an end count as that end."""
    position = (sorted((HEX_DISTANCE_MIN_KM, max_distance_km, HEX_DISTANCE_MAX_KM))[1] - HEX_DISTANCE_MIN_KM) / (HEX_DISTANCE_MAX_KM - HEX_DISTANCE_MIN_KM)
    return HEX_RADIUS_MIN_M + (HEX_RADIUS_MAX_M - HEX_RADIUS_MIN_M) * position**HEX_CURVE_EXPONENT


SQRT3 = math.sqrt(3.0)


def hex_axial(lat: Column, lon: Column, radius_m: float, lat0: float = HEX_REFERENCE_LAT):
    """Pointy-top axial cell (q, s) of a point, after a local equirectangular
    projection around ``lat0``; cube rounding recomputes the axis with the
    largest rounding error."""
    x = F.lit(EARTH_RADIUS_M) * F.radians(lon) * F.lit(math.cos(math.radians(lat0)))
    y = F.lit(EARTH_RADIUS_M) * F.radians(lat)
    qf = (F.lit(SQRT3 / 3) * x - y / 3) / F.lit(radius_m)
    sf = (F.lit(2.0 / 3.0) * y) / F.lit(radius_m)
    cf = -qf - sf
    rq, rs, rc = F.floor(qf + 0.5), F.floor(sf + 0.5), F.floor(cf + 0.5)
    dq, ds, dc = F.abs(rq - qf), F.abs(rs - sf), F.abs(rc - cf)
    fix_q = (dq > ds) & (dq > dc)
    fix_s = ~fix_q & (ds > dc)
    q = F.when(fix_q, -rs - rc).otherwise(rq).cast("bigint")
    s = F.when(fix_s, -rq - rc).otherwise(rs).cast("bigint")
    return q, s


def hex_center(q: Column, s: Column, radius_m: float, lat0: float = HEX_REFERENCE_LAT):
    xc = F.lit(radius_m) * (F.lit(SQRT3) * q + F.lit(SQRT3 / 2) * s)
    yc = F.lit(radius_m) * F.lit(1.5) * s
    lon = F.degrees(xc / F.lit(EARTH_RADIUS_M * math.cos(math.radians(lat0))))
    lat = F.degrees(yc / F.lit(EARTH_RADIUS_M))
    return lon, lat


def hexbin(points: DataFrame, radius_m: float, value: str = "value",
           group_cols: list[str] | None = None, lat0: float = HEX_REFERENCE_LAT) -> DataFrame:
    """H1: count and Σvalue per hexagon (optionally per extra group columns).

    A pure projection + grouped aggregation: partial counts are combined
    map-side, so a hexagon holding a third of all points is still only one
    small row per map task before the shuffle."""
    gc = list(group_cols or [])
    q, s = hex_axial(F.col("latitude"), F.col("longitude"), radius_m, lat0)
    cells = (points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
             .withColumns({"q": q, "s": s}))
    agg = cells.groupBy(*gc, "q", "s").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"))
    lon, lat = hex_center(F.col("q"), F.col("s"), radius_m, lat0)
    return agg.select(*gc, "q", "s", lon.alias("center_lon"), lat.alias("center_lat"), "n", "sum_value")


def hex_locations(points: DataFrame, radius_m: float, lat0: float = HEX_REFERENCE_LAT) -> DataFrame:
    """H1 requirement: the locations inside each hexagon, in long form
    (q, s, location_id) -- one row per pair, never a per-hexagon list."""
    q, s = hex_axial(F.col("latitude"), F.col("longitude"), radius_m, lat0)
    return (points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .select(q.alias("q"), s.alias("s"), "location_id").distinct())


def density_domain(bins: DataFrame, group_cols: list[str] | None = None, measure: str = "n") -> DataFrame:
    """H3: [min, max] of the bin measure; NULL/non-finite -> 0; max < min -> [0, 0]."""
    gc = list(group_cols or [])
    g = bins.groupBy(*gc) if gc else bins
    d = g.agg(F.min(measure).cast("double").alias("lo"), F.max(measure).cast("double").alias("hi"))
    fin = lambda c: F.when(F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf")), 0.0).otherwise(F.col(c))
    d = d.withColumns({"lo": fin("lo"), "hi": fin("hi")})
    bad = F.col("hi") < F.col("lo")
    return d.select(*gc, F.when(bad, 0.0).otherwise(F.col("lo")).alias("domain_min"),
                    F.when(bad, 0.0).otherwise(F.col("hi")).alias("domain_max"))


def color_class(bins: DataFrame, domain: DataFrame, measure: str = "n", classes: int = 6) -> DataFrame:
    """H4: equal-interval colour class 0..classes-1 over a (one-row) domain;
    a zero-width domain puts every bin in class 0."""
    dom = scalar_struct(domain.select("domain_min", "domain_max"))  # one row, no join
    j = (bins.withColumn("__d", dom)
         .withColumns({"domain_min": F.col("__d.domain_min"), "domain_max": F.col("__d.domain_max")})
         .drop("__d"))
    width = F.col("domain_max") - F.col("domain_min")
    cls = F.when(width <= 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(measure) - F.col("domain_min")) / width * classes), F.lit(classes - 1)))
    return j.withColumn("color_class", F.greatest(cls, F.lit(0)).cast("int"))
