"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables.  Doubles that come out of aggregates are rounded to 6
places on both sides so floating-point summation order cannot leak into the
comparison.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante import oracle as O
from passante.operators import demographics as D
from passante.operators.filters import GeoFilters
from passante.plans.model import enriched, snowflake, snowflake_bucketed, store_bucketed
from passante.schemas import AGE_COLUMNS, AGE_FILTER_LABELS, CLASS_COLUMNS, CLASS_FILTER_LABELS
from passante.session import apply_runtime_conf, drop_path, scratch_path, shuffles_dropped
from passante.sources.fixtures import fixture_star
from passante.sources.testdata import Tables

R6 = 6
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, O.with_fixtures(sql) if sql is not None else None)
        return fn
    return deco


def _ctx(spark: SparkSession, sf_dir: str):
    apply_runtime_conf(spark)
    t = Tables(spark, sf_dir)
    return t, fixture_star(t)


def _j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snowflake(_ctx(spark, sf_dir)[1])


def _en(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(_ctx(spark, sf_dir)[1])


# A representative filter set used by the *_filtered queries.
SAMPLE_FILTERS = GeoFilters(
    uf_estado=("AMERICA", "EUROPE", "ASIA"),
    horario=("07", "08", "09", "17", "18", "19", "x", "25"),
    genero=("feminino",),
    faixa_etaria=("20-29", "50+", "unknown"),
    classe_social=("ab", "c", "zz"),
)
SAMPLE_WHERE = """
  uf_estado in ('AMERICA', 'EUROPE', 'ASIA')
  and impression_hour in (7, 8, 9, 17, 18, 19)
  and (feminine > 0.5)
  and (x20_29 > 0.15 or (x50_59 + x60_69 + x70_79 + x80_plus) > 0.15)
  and ((a_class + b1_class + b2_class) > 0.3 or (c1_class + c2_class) > 0.3)
"""


# ---------------------------------------------------------------- A1 / A2
@register("demographics", f"select count(*) as count, {O.avg_list()} from j1")
def q_demographics(spark, sf_dir):
    return D.demographics(_j1(spark, sf_dir), round_to=R6)


@register("demographics_filtered",
          f"select count(*) as count, {O.avg_list()} from j1 where {SAMPLE_WHERE}")
def q_demographics_filtered(spark, sf_dir):
    return D.demographics(_j1(spark, sf_dir), SAMPLE_FILTERS, round_to=R6)


_AGE_CASE = O.dominant_sql(AGE_COLUMNS, AGE_FILTER_LABELS)
_CLASS_CASE = O.dominant_sql(CLASS_COLUMNS, CLASS_FILTER_LABELS)
_GENDER_CASE = "case when feminine > 0.5 then 'feminino' else 'masculino' end"


def _compare_sql(case: str, where: str = "") -> str:
    w = f"where {where}" if where else ""
    return (f"select {case} as label, count(*) as count, {O.avg_list()} from j1 {w} "
            f"group by 1 order by 1")


@register("compare_age", _compare_sql(_AGE_CASE))
def q_compare_age(spark, sf_dir):
    return D.compare(_j1(spark, sf_dir), "faixa_etaria", round_to=R6)


@register("compare_age_backfill", _compare_sql(_AGE_CASE))
def q_compare_age_backfill(spark, sf_dir):
    """J1 over the five tables stored in buckets."""
    _, star = _ctx(spark, sf_dir)
    path = scratch_path(spark, "bucketed")
    names = store_bucketed(star, path, 16, f"backfill_{path[-12:]}")
    return D.compare(snowflake_bucketed(spark, names), "faixa_etaria", round_to=R6)


@register("compare_gender", _compare_sql(_GENDER_CASE))
def q_compare_gender(spark, sf_dir):
    return D.compare(_j1(spark, sf_dir), "genero", round_to=R6)


@register("compare_class", _compare_sql(_CLASS_CASE))
def q_compare_class(spark, sf_dir):
    return D.compare(_j1(spark, sf_dir), "classe_social", round_to=R6)


@register("compare_class_filtered", _compare_sql(_CLASS_CASE, SAMPLE_WHERE))
def q_compare_class_filtered(spark, sf_dir):
    return D.compare(_j1(spark, sf_dir), "classe_social", SAMPLE_FILTERS, round_to=R6)


# ---------------------------------------------------------------- N6 / L1
_POINTS_SQL = """
select id, try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
  uniques as value
from j1 where try_cast(latitude as double) is not null and try_cast(longitude as double) is not null
"""


@register("geo_points", _POINTS_SQL + " order by id limit 5000")
def q_geo_points(spark, sf_dir):
    return D.geo_points(_j1(spark, sf_dir))


@register("geo_points_filtered", _POINTS_SQL + f" and {SAMPLE_WHERE} order by id limit 5000")
def q_geo_points_filtered(spark, sf_dir):
    return D.geo_points(_j1(spark, sf_dir), SAMPLE_FILTERS)


# ---------------------------------------------------------------- A8 / A9
@register("filter_options_states",
          "select distinct uf_estado from fx_geodata where uf_estado is not null order by 1")
def q_filter_states(spark, sf_dir):
    _, star = _ctx(spark, sf_dir)
    return D.filter_options(star.geodata)["estados"]


@register("filter_options_cities",
          "select distinct cidade from fx_geodata where cidade is not null "
          "and uf_estado in ('AMERICA', 'EUROPE') order by 1")
def q_filter_cities(spark, sf_dir):
    _, star = _ctx(spark, sf_dir)
    return D.filter_options(star.geodata, GeoFilters(uf_estado=("AMERICA", "EUROPE")))["cidades"]


@register("filter_options_addresses",
          "select distinct endereco from fx_geodata where endereco is not null "
          "and cidade = 'NATION_3' order by 1")
def q_filter_addresses(spark, sf_dir):
    _, star = _ctx(spark, sf_dir)
    return D.filter_options(star.geodata, GeoFilters(cidade=("NATION_3",)))["enderecos"]


@register("coverage_metadata", """
select (select count(distinct location_id) from enriched) as total_points,
  (select count(*) from (select distinct cidade from enriched where cidade is not null order by 1 limit 500)) as n_cities,
  (select string_agg(cidade, '|' order by cidade) from
     (select distinct cidade from enriched where cidade is not null order by 1 limit 500)) as cities
""")
def q_coverage(spark, sf_dir):
    return D.coverage_metadata(_en(spark, sf_dir))


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_compare_age(spark, sf_dir)


__all__ = ["QUERIES", "entry_query", "snowflake", "F"]


# ---------------------------------------------------------------- A7 / W1 / L2 / W2 / Q4
from passante.operators import campaign as C  # noqa: E402
from passante.schemas import COUNT_COLUMNS  # noqa: E402


def _round_doubles(df: DataFrame, cols: list[str], n: int = R6) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in cols})


_CAMPAIGN_OUT = ["latitude", "longitude", "total_flow", "affinity", "target_audience"]


# What each registered campaign selects, spelled out: the expected SQL shares no helper with the operator.
_NEAR_CENTRE = O.haversine_sql("latitude", "longitude", "-23.5505", "-46.6333") + " <= 3000.0"
_EXPECTED = {
    "young_women_ab": {"gender": "feminine_count", "age": "age_18_19_count + age_20_29_count",
                       "class": "class_a_count + class_b1_count", "where": "true", "city": None, "k": 10},
    "senior_men_3km": {"gender": "masculine_count", "age": "age_50_59_count + age_60_69_count + age_70_79_count + age_80_plus_count",
                       "class": "uniques", "where": f"{_NEAR_CENTRE} and abs(latitude) <= 90 and abs(longitude) <= 180", "city": None, "k": 20},
    "popular_city_street": {"gender": "uniques", "age": "uniques", "class": "class_c1_count + class_c2_count",
                            "where": "endereco ilike '%customer#0000000_%'", "city": "nation_7", "k": 5},
    "no_filters": {"gender": "uniques", "age": "uniques", "class": "uniques", "where": "true", "city": None, "k": 10},
    "unknown_city_fallback": {"gender": "feminine_count", "age": "uniques", "class": "uniques", "where": "true", "city": "atlantis", "k": 3},
}


def _expected_sql(campaign: str, fallback: bool) -> str:
    """One campaign: a query per factor over the rows it selects, joined by place and ranked."""
    want = _EXPECTED[campaign]
    known = f"(select count(*) > 0 from enriched where cidade ilike '{want['city']}')" if want["city"] else "true"
    city = "true" if not want["city"] else f"(cidade ilike '{want['city']}'" + (f" or not {known})" if fallback else ")")
    place = "location_id, endereco, numero, cidade"
    factor = lambda name: (f"{name}_part as (select {place}, sum({want[name]}) / nullif(sum(uniques), 0) as {name}_share "  # noqa: E731
                           f"from chosen group by {place})")
    return f"""
with chosen as (select * from enriched where {want['where']} and {city}),
places as (select {place}, min(latitude) as latitude, min(longitude) as longitude, sum(uniques) as flow from chosen group by {place}),
{factor('gender')}, {factor('age')}, {factor('class')},
scored as (select p.*, gender_share * age_share * class_share as share from places p
  left join gender_part g on (p.location_id, p.endereco, p.numero, p.cidade) is not distinct from (g.location_id, g.endereco, g.numero, g.cidade)
  left join age_part a on (p.location_id, p.endereco, p.numero, p.cidade) is not distinct from (a.location_id, a.endereco, a.numero, a.cidade)
  left join class_part c on (p.location_id, p.endereco, p.numero, p.cidade) is not distinct from (c.location_id, c.endereco, c.numero, c.cidade)),
named as (select *, concat(trim(endereco), ', ', cast(numero as varchar), ' — ', cidade) as endereco_ref from scored)
select '{campaign}' as campaign_id, {known} as city_found, location_id, endereco_ref, cidade, round(latitude, 6) as latitude,
  round(longitude, 6) as longitude, round(flow, 6) as total_flow, round(share * 100, 6) as affinity, round(flow * share, 6) as target_audience,
  row_number() over (order by share desc nulls last, location_id, endereco_ref nulls first) as rank
from named qualify rank <= {want['k']}"""


def _register_campaign(name: str, spec: C.CampaignSpec):
    def fn(spark, sf_dir):
        return _round_doubles(C.analyze_campaign(_en(spark, sf_dir), spec), _CAMPAIGN_OUT)

    body = f"select * exclude (campaign_id, city_found) from ({_expected_sql(spec.campaign_id, False)})"
    QUERIES[name] = (fn, O.with_fixtures(body))


CENTER = (-23.5505, -46.6333)
CAMPAIGNS = {
    "campaign_affinity": C.CampaignSpec(gender="female", age_min=18, age_max=29,
                                        classes=("A", "b1", "xx"), campaign_id="young_women_ab"),
    "campaign_radius": C.CampaignSpec(gender="male", age_min=50, age_max=120, latitude=CENTER[0],
                                      longitude=CENTER[1], radius_km=3.0, limit=20,
                                      campaign_id="senior_men_3km"),
    "campaign_city_street": C.CampaignSpec(classes=("C1", "C2"), city="nation_7",
                                           endereco="customer#0000000_", limit=5,
                                           campaign_id="popular_city_street"),
    "campaign_defaults": C.CampaignSpec(campaign_id="no_filters"),
}
for _n, _s in CAMPAIGNS.items():
    _register_campaign(_n, _s)

MULTI_SPECS = list(CAMPAIGNS.values()) + [
    C.CampaignSpec(gender="female", city="atlantis", limit=3, campaign_id="unknown_city_fallback"),
]


def _multi_sql(fallback: bool) -> str:
    """W2 with or without Q4: the campaigns one by one."""
    return "\nunion all\n".join(f"select * from ({_expected_sql(s.campaign_id, fallback)})" for s in MULTI_SPECS)


@register("campaign_topk_strict_city", f"select * exclude (city_found) from ({_multi_sql(False)})")
def q_campaign_strict_city(spark, sf_dir):
    """W2 without the city fallback: a campaign for an unknown city has no rows."""
    out = C.multi_campaign(_en(spark, sf_dir), MULTI_SPECS, city_fallback=False)
    return _round_doubles(out, _CAMPAIGN_OUT).drop("city_found")


@register("campaign_topk_multi", _multi_sql(True))
def q_campaign_multi(spark, sf_dir):
    return _round_doubles(C.multi_campaign(_en(spark, sf_dir), MULTI_SPECS), _CAMPAIGN_OUT)


from passante.operators import campaign_table as CT  # noqa: E402


@register("campaign_topk_table", _multi_sql(True))
def q_campaign_table(spark, sf_dir):
    """The same campaigns as a table."""
    specs = spark.createDataFrame([CT.spec_row(s) for s in MULTI_SPECS], CT.SPEC_SCHEMA)
    return _round_doubles(CT.rank_campaigns(_en(spark, sf_dir), specs), _CAMPAIGN_OUT)


# ---------------------------------------------------------------- geo: H1 H3 H4 J4 J5 J6 J7 H5 A5 A6
from passante.operators import geo as G  # noqa: E402
from passante.operators import segments as SG  # noqa: E402
from passante.schemas import SCREEN_SHARE_COLUMNS, SHARE_COLUMNS, SHARE_TO_COUNT  # noqa: E402
from passante.sources.fixtures import fx_screens  # noqa: E402

HEX_R = G.hex_radius_m(5.0)


def _hex_cte(src: str, r: float, extra: str = "") -> str:
    """SQL of the axial hex cell (q, s) of rows of ``src`` (lat, lon, value)."""
    import math
    c0 = repr(math.cos(math.radians(G.HEX_REFERENCE_LAT)))
    s3 = repr(math.sqrt(3.0) / 3)
    ex = (extra + ", ") if extra else ""
    return f"""
, hx_ax as (
  select {ex}value, ({s3} * x - y / 3) / {r!r} as qf, ((2.0 / 3.0) * y) / {r!r} as sf
  from (select {ex}value, 6371010.0 * radians(lon) * {c0} as x, 6371010.0 * radians(lat) as y from {src}) p0
), hx_rd as (
  select *, -qf - sf as cf, floor(qf + 0.5) as rq, floor(sf + 0.5) as rs, floor(-qf - sf + 0.5) as rc from hx_ax
), hx_cell as (
  select {ex}value,
    cast(case when abs(rq - qf) > abs(rs - sf) and abs(rq - qf) > abs(rc - cf) then -rs - rc else rq end as bigint) as q,
    cast(case when not (abs(rq - qf) > abs(rs - sf) and abs(rq - qf) > abs(rc - cf)) and abs(rs - sf) > abs(rc - cf)
              then -rq - rc else rs end as bigint) as s
  from hx_rd
)"""


def _hex_center_sql(r: float) -> str:
    import math
    c0 = 6371010.0 * math.cos(math.radians(G.HEX_REFERENCE_LAT))
    return (f"round(degrees({r!r} * ({math.sqrt(3.0)!r} * q + {math.sqrt(3.0) / 2!r} * s) / {c0!r}), 6) as center_lon, "
            f"round(degrees({r!r} * 1.5 * s / 6371010.0), 6) as center_lat")


_PTS_CTE = """
, pts as (select location_id, try_cast(latitude as double) as lat, try_cast(longitude as double) as lon,
            uniques as value from j1
          where try_cast(latitude as double) is not null and try_cast(longitude as double) is not null)
"""

_HEXBIN_SQL = (_PTS_CTE + _hex_cte("pts", HEX_R) +
               f"\nselect q, s, {_hex_center_sql(HEX_R)}, count(*) as n, round(sum(value), 6) as sum_value "
               "from hx_cell group by q, s")


def _fixture_sql(body: str) -> str:
    return "WITH " + O.FIXTURE_CTES.strip() + body


def _hexbin_df(spark, sf_dir):
    pts = D.point_rows(_j1(spark, sf_dir))
    return G.hexbin(pts, HEX_R)


def q_hexbin(spark, sf_dir):
    return _round_doubles(_hexbin_df(spark, sf_dir), ["center_lon", "center_lat", "sum_value"])


QUERIES["hexbin"] = (q_hexbin, _fixture_sql(_HEXBIN_SQL))


def q_hex_colors(spark, sf_dir):
    bins = _hexbin_df(spark, sf_dir)
    dom = G.density_domain(bins)
    return G.color_class(bins, dom).select("q", "s", "n", "domain_min", "domain_max", "color_class")


QUERIES["hex_color_classes"] = (q_hex_colors, _fixture_sql(
    _PTS_CTE + _hex_cte("pts", HEX_R) + """
, bins as (select q, s, count(*) as n from hx_cell group by q, s)
, dom as (select cast(min(n) as double) as domain_min, cast(max(n) as double) as domain_max from bins)
select q, s, n, domain_min, domain_max,
  cast(case when domain_max - domain_min <= 0 then 0
       else greatest(least(floor((n - domain_min) / (domain_max - domain_min) * 6), 5), 0) end as integer) as color_class
from bins, dom"""))


def _hex_locations(spark, sf_dir):
    j = _j1(spark, sf_dir).where(F.col("latitude").try_cast("double").isNotNull())
    pts = j.select("location_id", F.col("latitude").try_cast("double").alias("latitude"),
                   F.col("longitude").try_cast("double").alias("longitude"))
    return G.hex_locations(pts, HEX_R)


QUERIES["hex_locations"] = (_hex_locations, _fixture_sql(
    _PTS_CTE + _hex_cte("pts", HEX_R, "location_id") + "\nselect distinct q, s, location_id from hx_cell"))


def _loc_sql() -> str:
    sums = ", ".join(f"sum({SHARE_TO_COUNT[c]}) as {SHARE_TO_COUNT[c]}" for c in SHARE_COLUMNS)
    shares = ", ".join(f"{SHARE_TO_COUNT[c]} / nullif(uniques, 0) as {c}" for c in SHARE_COLUMNS)
    return f"""
, loc0 as (select location_id, sum(uniques) as uniques, min(latitude) as latitude, min(longitude) as longitude, {sums}
           from enriched group by location_id)
, loc as (select location_id, latitude, longitude, uniques, {shares} from loc0)
"""


def q_location_profile(spark, sf_dir):
    df = G.location_profile(_en(spark, sf_dir))
    return _round_doubles(df, ["latitude", "longitude", "uniques"] + SHARE_COLUMNS)


QUERIES["location_profile"] = (q_location_profile, _fixture_sql(
    _loc_sql() + "select location_id, round(latitude, 6) as latitude, round(longitude, 6) as longitude, "
    "round(uniques, 6) as uniques, " + ", ".join(f"round({c}, 6) as {c}" for c in SHARE_COLUMNS) + " from loc"))


def q_radius_join(spark, sf_dir):
    t, star = _ctx(spark, sf_dir)
    loc = G.location_profile(_en(spark, sf_dir)).select(
        "location_id", F.col("latitude").alias("loc_lat"), F.col("longitude").alias("loc_lon"))
    pairs = G.radius_join(fx_screens(t), loc, 1000.0, "latitude", "longitude", "loc_lat", "loc_lon")
    return _round_doubles(pairs.select("screen_id", "location_id", "distance_m"), ["distance_m"])


QUERIES["radius_join"] = (q_radius_join, _fixture_sql(_loc_sql() + f"""
select s.screen_id, l.location_id, round({O.haversine_sql('s.latitude', 's.longitude', 'l.latitude', 'l.longitude')}, 6) as distance_m
from fx_screens s join loc l on l.latitude is not null and l.longitude is not null
  and {O.haversine_sql('s.latitude', 's.longitude', 'l.latitude', 'l.longitude')} <= 1000.0"""))


def _enrich_sql() -> str:
    hv = O.haversine_sql("s.latitude", "s.longitude", "l.latitude", "l.longitude")
    per = ", ".join(f"sum(case when d <= 500.0 then u * {c} end) as e_{c}, "
                    f"sum(case when d > 500.0 then (u / d) * {c} end) as f_{c}" for c in SHARE_COLUMNS)
    glob = ", ".join(f"sum({SHARE_TO_COUNT[c]}) / nullif(sum(uniques), 0) as g_{c}" for c in SHARE_COLUMNS)
    outs = ", ".join(
        f"round(case when coalesce(n_exact, 0) > 0 then e_{c} / nullif(we, 0) "
        f"when coalesce(n_pairs, 0) > 0 then f_{c} / nullif(wf, 0) else g_{c} end, 6) as {p}"
        for c, p in zip(SHARE_COLUMNS, SCREEN_SHARE_COLUMNS))
    return _loc_sql() + f"""
, pairs as (select s.screen_id, l.uniques as u, {", ".join("l." + c for c in SHARE_COLUMNS)}, {hv} as d
            from fx_screens s join loc l on l.latitude is not null and l.longitude is not null and {hv} <= 5000.0)
, per as (select screen_id, count(case when d <= 500.0 then 1 end) as n_exact, count(*) as n_pairs,
            sum(case when d <= 500.0 then u end) as we, sum(case when d > 500.0 then u / d end) as wf, {per}
          from pairs group by screen_id)
, gavg as (select {glob} from enriched)
select s.screen_id, round(s.latitude, 6) as latitude, round(s.longitude, 6) as longitude,
  case when coalesce(n_exact, 0) > 0 then 'exact' when coalesce(n_pairs, 0) > 0 then 'fallback' else 'global_avg' end as match_type,
  {outs}
from fx_screens s left join per on s.screen_id = per.screen_id cross join gavg"""


def q_screen_enrichment(spark, sf_dir):
    t, star = _ctx(spark, sf_dir)
    df = G.enrich_screens(fx_screens(t), _en(spark, sf_dir))
    return _round_doubles(df, ["latitude", "longitude"] + SCREEN_SHARE_COLUMNS)


QUERIES["screen_enrichment"] = (q_screen_enrichment, _fixture_sql(_enrich_sql()))

_GAZ_CTE = """
, locs as (select distinct cidade, location_id, latitude, longitude from enriched
           where latitude is not null and longitude is not null)
, gaz as (select cidade, avg(latitude) as lat, avg(longitude) as lon, min(latitude) as lat_min, max(latitude) as lat_max,
            min(longitude) as lon_min, max(longitude) as lon_max, count(*) as n_locations from locs group by cidade)
"""


from passante.operators import places as PL  # noqa: E402


def _mean6(c: str):
    """Mean of a 4-decimal coordinate, rounded half-up at 1e-6 with integer
    arithmetic: Σ round(x * 1e4) is exact, so the result does not depend on
    summation order (a plain double mean can sit exactly on a rounding tie)."""
    s4 = F.sum(F.round(F.col(c) * 10000).cast("bigint"))
    n = F.count(c)
    return F.floor((s4 * 200 + n) / (n * 2.0)) / 1000000.0


def q_gazetteer(spark, sf_dir):
    return G.gazetteer(_en(spark, sf_dir), "cidade", _mean6)


def _mean6_sql(c: str) -> str:
    return (f"floor((cast(sum(cast(round({c} * 10000) as bigint)) as double) * 200 + count({c})) "
            f"/ (count({c}) * 2.0)) / 1000000.0")


QUERIES["gazetteer_cities"] = (q_gazetteer, _fixture_sql(
    _GAZ_CTE + f"select cidade, {_mean6_sql('latitude')} as lat, {_mean6_sql('longitude')} as lon, "
    "min(latitude) as lat_min, max(latitude) as lat_max, min(longitude) as lon_min, max(longitude) as lon_max, "
    "count(*) as n_locations from locs group by cidade"))


def q_place_reach(spark, sf_dir):
    en = _en(spark, sf_dir)
    places = G.gazetteer(en).select(F.col("cidade").alias("place"), "lat", "lon")
    return _round_doubles(G.place_reach(places, en, 2000.0), ["flow"])


QUERIES["place_reach"] = (q_place_reach, _fixture_sql(_GAZ_CTE + _loc_sql() + f"""
, pr as (select g.cidade as place, count(*) as n_locations, sum(l.uniques) as flow
         from gaz g join loc l on l.latitude is not null and l.longitude is not null
           and {O.haversine_sql('g.lat', 'g.lon', 'l.latitude', 'l.longitude')} <= 2000.0 group by g.cidade)
select g.cidade as place, coalesce(pr.n_locations, 0) as n_locations, round(coalesce(pr.flow, 0.0), 6) as flow
from gaz g left join pr on g.cidade = pr.place"""))


def _places(spark, sf_dir):
    """Cities and streets with their kind and number of locations."""
    en = _en(spark, sf_dir)
    both = [G.gazetteer(en, key).select(F.lit(key).alias("kind"), F.col(key).alias("name"), "n_locations") for key in ("cidade", "endereco")]
    return both[0].unionByName(both[1])


def _misspelt(places):
    """One query per name: a letter less, two letters the wrong way round, accents and capitals."""
    at = F.floor(F.length("name") / 2).cast("int")
    kind = F.length("name") % 3
    left, one, two, rest = (F.substr("name", F.lit(1), at - 1), F.substr("name", at, F.lit(1)), F.substr("name", at + 1, F.lit(1)), F.substr("name", at + 2))
    query = (F.when(F.col("name").startswith("Customer#"), F.when(F.col("name").rlike("[0-4]$"), F.concat(left, two, rest)).otherwise(F.concat(left, two, one, rest)))
             .when(kind == 0, F.concat(left, two, rest)).when(kind == 1, F.concat(left, two, one, rest))
             .otherwise(F.upper(F.translate(F.lower("name"), "aeiouc", "áêíõúç"))))
    return places.select(query.alias("query"))


def q_place_search(spark, sf_dir):
    """Free text with misspellings and accents -> places."""
    path = scratch_path(spark, "places")
    _places(spark, sf_dir).write.parquet(path)  # asked for, indexed and returned: the events are joined once
    places = spark.read.parquet(path)
    return PL.find_places(_misspelt(places), places)


QUERIES["place_search"] = (q_place_search, _fixture_sql("""
, names as (select 'cidade' as kind, cidade as name, count(distinct (location_id, latitude, longitude)) as n_locations from enriched
    where latitude is not null and longitude is not null group by cidade
  union all select 'endereco', endereco, count(distinct (location_id, latitude, longitude)) from enriched
    where latitude is not null and longitude is not null group by endereco)
, cut as (select name, cast(floor(length(name) / 2) as int) as k from names)
, spelt as (select distinct case when starts_with(name, 'Customer#') and regexp_matches(name, '[0-4]$') or not starts_with(name, 'Customer#') and length(name) % 3 = 0
      then substr(name, 1, k - 1) || substr(name, k + 1)
    when starts_with(name, 'Customer#') or length(name) % 3 = 1 then substr(name, 1, k - 1) || substr(name, k + 1, 1) || substr(name, k, 1) || substr(name, k + 2)
    else upper(translate(lower(name), 'aeiouc', 'áêíõúç')) end as query from cut)
, compared as (select query, lower(strip_accents(query)) as q, lower(strip_accents(name)) as n, kind, name, n_locations from spelt, names)
select query, cast(levenshtein(q, n) as int) as distance, kind, name, n_locations from compared
where levenshtein(q, n) <= least(2, length(q) // 4)"""))


def q_centre_ranking(spark, sf_dir):
    return _round_doubles(G.centre_ranking(_en(spark, sf_dir)), ["flow", "distance_m", "score"])


QUERIES["centre_ranking"] = (q_centre_ranking, _fixture_sql(_GAZ_CTE + f"""
, lf as (select cidade, location_id, sum(uniques) as flow, min(latitude) as latitude, min(longitude) as longitude
         from enriched where latitude is not null and longitude is not null group by cidade, location_id)
, j as (select lf.*, {O.haversine_sql('lf.latitude', 'lf.longitude', 'gaz.lat', 'gaz.lon')} as distance_m
        from lf join gaz on lf.cidade = gaz.cidade)
, r as (select *, flow / greatest(distance_m, 1.0) as score,
          row_number() over (partition by cidade order by flow / greatest(distance_m, 1.0) desc, location_id) as rank
        from j where distance_m <= 5000.0)
select cidade, rank, location_id, round(flow, 6) as flow, round(distance_m, 6) as distance_m, round(score, 6) as score
from r"""))


_AGE_PRED = {
    "18-19": "x18_19", "20-29": "x20_29", "30-39": "x30_39", "40-49": "x40_49",
    "50-59": "x50_59", "60-69": "x60_69", "70-79": "x70_79", "80+": "x80_plus",
}


def _segment_sql(limit: int = SG.CARD_LIMIT) -> str:
    blocks = [f"select '{v}' as segment, id, try_cast(latitude as double) as latitude, "
              f"try_cast(longitude as double) as longitude, uniques as value, location_id from j1 "
              f"where try_cast(latitude as double) is not null and try_cast(longitude as double) is not null "
              f"and {col} > 0.15" for v, col in _AGE_PRED.items()]
    return ("\n, seg_all as (" + "\nunion all\n".join(blocks) + ")\n"
            f", seg as (select * from (select *, row_number() over (partition by segment order by id) as rn "
            f"from seg_all) z where rn <= {limit})\n")


def _segments_df(spark, sf_dir):
    return SG.segment_points(_j1(spark, sf_dir), "age")


QUERIES["segment_grid"] = (_segments_df, _fixture_sql(
    _segment_sql() + "select segment, id, latitude, longitude, value, location_id from seg"))


def q_segment_domain(spark, sf_dir):
    return SG.shared_domain(SG.segment_hexbins(SG.segment_rows(_j1(spark, sf_dir), "age"), HEX_R))


QUERIES["segment_density_domain"] = (q_segment_domain, _fixture_sql(
    _segment_sql() + ", pts as (select segment, latitude as lat, longitude as lon, value from seg_all)"
    + _hex_cte("pts", HEX_R, "segment") + """
, bins as (select segment, q, s, count(*) as n from hx_cell group by segment, q, s)
, per as (select segment, cast(min(n) as double) as lo, cast(max(n) as double) as hi from bins group by segment)
select min(lo) as domain_min, max(hi) as domain_max, count(*) as n_segments from per where hi >= lo"""))


# ---------------------------------------------------------------- BI: R1 R2 U1 A10-A17 N7 N10
from passante.operators import bi as B  # noqa: E402
from passante.schemas import (  # noqa: E402
    JOINT_AGE_LABELS, JOINT_CLASS_LABELS,
    JOINT_GENDER_LABELS,
)


def _values_cte(name: str, col: str, labels: list[str]) -> str:
    vals = ", ".join(f"('{v}')" for v in labels)
    return f", {name} as (select * from (values {vals}) t({col}))\n"


def _case(col: str, mapping: dict[str, str]) -> str:
    return "(case " + col + " " + " ".join(f"when '{k}' then {v}" for k, v in mapping.items()) + " end)"


def _joint_sql(classes=None, genders=None, ages=None, by="cl, gl, al",
               names="cl as class_label, gl as gender_label, al as age_label") -> str:
    cl = B._pick(JOINT_CLASS_LABELS, classes)
    gl = B._pick(JOINT_GENDER_LABELS, genders)
    al = B._pick(JOINT_AGE_LABELS, ages)
    jc = (f"uniques * {_case('cl', {k: B.JOINT_CLASS_COL[k] for k in cl})} * "
          f"{_case('gl', {k: B.JOINT_GENDER_COL[k] for k in gl})} * {_case('al', {k: B.JOINT_AGE_COL[k] for k in al})}")
    return (_values_cte("lc", "cl", cl) + _values_cte("lg", "gl", gl) + _values_cte("la", "al", al)
            + f"select {names}, round(sum({jc}), 6) as joint_count, count(*) as n_rows "
              f"from enriched, lc, lg, la group by {by}")


def q_joint(spark, sf_dir):
    return _round_doubles(B.joint_aggregate(_en(spark, sf_dir)), ["joint_count"])


QUERIES["joint_distribution"] = (q_joint, _fixture_sql(_joint_sql()))

_JF = dict(classes=("A", "B1"), genders=("Feminine",), ages=("20-29", "30-39"))


def q_joint_filtered(spark, sf_dir):
    j = B.joint_aggregate(_en(spark, sf_dir), ["impression_hour"], **_JF)
    t = j.groupBy("impression_hour", "class_label").agg(F.sum("joint_count").alias("joint_count"),
                                                       F.sum("n_rows").alias("n_rows"))
    return _round_doubles(t, ["joint_count"])


QUERIES["joint_by_hour_filtered"] = (q_joint_filtered, _fixture_sql(
    _joint_sql(by="impression_hour, cl", names="impression_hour, cl as class_label", **_JF)))


def q_joint_invariant(spark, sf_dir):
    """Σ joint_count over the 96 rows of each event vs its uniques."""
    per = _en(spark, sf_dir).select("uniques", B.joint_counts().alias("c")).select(
        "uniques", F.size("c").cast("bigint").alias("k"), F.aggregate("c", F.lit(0.0), lambda total, x: total + x).alias("s"))
    return per.agg(F.count(F.lit(1)).alias("events"), F.min("k").alias("min_rows"), F.max("k").alias("max_rows"),
                   F.round(F.max(F.abs(F.col("s") - F.col("uniques"))), 6).alias("max_abs_diff"))


def _joint_invariant_sql() -> str:
    cl, gl, al = JOINT_CLASS_LABELS, JOINT_GENDER_LABELS, JOINT_AGE_LABELS
    jc = (f"uniques * {_case('cl', B.JOINT_CLASS_COL)} * "
          f"{_case('gl', B.JOINT_GENDER_COL)} * {_case('al', B.JOINT_AGE_COL)}")
    return (_values_cte("lc", "cl", cl) + _values_cte("lg", "gl", gl) + _values_cte("la", "al", al)
            + f", per as (select id, uniques, sum({jc}) as s, count(*) as k from enriched, lc, lg, la group by id, uniques)\n"
              "select count(*) as events, min(k) as min_rows, max(k) as max_rows, "
              "round(max(abs(s - uniques)), 6) as max_abs_diff from per")


QUERIES["joint_sum_invariant"] = (q_joint_invariant, _fixture_sql(_joint_invariant_sql()))


def _dim_pairs(dim):
    return [(lab, col) for d, lab, col in B.LONG_FORM if d == dim]


def q_unpivot_class(spark, sf_dir):
    u = B.unpivot_dimension(_en(spark, sf_dir), "class")
    return _round_doubles(u.groupBy("tipo").agg(F.sum("valor").alias("valor"), F.count(F.lit(1)).alias("n")),
                          ["valor"])


QUERIES["unpivot_class"] = (q_unpivot_class, _fixture_sql(
    "\n, u as (" + " union all ".join(f"select '{lab}' as tipo, {col} as valor from enriched"
                                       for lab, col in _dim_pairs("class")) + ")\n"
    "select tipo, round(sum(valor), 6) as valor, count(*) as n from u group by tipo"))


def q_long_form(spark, sf_dir):
    u = B.long_form(_en(spark, sf_dir))
    return _round_doubles(u.groupBy("tipo", "label").agg(F.sum("valor").alias("valor"), F.count(F.lit(1)).alias("n")),
                          ["valor"])


QUERIES["long_form_union"] = (q_long_form, _fixture_sql(
    "\n, u as (" + " union all ".join(f"select '{d}' as tipo, '{lab}' as label, {col} as valor from enriched"
                                       for d, lab, col in B.LONG_FORM) + ")\n"
    "select tipo, label, round(sum(valor), 6) as valor, count(*) as n from u group by tipo, label"))


@register("peak_hour", "select impression_hour, round(sum(uniques), 6) as flow from enriched "
                       "group by 1 order by sum(uniques) desc, impression_hour limit 1")
def q_peak_hour(spark, sf_dir):
    return _round_doubles(B.peak_hour(_en(spark, sf_dir)), ["flow"])


@register("top_address", "select endereco, round(sum(uniques), 6) as flow from enriched where endereco is not null "
                         "group by 1 order by sum(uniques) desc, endereco limit 1")
def q_top_address(spark, sf_dir):
    return _round_doubles(B.top_address(_en(spark, sf_dir)), ["flow"])


@register("people_by_hour", "select impression_hour, round(sum(uniques), 6) as flow from enriched group by 1")
def q_people_by_hour(spark, sf_dir):
    return _round_doubles(B.people_by_hour(_en(spark, sf_dir)), ["flow"])


@register("gender_by_hour", "select impression_hour, 'Feminine' as gender_label, round(sum(feminine_count), 6) as value "
                            "from enriched group by 1 union all "
                            "select impression_hour, 'Masculine', round(sum(masculine_count), 6) from enriched group by 1")
def q_gender_by_hour(spark, sf_dir):
    return _round_doubles(B.gender_by_hour(_en(spark, sf_dir)), ["value"])


def _composition_sql(dim: str) -> str:
    pairs = _dim_pairs(dim)
    u = " union all ".join(f"select '{lab}' as label, sum({col}) as value from enriched" for lab, col in pairs)
    return (f"\n, u as ({u})\n, t as (select sum(coalesce(value, 0.0)) as total from u)\n"
            "select label, round(value, 6) as value, round(value / nullif(total, 0), 6) as share from u, t")


def q_class_share(spark, sf_dir):
    return _round_doubles(B.composition(_en(spark, sf_dir), "class"), ["value", "share"])


def q_age_share(spark, sf_dir):
    return _round_doubles(B.composition(_en(spark, sf_dir), "age"), ["value", "share"])


QUERIES["class_share"] = (q_class_share, _fixture_sql(_composition_sql("class")))
QUERIES["age_share"] = (q_age_share, _fixture_sql(_composition_sql("age")))


@register("flow_by_state_hour", "select uf_estado, impression_hour, round(sum(uniques), 6) as sum, "
                                "floor((cast(sum(cast(round(uniques * 100) as bigint)) as double) * 20000 + count(*)) "
                                "/ (2.0 * count(*))) / 1000000.0 as mean, max(uniques) as peak, count(*) as n "
                                "from enriched group by 1, 2")
def q_group_measures(spark, sf_dir):
    # uniques carry 2 decimals: the mean is exact and rounded half-up at 6
    df = B.group_measures(_en(spark, sf_dir), ["uf_estado", "impression_hour"], exact_scale=2)
    return _round_doubles(df, ["sum"])


AREA_A = (-23.5505, -46.6333, 3000.0)
AREA_B = (-23.48, -46.57, 4000.0)


def q_area_compare(spark, sf_dir):
    return _round_doubles(B.area_compare(_en(spark, sf_dir), AREA_A, AREA_B), ["share_a", "share_b", "pct_diff"])


def _area_sql(dimension: str = "class") -> str:
    pairs = _dim_pairs(dimension)
    ins = lambda a: O.haversine_sql("latitude", "longitude", repr(a[0]), repr(a[1])) + f" <= {a[2]!r}"
    sums = ", ".join(f"sum({col}) as s_{i}" for i, (_, col) in enumerate(pairs))
    tag = (f"select 'A' as area, * from enriched where latitude is not null and longitude is not null and {ins(AREA_A)} "
           f"union all select 'B' as area, * from enriched where latitude is not null and longitude is not null and {ins(AREA_B)}")
    rows = " union all ".join(f"select area, '{lab}' as label, s_{i} / nullif(flow, 0) as share from agg"
                              for i, (lab, _) in enumerate(pairs))
    return (f"\n, tg as ({tag})\n, agg as (select area, sum(uniques) as flow, {sums} from tg group by area)\n"
            f", lr as ({rows})\n"
            "select l.label, round(max(case when area = 'A' then share end), 6) as share_a, "
            "round(max(case when area = 'B' then share end), 6) as share_b, "
            "round((max(case when area = 'B' then share end) - max(case when area = 'A' then share end)) / "
            "nullif(max(case when area = 'A' then share end), 0) * 100, 6) as pct_diff "
            "from (select distinct label from lr) l left join lr on l.label = lr.label group by l.label")


QUERIES["area_compare"] = (q_area_compare, _fixture_sql(_area_sql()))


def _area_query(dimension):
    def fn(spark, sf_dir):
        """A16 by another dimension."""
        return _round_doubles(B.area_compare(_en(spark, sf_dir), AREA_A, AREA_B, dimension), ["share_a", "share_b", "pct_diff"])
    return fn


for _d in ("age", "gender"):
    QUERIES[f"area_compare_{_d}"] = (_area_query(_d), _fixture_sql(_area_sql(_d)))


def q_result_facets(spark, sf_dir):
    return B.result_facets(SAMPLE_FILTERS.apply(_j1(spark, sf_dir)))


QUERIES["result_facets"] = (q_result_facets, _fixture_sql(f"""
, r as (select * from j1 where {SAMPLE_WHERE})
, u as (select 'faixa_etaria' as facet, {_AGE_CASE} as value from r
        union all select 'classe_social', {_CLASS_CASE} from r
        union all select 'genero', {_GENDER_CASE} from r
        union all select 'endereco', endereco from r)
select facet, value, count(*) as n from u where value is not null group by 1, 2"""))


@register("address_labels", "select distinct location_id, concat(trim(endereco), ', ', cast(numero as varchar), "
                            "' — ', cidade) as endereco_ref from enriched")
def q_address_labels(spark, sf_dir):
    return B.address_labels(_en(spark, sf_dir))


@register("wide_counts_by_state", "select uf_estado, round(sum(uniques), 6) as uniques, "
          + ", ".join(f"round(sum({c}), 6) as {c}" for c in COUNT_COLUMNS) + " from enriched group by 1")
def q_wide_counts(spark, sf_dir):
    df = _en(spark, sf_dir).groupBy("uf_estado").agg(F.sum("uniques").alias("uniques"),
                                                     *[F.sum(c).alias(c) for c in COUNT_COLUMNS])
    return _round_doubles(df, ["uniques"] + COUNT_COLUMNS)


# ---------------------------------------------------------------- archive records: A12, A20-A22
from passante.operators import telemetry as TM  # noqa: E402
from passante.sources.fixtures import fx_envelope, fx_geodata  # noqa: E402


def _records(spark, sf_dir):
    """Archived messages: envelope + the geodata event they carry."""
    t, _ = _ctx(spark, sf_dir)
    env = fx_envelope(t)
    g = fx_geodata(t)
    return env.join(g, g.id == F.concat(F.lit("g"), env.event_id.cast("string")))


_REC_CTE = "\n, rec as (select e.*, g.* from fx_envelope e join fx_geodata g on g.id = concat('g', cast(e.event_id as varchar)))\n"


def q_people_per_day(spark, sf_dir):
    df = B.people_per_day(_records(spark, sf_dir))
    return _round_doubles(df.withColumn("day", F.date_format("day", "yyyy-MM-dd")), ["flow"])


QUERIES["people_per_day"] = (q_people_per_day, _fixture_sql(
    _REC_CTE + "select strftime(cast(kafka_timestamp as date), '%Y-%m-%d') as day, round(sum(uniques), 6) as flow "
               "from rec group by 1"))


def q_avg_per_day(spark, sf_dir):
    return _round_doubles(B.avg_people_per_day(_records(spark, sf_dir)), ["total_flow", "avg_per_day"])


QUERIES["avg_people_per_day"] = (q_avg_per_day, _fixture_sql(
    _REC_CTE + ", d as (select cast(kafka_timestamp as date) as day, sum(uniques) as flow from rec group by 1)\n"
               "select count(*) as n_days, round(sum(flow), 6) as total_flow, round(avg(flow), 6) as avg_per_day from d"))


@register("partition_lag", "select topic, kafka_partition, max(kafka_offset) as last_offset, "
                           "arg_max(high_watermark, kafka_offset) as high_watermark, count(*) as messages, "
                           "arg_max(high_watermark, kafka_offset) - max(kafka_offset) as lag "
                           "from fx_envelope group by 1, 2")
def q_partition_lag(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return TM.partition_lag(fx_envelope(t))


def q_lag_histogram(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return TM.lag_histogram(fx_envelope(t))


def _hist_sql() -> str:
    from passante.schemas import PARTITION_LAG_BUCKETS
    rows = " union all ".join(
        f"select cast({float(b)!r} as double) as le, cast(count(case when high_watermark - kafka_offset <= {b} then 1 end) as bigint) as count from fx_envelope"
        for b in PARTITION_LAG_BUCKETS)
    return (f"\n{rows} union all select cast('inf' as double) as le, "
            "cast(count(high_watermark - kafka_offset) as bigint) as count from fx_envelope")


QUERIES["lag_histogram"] = (q_lag_histogram, _fixture_sql(_hist_sql()))


@register("lag_percentiles", "select round(cast(quantile_disc(high_watermark - kafka_offset, 0.5) as double), 6) as p50, "
                             "round(cast(quantile_disc(high_watermark - kafka_offset, 0.95) as double), 6) as p95, "
                             "round(cast(quantile_disc(high_watermark - kafka_offset, 0.99) as double), 6) as p99, "
                             "count(*) as messages from fx_envelope")
def q_lag_percentiles(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return _round_doubles(TM.lag_percentiles(fx_envelope(t)), ["p50", "p95", "p99"])


def q_rate_panel(spark, sf_dir):
    rec = _records(spark, sf_dir).withColumn("is_error", F.col("target_id").isNull())
    df = TM.rate_panel(rec)
    return _round_doubles(df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")),
                          ["rate_per_s", "error_ratio"])


QUERIES["ingest_rate_5min"] = (q_rate_panel, _fixture_sql(
    _REC_CTE + "select strftime(time_bucket(interval '5 minutes', kafka_timestamp), '%Y-%m-%d %H:%M:%S') as window_start, "
               "count(*) as messages, round(count(*) / 300.0, 6) as rate_per_s, "
               "round(sum(case when target_id is null then 1 else 0 end) / count(*), 6) as error_ratio "
               "from rec group by 1"))


# ---------------------------------------------------------------- W3 conversation budget
from passante.operators.conversation import conversation_budget  # noqa: E402

BUDGET_CONTEXT = 800


def q_conversation_budget(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return conversation_budget(t.conversations, context=BUDGET_CONTEXT)


def _budget_sql() -> str:
    thr = int(BUDGET_CONTEXT * 0.75)
    kept = ", ".join(f"sum(case when turn >= {k} then tokens end) as kept_{k}, "
                     f"count(case when turn < {k} then 1 end) as before_{k}" for k in ("u1", "u2", "u3"))
    fits = {k: f"({k} is not null and coalesce(kept_{k}, 0) <= {thr})" for k in ("u3", "u2", "u1")}

    def pick(fmt, default="null"):
        return ("case when total_tokens <= " + str(thr) + f" then {default} "
                + " ".join(f"when {fits[k]} then {fmt.format(k=k)}" for k in ("u3", "u2", "u1"))
                + f" else {default} end")
    before = pick("before_{k}", "0")
    return f"""
, m as (select conv_id, turn, role, cast(floor(coalesce(length(text), 0) / 4) as bigint) as tokens from conversations)
, u as (select conv_id, turn, row_number() over (partition by conv_id order by turn desc) as k from m where role = 'user')
, mk as (select conv_id, max(case when k = 1 then turn end) as u1, max(case when k = 2 then turn end) as u2,
           max(case when k = 3 then turn end) as u3 from u group by conv_id)
, a as (select m.conv_id, count(*) as n_messages, cast(sum(tokens) as bigint) as total_tokens, max(u1) as u1, max(u2) as u2, max(u3) as u3,
          {kept} from m left join mk on m.conv_id = mk.conv_id group by m.conv_id)
select conv_id, n_messages, total_tokens, cast({thr} as bigint) as threshold, total_tokens > {thr} as triggered,
  cast(case when ({before}) > 0 then ({pick('{k}')}) end as bigint) as split_turn,
  cast(case when ({before}) > 0 then ({pick('kept_{k}')}) end as bigint) as kept_tokens,
  cast({before} as bigint) as n_marked
from a"""


QUERIES["conversation_budget"] = (q_conversation_budget, _fixture_sql(_budget_sql()))


# ---------------------------------------------------------------- Q1 ad-hoc SQL
from passante.plans.sqlguard import run_readonly  # noqa: E402

ADHOC_SQL = ("SELECT cidade, COUNT(*) AS n_events, ROUND(SUM(uniques), 6) AS flow "
             "FROM geodata GROUP BY cidade ORDER BY cidade LIMIT 100;")


def q_adhoc_sql(spark, sf_dir):
    _, star = _ctx(spark, sf_dir)
    return run_readonly(spark, ADHOC_SQL, star.as_dict())


QUERIES["adhoc_sql_city_flow"] = (q_adhoc_sql, _fixture_sql(
    "\n, geodata as (select * from fx_geodata)\n" + ADHOC_SQL.rstrip(";")))


# ---------------------------------------------------------------- ingest round trip: N1 N3 N4 F14 S1 semantics
from passante.plans import ingest as I  # noqa: E402
from passante.sources.testdata import Star, read_star  # noqa: E402


def _flow_lines(spark, sf_dir):
    """(line, part, kind): the joined events as CSV records; the street carries the
    event's id.  One in 50 records lacks its last field, one has a field too many, one
    a number that does not parse and one a profile that does not; two in 50 have a line
    break in the street.  The files of two of the four parts have two columns more."""
    rows = I.to_flow_rows(_j1(spark, sf_dir).withColumn("endereco", F.concat("endereco", F.lit("#"), "id")))
    number = F.regexp_extract("endereco", "#g([0-9]+)$", 1).cast("bigint")
    kind = number % 50
    rows = rows.withColumn("endereco", F.when(kind.isin(3, 28), F.regexp_replace("endereco", "#(?=g[0-9]+$)", "\n#")).otherwise(F.col("endereco")))
    rows = rows.withColumns({"uniques": F.when(kind == 21, "a lot").otherwise(F.col("uniques")),
                             "target": F.when(kind == 33, "{'idade': oops").otherwise(F.col("target"))})
    names = rows.columns
    whole = F.to_csv(F.struct(*names))
    line = F.when(kind == 7, F.to_csv(F.struct(*names[:-1]))).when(kind == 13, F.concat(whole, F.lit(",more"))).otherwise(whole)
    part = (number % 4).cast("int")
    line = F.when(part >= 2, F.concat(line, F.lit(',more,"and ""more""\n"'))).otherwise(line)
    return rows.select(line.alias("line"), part.alias("part"), kind.alias("kind")), names


#: Files per part of the flow CSV.
FLOW_FILES = 16


def _write_flow_csv(spark, lines, names, path):
    """Files with a header each, ``FLOW_FILES`` per part.  The records are stored before they
    are dealt, so the shuffles of their joins are gone when the texts are shuffled."""
    wide = F.when(F.col("id") % 4 >= 2, ",k,l").otherwise("")
    header = spark.range(4 * FLOW_FILES).select(F.concat(F.lit(",".join(names)), wide).alias("line"), (F.col("id") % 4).cast("int").alias("part"),
                                                F.floor(F.col("id") / 4).cast("int").alias("file"), F.lit(0).alias("n"))
    stored = f"{path}-lines"
    with shuffles_dropped(spark):
        lines.select("line", "part").write.option("compression", I.STORED).parquet(stored)
        dealt = spark.read.parquet(stored).select("line", "part", F.pmod(F.hash("line"), F.lit(FLOW_FILES)).alias("file"), F.lit(1).alias("n"))
        (header.unionByName(dealt).repartition("part", "file").sortWithinPartitions("part", "file", "n")
         .select("line", "part", "file").write.partitionBy("part", "file").text(path))
    drop_path(spark, stored)


_EVENT_COLUMNS = ["endereco", "impression_hour", "location_id", "uniques", "numero", "x18_19", "x80_plus", "feminine", "a_class", "de_class"]


def _events_of(star):
    """Each event with its own profile, from the five tables."""
    return _round_doubles(snowflake(star).select(*_EVENT_COLUMNS), ["uniques", "x18_19", "x80_plus", "feminine", "a_class", "de_class"])


def _csv_events_sql(left_out: str) -> str:
    return f"""
select concat(endereco, case when cast(substr(id, 2) as bigint) % 50 in (3, 28) then chr(10) else '' end, '#', id) as endereco, impression_hour, location_id,
  round(case when cast(substr(id, 2) as bigint) % 50 = 21 then 0 else uniques end, 6) as uniques, numero, round(x18_19, 6) as x18_19,
  round(x80_plus, 6) as x80_plus, round(feminine, 6) as feminine, round(a_class, 6) as a_class, round(de_class, 6) as de_class
from j1 where cast(substr(id, 2) as bigint) % 50 not in ({left_out})"""


def _csv_round_trip(spark, sf_dir, mode, lines, names):
    root = scratch_path(spark, f"csv-{mode}")
    _write_flow_csv(spark, lines, names, f"{root}/in")
    I.load_csv(spark, f"{root}/in", f"{root}/wh", mode, drop_source=True)
    return _events_of(read_star(spark, f"{root}/wh"))


def q_csv_lenient(spark, sf_dir):
    """CSV files with short and wide lines, bad numbers and bad
    profiles -> lenient scan -> five tables -> every event with its own profile."""
    return _csv_round_trip(spark, sf_dir, "lenient", *_flow_lines(spark, sf_dir))


QUERIES["csv_lenient_roundtrip"] = (q_csv_lenient, _fixture_sql(_csv_events_sql("7, 13, 33")))


def q_csv_bulk(spark, sf_dir):
    """The same without lines of another length, which fail a bulk load."""
    lines, names = _flow_lines(spark, sf_dir)
    return _csv_round_trip(spark, sf_dir, "bulk", lines.where("kind not in (7, 13)"), names)


QUERIES["csv_bulk_load"] = (q_csv_bulk, _fixture_sql(_csv_events_sql("7, 13, 33")))


def q_ingest_shred(spark, sf_dir):
    """J1 rows -> flow CSV text (python-dict profile) -> quote fix + parse ->
    completeness check -> five tables with content keys -> J1 -> A1.  The parsed and
    keyed rows are stored once; each table is a projection of them."""
    rows = I.to_flow_rows(_j1(spark, sf_dir).withColumn("endereco", F.concat("endereco", F.lit("#"), "id")))
    typed = I.typed_flow(rows).withColumns({"_source_file": F.lit("flow.csv"), "_row_key": F.sha2("endereco", 256)})
    path = scratch_path(spark, "csv-shred")
    I.with_keys(typed, I.bulk_keys()).write.parquet(path)
    return D.demographics(Star(**I.shred(spark.read.parquet(path), I.bulk_keys(), strict=True).tables()), round_to=R6)


QUERIES["ingest_csv_shred"] = (q_ingest_shred, _fixture_sql(f"select count(*) as count, {O.avg_list()} from j1"))


# ---------------------------------------------------------------- streams: T3/K1 and T4/K3/S4 over the test tables
from passante.sources.fixtures import fx_messages  # noqa: E402
from passante.sources.topic import read_envelope_files, write_envelope_files  # noqa: E402
from passante.streaming import archive as AR  # noqa: E402
from passante.streaming import warehouse as WH  # noqa: E402


def q_stream_warehouse(spark, sf_dir):
    """Messages -> JSON files -> file stream (4 files per trigger) ->
    foreachBatch five-table writes -> warehouse read back -> J1 -> A1."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "stream-warehouse")
    write_envelope_files(fx_messages(t), f"{root}/in", 16)
    q = WH.start_warehouse_stream(read_envelope_files(spark, f"{root}/in", max_files_per_trigger=4, drop_read=True),
                                  f"{root}/wh", f"{root}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    drop_path(spark, f"{root}/in")
    return D.demographics(WH.read_warehouse(spark, f"{root}/wh"), round_to=R6)


QUERIES["stream_warehouse_ingest"] = (q_stream_warehouse, _fixture_sql(f"select count(*) as count, {O.avg_list()} from j1"))


def _bad_messages(messages):
    """Spoils some messages, by offset: broken JSON, a number given as text, a null
    field, a bucket with a null value, a bucket that is absent."""
    kind, value = F.col("offset") % 10, F.col("value")
    return messages.withColumn("value", F.when(kind == 1, F.substring(value, 1, 20))
                               .when(kind == 2, F.regexp_replace(value, '"uniques":([-0-9.E]+)', '"uniques":"$1"'))
                               .when(kind == 3, F.regexp_replace(value, '"cidade":"[^"]*"', '"cidade":null'))
                               .when(kind == 4, F.regexp_replace(value, '"80[+]":[-0-9.E]+', '"80+":null'))
                               .when(kind == 5, F.regexp_replace(value, '"DE":[-0-9.E]+', '"other":1.0'))
                               .otherwise(value))


def q_stream_quarantine(spark, sf_dir):
    """Spoiled messages -> one batch -> rows per outcome, and exact sums
    of what was stored."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "stream-quarantine")
    WH.write_batch(_bad_messages(fx_messages(t)), 0, root)
    quarantine = spark.read.parquet(f"{root}/_quarantine")
    bad = quarantine.groupBy("reason").agg(F.count("*").alias("n")).withColumns({"without_city": F.lit(0).cast("bigint"), "x80_plus": F.lit(0.0)})
    good = snowflake(WH.read_warehouse(spark, root)).agg(F.lit("stored").alias("reason"), F.count("*").alias("n"),
                                                         F.sum((F.col("cidade") == "").cast("bigint")).alias("without_city"),
                                                         F.round(F.sum("x80_plus"), 6).alias("x80_plus"))
    return bad.unionByName(good)


QUERIES["stream_quarantine"] = (q_stream_quarantine, _fixture_sql("""
, m as (select g.*, e.kafka_offset % 10 as kind from fx_geodata g join fx_envelope e on g.id = concat('g', cast(e.event_id as varchar)))
, outcome as (select m.*, case when kind = 1 then 'invalid json or not an object' when kind = 2 then 'uniques: not a number'
    when target_id is null then 'profile missing or unparsable' when kind = 5 then 'missing classe_social key DE' else 'stored' end as reason from m)
select reason, count(*) as n, cast(sum(case when reason = 'stored' and kind = 3 then 1 else 0 end) as bigint) as without_city,
  round(sum(case when reason = 'stored' and kind <> 4 then a.x80_plus else 0 end), 6) as x80_plus
from outcome left join fx_target t on outcome.target_id = t.id left join fx_age a on t.age_id = a.id group by reason"""))


def q_stream_view(spark, sf_dir):
    """J3 written by the stream itself -> compare by dominant age band, without a join."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "stream-view")
    WH.write_batch(fx_messages(t), 0, root)
    return D.compare(WH.read_enriched(spark, root), "faixa_etaria", round_to=R6)


QUERIES["stream_enriched_view"] = (q_stream_view, QUERIES["compare_age"][1])


# ---------------------------------------------------------------- T1 / A20 / A21 flushes
from passante.streaming import flush as FL  # noqa: E402

#: A few messages an hour reach a partition of the test topic: production's 500 and 30 seconds are scaled to it.
QUERY_FLUSH = (30, "8 hours")
#: Days after which the messages of a slice arrive.
SLICES = (11, 21)


def _sliced(messages):
    """Slice 0, 1 or 2 of a message, by its day."""
    day = F.dayofmonth("timestamp")
    return messages.withColumn("slice", sum((day >= d).cast("int") for d in SLICES))


def _flush_messages(spark, sf_dir):
    """The topic arrives in three slices; the stream drains each and is started again
    from its checkpoint, so flushes run on across micro-batches and restarts."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "flushes")
    messages = _sliced(fx_messages(t))
    for k in range(len(SLICES) + 1):
        write_envelope_files(messages.where(F.col("slice") == k).drop("slice"), f"{root}/in/slice={k}", 16)
        FL.start_flush_stream(read_envelope_files(spark, f"{root}/in/slice=*"), f"{root}/out", f"{root}/ck", {"availableNow": True},
                              *QUERY_FLUSH).awaitTermination()
    return FL.read_placed(spark, f"{root}/out")


def q_flush_log(spark, sf_dir):
    """Each flush with its events, offsets, reason and the partition's lag."""
    log = FL.flush_log(_flush_messages(spark, sf_dir), QUERY_FLUSH[0])
    return log.select("topic", "partition", "flush", "events", "first_offset", "last_offset",
                      F.date_format("opened", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("opened"), "reason", "lag")


_FLUSH_SQL = f"""
, m as (select topic, kafka_partition as p, kafka_offset as o, kafka_timestamp as ts,
    (day(kafka_timestamp) >= {SLICES[0]})::int + (day(kafka_timestamp) >= {SLICES[1]})::int as slice from fx_envelope)
, started as (
  select p, 0::bigint as flush, min(o) as first_offset from m group by p
  union all
  select s.p, s.flush + 1, min(x.o) from started s join m y on y.p = s.p and y.o = s.first_offset
    join m x on x.p = s.p and x.o > s.first_offset and (x.o >= s.first_offset + {QUERY_FLUSH[0]} or x.ts >= y.ts + interval '{QUERY_FLUSH[1]}')
  group by s.p, s.flush)
, flushes as (select p, flush, first_offset, lead(first_offset) over (partition by p order by flush) as upto from started)
, members as (select f.p, f.flush, f.upto, m.* exclude (p) from flushes f join m on m.p = f.p and m.o >= f.first_offset and (f.upto is null or m.o < f.upto))
, counted as (select topic, p, flush, any_value(upto) as upto, count(*) as events, min(o) as first_offset, max(o) as last_offset, min(ts) as opened, max(slice) as slice
  from members group by topic, p, flush)
select topic, cast(p as int) as partition, flush, events, first_offset, last_offset, strftime(opened, '%Y-%m-%d %H:%M:%S.%f') as opened,
  case when events >= {QUERY_FLUSH[0]} then 'size' when upto is not null then 'time' else 'open' end as reason,
  (select max(m.o) from m where m.p = c.p and m.slice <= c.slice) - last_offset as lag
from counted c"""

QUERIES["flush_log"] = (q_flush_log, _fixture_sql(_FLUSH_SQL).replace("WITH", "WITH RECURSIVE", 1))


def q_batch_counters(spark, sf_dir):
    """What each batch parsed, rejected and stored, as observed while it was
    written; the second batch is delivered twice.  ``stored`` is read back."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "batch-counters")
    _bad_messages(fx_messages(t)).write.parquet(f"{root}/in")  # built once for the three deliveries
    messages = spark.read.parquet(f"{root}/in")
    for batch in (0, 1, 1):
        WH.write_batch(messages.where(F.col("offset") % 3 == 0 if batch == 0 else F.col("offset") % 3 > 0), batch, root)
    counters = WH.read_counters(spark, root).where("counter <> 'milliseconds'")
    stored = [spark.read.parquet(f"{root}/{name}").groupBy("batch_id").agg(F.count("*").alias("value"))
              .select(F.col("batch_id").cast("bigint"), F.lit("geodata").alias("topic"), F.lit("stored").alias("counter"), F.lit(name).alias("label"), "value")
              for name in WH.COUNTED]
    return functools.reduce(DataFrame.unionByName, stored, counters)


QUERIES["batch_counters"] = (q_batch_counters, _fixture_sql("""
, m as (select g.target_id, e.kafka_offset % 10 as kind, (e.kafka_offset % 3 > 0)::bigint as batch_id
    from fx_geodata g join fx_envelope e on g.id = concat('g', cast(e.event_id as varchar)))
, judged as (select batch_id, case when kind = 1 or kind = 2 then 'document' when target_id is null or kind = 5 then 'profile' else 'good' end as outcome from m)
, n as (select batch_id, count(*) as messages, count(*) filter (where outcome = 'document') as document, count(*) filter (where outcome = 'profile') as profile,
    count(*) filter (where outcome = 'good') as good from judged group by batch_id)
select batch_id, 'geodata' as topic, counter, label, value from (
  select batch_id, 'messages' as counter, 'received' as label, messages as value from n
  union all select batch_id, 'messages', 'parsed', good from n
  union all select batch_id, 'rejected', 'document', document from n
  union all select batch_id, 'rejected', 'profile', profile from n
  union all select batch_id, kind, name, good from n,
    (values ('rows'), ('stored')) k(kind), (values ('age'), ('gender'), ('social_class'), ('target'), ('enriched'), ('geodata')) t(name))"""))


def _sketched(spark, sf_dir):
    """Sketches as the ingest stores them, one per day and partition, read back."""
    path = scratch_path(spark, "sketches")
    records = _records(spark, sf_dir).withColumn("day", F.date_format("kafka_timestamp", "yyyy-MM-dd"))
    TM.quantile_sketches(records, ["day", "kafka_partition"], "uniques").write.parquet(path)
    return spark.read.parquet(path)


def q_sketch_panel(spark, sf_dir):
    """Quantiles of uniques per day, from the stored sketches of its partitions."""
    return _round_doubles(TM.sketch_panel(_sketched(spark, sf_dir), ["day"]), ["p50", "p95", "p99"])


QUERIES["uniques_panel_daily"] = (q_sketch_panel, _fixture_sql(
    _REC_CTE + "select strftime(kafka_timestamp, '%Y-%m-%d') as day, " + ", ".join(
        f"round(quantile_disc(uniques, {q}), 6) as {n}" for n, q in TM.PANEL.items()) + ", count(*) as n from rec group by 1"))


def q_archive_daily_flow(spark, sf_dir):
    """Messages -> enriched NDJSON archive (K3) -> partitioned scan (S4) ->
    Σuniques per day folder."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "archive")
    AR.write_archive_batch(fx_messages(t), 0, root)
    lines = AR.read_archive(spark, root)
    rec = lines.select("year", "month", "day",
                       F.from_json("value", "struct<uniques double, _kafka_offset bigint>").alias("r"))
    return _round_doubles(
        rec.groupBy(F.format_string("%04d-%02d-%02d", "year", "month", "day").alias("day"))
        .agg(F.sum("r.uniques").alias("flow")), ["flow"])


QUERIES["archive_daily_flow"] = (q_archive_daily_flow, QUERIES["people_per_day"][1])


ARCHIVE_DAY = dt.date(2024, 1, 10)


def q_archive_one_day(spark, sf_dir):
    """The archive stream in four triggers -> the manifest's folders of one
    day -> compacted files -> each line's place, values and metadata (N5)."""
    t, _ = _ctx(spark, sf_dir)
    root = scratch_path(spark, "archive-day")
    write_envelope_files(fx_messages(t), f"{root}/in", 16)
    AR.start_archive_stream(read_envelope_files(spark, f"{root}/in", max_files_per_trigger=4), f"{root}/archive", f"{root}/ck",
                            {"availableNow": True}).awaitTermination()
    AR.compact_day(spark, f"{root}/archive", f"{root}/out", ARCHIVE_DAY)
    record = ("_kafka_partition int, _kafka_offset bigint, _kafka_timestamp string, location_id bigint, uniques double, "
              "target struct<genero: struct<F: double>>")
    lines = spark.read.text(f"{root}/out/daily").select(F.from_json("value", record).alias("r"))
    return _round_doubles(lines.select(F.col("r._kafka_partition").alias("partition"), F.col("r._kafka_offset").alias("offset"),
                                       F.col("r._kafka_timestamp").alias("kafka_timestamp"), "r.location_id", "r.uniques",
                                       F.col("r.target.genero.F").alias("feminine")), ["uniques", "feminine"])


QUERIES["archive_one_day"] = (q_archive_one_day, _fixture_sql(f"""
select cast(kafka_partition as int) as partition, kafka_offset as "offset", strftime(date_trunc('second', kafka_timestamp), '%Y-%m-%dT%H:%M:%SZ') as kafka_timestamp,
  location_id, round(uniques, 6) as uniques, round(x.feminine, 6) as feminine
from fx_envelope e join fx_geodata g on g.id = concat('g', cast(e.event_id as varchar))
  left join fx_target t on g.target_id = t.id left join fx_gender x on t.gender_id = x.id
where cast(kafka_timestamp as date) = date '{ARCHIVE_DAY}'"""))


# ---------------------------------------------------------------- F15 / F10 / F11 / J8 / T9 / T10
from passante.operators import embeddings as EM  # noqa: E402
from passante.operators.filters import bounding_box  # noqa: E402
from passante.plans.datasets import ingest_summary  # noqa: E402
from passante.streaming import live as LV  # noqa: E402


@register("ingest_contract_summary", """
select count(*) as records, min(impression_hour) as min_hour, max(impression_hour) as max_hour,
  count(distinct location_id) as locations,
  count(case when impression_hour is null or impression_hour not between 0 and 23 then 1 end) as bad_hours,
  count(case when try_cast(latitude as double) is null or try_cast(longitude as double) is null
              or try_cast(latitude as double) not between -90 and 90
              or try_cast(longitude as double) not between -180 and 180 then 1 end) as bad_coordinates
from fx_geodata""")
def q_ingest_summary(spark, sf_dir):
    _, star = _ctx(spark, sf_dir)
    return ingest_summary(star.geodata)


BBOX = (-23.60, -23.50, -46.70, -46.60)


@register("bbox_night_points", f"""
select id, location_id, impression_hour, round(uniques, 6) as uniques from enriched
where latitude between {BBOX[0]} and {BBOX[1]} and longitude between {BBOX[2]} and {BBOX[3]}
  and (impression_hour >= 22 or impression_hour <= 5)""")
def q_bbox_night(spark, sf_dir):
    f = GeoFilters(hour_range=(22, 5))
    df = f.apply(_en(spark, sf_dir)).where(bounding_box(*BBOX))
    return _round_doubles(df.select("id", "location_id", "impression_hour", "uniques"), ["uniques"])


def q_nested_summary(spark, sf_dir):
    """N9, read back through its nested fields."""
    nested = D.nested_summary(D.compare(_j1(spark, sf_dir), "genero", round_to=R6))
    return nested.select("label", "count", "age.*", "gender.*", "social_class.*")


QUERIES["compare_gender_nested"] = (q_nested_summary, QUERIES["compare_gender"][1])


def q_embedding_topk(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return _round_doubles(EM.centroid_topk(t.embeddings, 5), ["score"])


QUERIES["embedding_centroid_topk"] = (q_embedding_topk, _fixture_sql("""
, e as (select vec_id, label, cast(embedding as double[]) as v from embeddings)
, x as (select label, i, v[i] as xi from e, range(1, 65) r(i))
, c as (select label, i, avg(xi) as m from x group by label, i)
, cv as (select label, list(m order by i) as cen from c group by label)
, s as (select e.vec_id, e.label,
          list_dot_product(e.v, cv.cen) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(cv.cen, cv.cen))) as score
        from e join cv on e.label = cv.label)
select label, vec_id, round(score, 6) as score, rank from (
  select *, row_number() over (partition by label order by score desc, vec_id) as rank from s) z where rank <= 5"""))


def _live(spark, sf_dir, which):
    """Six triggers with a snapshot every two; the last one is delivered again."""
    t, _ = _ctx(spark, sf_dir)
    root, keys = scratch_path(spark, f"live-{which}"), LV.KEYS[which]
    write_envelope_files(fx_messages(t), f"{root}/in", 24)
    q = LV.start_live(read_envelope_files(spark, f"{root}/in", max_files_per_trigger=4), f"{root}/out",
                      which, f"{root}/ck", trigger={"availableNow": True}, every=2)
    q.awaitTermination()
    again = scratch_path(spark, f"live-{which}-replayed")
    spark.read.parquet(f"{root}/out/deltas/batch_id=5").write.parquet(again)
    LV.upsert_batch(spark.read.parquet(again), 5, f"{root}/out", keys, every=2)
    return LV.read_current(spark, f"{root}/out", keys)


def q_live_flow(spark, sf_dir):
    return _round_doubles(_live(spark, sf_dir, "flow"), ["flow"])


QUERIES["live_location_hour_flow"] = (q_live_flow, _fixture_sql(
    "select location_id, impression_hour, round(sum(uniques), 6) as flow, count(*) as events "
    "from fx_geodata group by 1, 2"))


def q_live_latest(spark, sf_dir):
    df = _live(spark, sf_dir, "latest")
    return _round_doubles(df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
                          ["uniques"])


QUERIES["live_latest_per_location"] = (q_live_latest, _fixture_sql(_REC_CTE + """
select location_id, strftime(arg_max(kafka_timestamp, (kafka_timestamp, kafka_offset, kafka_partition)), '%Y-%m-%d %H:%M:%S.%f') as timestamp,
  cast(arg_max(kafka_partition, (kafka_timestamp, kafka_offset, kafka_partition)) as integer) as partition,
  arg_max(kafka_offset, (kafka_timestamp, kafka_offset, kafka_partition)) as offset,
  arg_max(impression_hour, (kafka_timestamp, kafka_offset, kafka_partition)) as impression_hour,
  round(arg_max(uniques, (kafka_timestamp, kafka_offset, kafka_partition)), 6) as uniques,
  arg_max(latitude, (kafka_timestamp, kafka_offset, kafka_partition)) as latitude,
  arg_max(longitude, (kafka_timestamp, kafka_offset, kafka_partition)) as longitude,
  arg_max(endereco, (kafka_timestamp, kafka_offset, kafka_partition)) as endereco
from rec group by location_id"""))


# ---------------------------------------------------------------- F7 standalone, H3 standalone
from passante.functions.columns import bbox_predicate, haversine_m  # noqa: E402

RADIUS_CENTER = (-23.5505, -46.6333, 2000.0)


def q_radius_filter(spark, sf_dir):
    """events within 2 km of a centre (bounding box first, then the exact
    haversine test), with their distance."""
    lat, lon, r = RADIUS_CENTER
    en = _en(spark, sf_dir)
    d = haversine_m("latitude", "longitude", lat, lon)
    out = (en.where(F.col("latitude").isNotNull() & bbox_predicate("latitude", "longitude", lat, lon, r))
           .withColumn("distance_m", d).where(F.col("distance_m") <= F.lit(r))
           .select("id", "location_id", "distance_m"))
    return _round_doubles(out, ["distance_m"])


QUERIES["radius_filter"] = (q_radius_filter, _fixture_sql(f"""
select id, location_id, round({O.haversine_sql('latitude', 'longitude', repr(RADIUS_CENTER[0]), repr(RADIUS_CENTER[1]))}, 6) as distance_m
from enriched where latitude is not null
  and {O.haversine_sql('latitude', 'longitude', repr(RADIUS_CENTER[0]), repr(RADIUS_CENTER[1]))} <= {RADIUS_CENTER[2]!r}"""))


def q_hex_domain(spark, sf_dir):
    return G.density_domain(_hexbin_df(spark, sf_dir))


QUERIES["hex_density_domain"] = (q_hex_domain, _fixture_sql(
    _PTS_CTE + _hex_cte("pts", HEX_R) + """
, bins as (select q, s, count(*) as n from hx_cell group by q, s)
select cast(min(n) as double) as domain_min, cast(max(n) as double) as domain_max from bins"""))


# ---------------------------------------------------------------- A5 other compare modes
_MODE_PRED = {
    "gender": {"feminino": "feminine > 0.5", "masculino": "masculine > 0.5"},
    "socialClass": {"a": "a_class > 0.3", "b1": "b1_class > 0.3", "b2": "b2_class > 0.3",
                    "c1": "c1_class > 0.3", "c2": "c2_class > 0.3", "de": "de_class > 0.3"},
}


def _segment_mode_sql(mode: str, limit: int = SG.CARD_LIMIT) -> str:
    blocks = [f"select '{v}' as segment, id, try_cast(latitude as double) as latitude, "
              f"try_cast(longitude as double) as longitude, uniques as value, location_id from j1 "
              f"where try_cast(latitude as double) is not null and try_cast(longitude as double) is not null "
              f"and {pred}" for v, pred in _MODE_PRED[mode].items()]
    return ("\n, seg_all as (" + "\nunion all\n".join(blocks) + ")\n"
            "select segment, id, latitude, longitude, value, location_id from (select *, row_number() over "
            f"(partition by segment order by id) as rn from seg_all) z where rn <= {limit}")


def _segments_mode(mode):
    def fn(spark, sf_dir):
        _ctx(spark, sf_dir)
        return SG.segment_points(_j1(spark, sf_dir), mode)
    return fn


QUERIES["segment_grid_gender"] = (_segments_mode("gender"), _fixture_sql(_segment_mode_sql("gender")))
QUERIES["segment_grid_class"] = (_segments_mode("socialClass"), _fixture_sql(_segment_mode_sql("socialClass")))
