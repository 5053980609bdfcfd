"""DuckDB oracle SQL for the registered queries.

Every statement starts from the base views (``events customer nation
region supplier conversations ...``) and rebuilds the warehouse model with
the same arithmetic as ``passante.sources.fixtures``; the query body then
states the operator's semantics in plain SQL.
"""

from __future__ import annotations

from passante.schemas import (
    AGE_COLUMNS, AGE_COUNT_COLUMNS, CLASS_COLUMNS, CLASS_COUNT_COLUMNS, GENDER_COLUMNS,
    SHARE_COLUMNS, SHARE_TO_COUNT,
)

FIXTURE_CTES = """
fx_geodata AS (
  select concat('g', cast(e.event_id as varchar)) as id,
    cast(hour(e.ts) as bigint) as impression_hour, e.user_id as location_id, e.value as uniques,
    case when e.user_id % 50 = 49 then '-23.550.520'
         else cast(cast(-235505 + (e.user_id * 37) % 2001 - 1000 as double) / 10000 as varchar) end as latitude,
    case when e.user_id % 50 = 49 then '-46.633.308'
         else cast(cast(-466333 + (e.user_id * 53) % 2001 - 1000 as double) / 10000 as varchar) end as longitude,
    r.r_name as uf_estado, n.n_name as cidade, c.c_name as endereco,
    cast(e.user_id % 900 + 1 as bigint) as numero,
    case when e.event_id % 97 = 96 then null else concat('t', cast(e.event_id as varchar)) end as target_id
  from events e join customer c on e.user_id = c.c_custkey
    join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
),
fx_target AS (
  select concat('t', cast(event_id as varchar)) as id, concat('a', cast(event_id as varchar)) as age_id,
    concat('x', cast(event_id as varchar)) as gender_id, concat('s', cast(event_id as varchar)) as social_class_id
  from events
),
fx_age AS (
  select id, cast(w1 as double)/s as x18_19, cast(w2 as double)/s as x20_29, cast(w3 as double)/s as x30_39,
    cast(w4 as double)/s as x40_49, cast(w5 as double)/s as x50_59, cast(w6 as double)/s as x60_69,
    cast(w7 as double)/s as x70_79, cast(w8 as double)/s as x80_plus
  from (select id, w1, w2, w3, w4, w5, w6, w7, w8, w1+w2+w3+w4+w5+w6+w7+w8 as s
    from (select concat('a', cast(event_id as varchar)) as id, 1+(event_id*3)%17 as w1, 1+(event_id*5)%17 as w2,
      1+(event_id*7)%17 as w3, 1+(event_id*9)%17 as w4, 1+(event_id*11)%17 as w5, 1+(event_id*13)%17 as w6,
      1+(event_id*15)%17 as w7, 1+(event_id*19)%17 as w8 from events) q) p
),
fx_gender AS (
  select concat('x', cast(event_id as varchar)) as id, cast(30 + (event_id*7)%41 as double)/100 as feminine,
    cast(70 - (event_id*7)%41 as double)/100 as masculine
  from events
),
fx_social_class AS (
  select id, cast(w1*w1 as double)/s as a_class, cast(w2*w2 as double)/s as b1_class, cast(w3*w3 as double)/s as b2_class,
    cast(w4*w4 as double)/s as c1_class, cast(w5*w5 as double)/s as c2_class, cast(w6*w6 as double)/s as de_class
  from (select id, w1, w2, w3, w4, w5, w6, w1*w1+w2*w2+w3*w3+w4*w4+w5*w5+w6*w6 as s
    from (select concat('s', cast(event_id as varchar)) as id, 1+(event_id*5)%13 as w1, 1+(event_id*7)%13 as w2,
      1+(event_id*9)%13 as w3, 1+(event_id*11)%13 as w4, 1+(event_id*15)%13 as w5, 1+(event_id*17)%13 as w6 from events) q) p
),
fx_screens AS (
  select s_suppkey as screen_id,
    case when s_suppkey % 20 = 19 then cast(0 as double) else cast(-235505 + (s_suppkey * 91) % 2001 - 1000 as double) / 10000 end as latitude,
    case when s_suppkey % 20 = 19 then cast(0 as double) else cast(-466333 + (s_suppkey * 77) % 2001 - 1000 as double) / 10000 end as longitude
  from supplier
),
fx_envelope AS (
  select 'geodata' as topic, cast(event_id % 4 as bigint) as kafka_partition,
    cast(floor(event_id / 4) as bigint) as kafka_offset, ts as kafka_timestamp,
    max(cast(floor(event_id / 4) as bigint)) over (partition by event_id % 4, time_bucket(interval '6 hours', ts)) as high_watermark, event_id
  from events
),
j1 AS (
  select g.*, gen.feminine, gen.masculine,
    a.x18_19, a.x20_29, a.x30_39, a.x40_49, a.x50_59, a.x60_69, a.x70_79, a.x80_plus,
    sc.a_class, sc.b1_class, sc.b2_class, sc.c1_class, sc.c2_class, sc.de_class
  from fx_geodata g join fx_target t on g.target_id = t.id
    join fx_gender gen on t.gender_id = gen.id join fx_age a on t.age_id = a.id
    join fx_social_class sc on t.social_class_id = sc.id
),
enriched AS (
  select id, impression_hour, location_id, uniques,
    try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
    uf_estado, cidade, endereco, numero, target_id,
    {shares},
    {counts}
  from j1
)
""".format(
    shares=", ".join(SHARE_COLUMNS),
    counts=", ".join(f"{c} * uniques as {SHARE_TO_COUNT[c]}" for c in SHARE_COLUMNS),
)


def with_fixtures(body: str) -> str:
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body.strip()


def avg_list(prefix: str = "", round_to: int = 6) -> str:
    return ", ".join(f"round(avg({prefix}{c}), {round_to}) as {c}" for c in SHARE_COLUMNS)


def dominant_sql(cols: list[str], labels: list[str]) -> str:
    parts = []
    for i, (c, lab) in enumerate(zip(cols[:-1], labels[:-1])):
        others = ", ".join(o for j, o in enumerate(cols) if j != i)
        parts.append(f"when {c} >= greatest({others}) then '{lab}'")
    return "case " + " ".join(parts) + f" else '{labels[-1]}' end"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * 6371010.0 * asin(least(1.0, sqrt("
            f"pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)))))")


AGE_COUNTS = AGE_COUNT_COLUMNS
CLASS_COUNTS = CLASS_COUNT_COLUMNS
__all__ = ["with_fixtures", "avg_list", "dominant_sql", "haversine_sql", "AGE_COLUMNS",
           "CLASS_COLUMNS", "GENDER_COLUMNS"]
