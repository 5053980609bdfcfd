"""Geo and dashboard invariants, each against a brute-force computation."""
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from passante.operators import bi as B
from passante.operators import geo as G
from passante.operators import segments as SG
from passante.operators.demographics import point_rows
from passante.plans.model import enriched, snowflake
from passante.sources.fixtures import fx_screens

R = 6371010.0


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * R * math.asin(min(1.0, math.sqrt(h)))


def test_hex_radius_curve():
    assert G.hex_radius_m(5) == pytest.approx(362.0859, abs=1e-3)
    assert G.hex_radius_m(0.2) == 120 and G.hex_radius_m(99) == 3000


def test_hexbin_counts_sum_to_input(star):
    pts = point_rows(star)
    bins = G.hexbin(pts, G.hex_radius_m(5))
    assert bins.agg(F.sum("n")).first()[0] == pts.count()
    dom = G.density_domain(bins).first()
    assert dom["domain_min"] <= dom["domain_max"]
    cls = G.color_class(bins, G.density_domain(bins)).agg(F.min("color_class"), F.max("color_class")).first()
    assert cls[0] == 0 and cls[1] == 5


def test_hex_cell_is_nearest_centre(star):
    """Every point's hexagon centre is the closest centre among neighbours."""
    r = 500.0
    pts = point_rows(star).limit(300)
    q, s = G.hex_axial(F.col("latitude"), F.col("longitude"), r)
    lon, lat = G.hex_center(q, s, r)
    df = pts.select("latitude", "longitude", q.alias("q"), s.alias("s")).toPandas()
    c0 = math.cos(math.radians(G.HEX_REFERENCE_LAT))
    for row in df.itertuples():
        x = R * math.radians(row.longitude) * c0
        y = R * math.radians(row.latitude)

        def centre(qq, ss):
            return r * (math.sqrt(3) * qq + math.sqrt(3) / 2 * ss), r * 1.5 * ss
        best = min(((qq, ss) for qq in range(row.q - 2, row.q + 3) for ss in range(row.s - 2, row.s + 3)),
                   key=lambda c: (centre(*c)[0] - x) ** 2 + (centre(*c)[1] - y) ** 2)
        assert best == (row.q, row.s)


def test_radius_join_equals_all_pairs(tables, star):
    loc = G.location_profile(enriched(star)).select(
        "location_id", F.col("latitude").alias("loc_lat"), F.col("longitude").alias("loc_lon"))
    got = G.radius_join(fx_screens(tables), loc, 1500.0, "latitude", "longitude", "loc_lat", "loc_lon")
    got = {(r.screen_id, r.location_id) for r in got.collect()}
    sc = fx_screens(tables).toPandas()
    lc = loc.toPandas().dropna()
    want = {(a.screen_id, b.location_id) for a in sc.itertuples() for b in lc.itertuples()
            if hav(a.latitude, a.longitude, b.loc_lat, b.loc_lon) <= 1500.0}
    assert got == want and len(got) > 0


def test_enrichment_covers_every_screen(spark):
    from conftest import SF_MID
    from passante.sources.fixtures import fixture_star
    from passante.sources.testdata import Tables
    tables = Tables(spark, SF_MID)
    star = fixture_star(tables)
    out = G.enrich_screens(fx_screens(tables), enriched(star)).toPandas()
    assert {"exact", "fallback"} <= set(out.match_type)
    assert len(out) == fx_screens(tables).count()
    assert out.p_18_19.notna().all()
    assert set(out.match_type) <= {"exact", "fallback", "global_avg"}
    assert "global_avg" in set(out.match_type)
    s = out[["p_f", "p_m"]].sum(axis=1)
    assert ((s - 1).abs() < 1e-9).all()


def test_joint_rows_sum_to_uniques(star):
    j = B.joint_distribution(enriched(star), keep=["id", "uniques"])
    per = j.groupBy("id", "uniques").agg(F.sum("joint_count").alias("s"), F.count("*").alias("k")).toPandas()
    assert (per.k == 96).all()
    assert ((per.s - per.uniques).abs() < 1e-9).all()


def test_joint_label_filter_prunes_before_explode(star):
    j = B.joint_distribution(enriched(star), classes=["A"], genders=["Masculine"], ages=["80+", "18-19"])
    assert j.select("class_label", "gender_label", "age_label").distinct().count() == 2
    with pytest.raises(ValueError):
        B.joint_distribution(enriched(star), classes=["nope"])


def test_long_form_triples_rows(star):
    e = enriched(star)
    lf = B.long_form(e)
    assert lf.count() == 16 * e.count()
    totals = lf.groupBy("tipo").agg(F.sum("valor").alias("v")).toPandas().set_index("tipo").v
    assert totals["class"] == pytest.approx(totals["gender"], rel=1e-9)


def test_segment_cap_and_overlap(star):
    pts = SG.segment_points(snowflake(star), "age", limit=50).toPandas()
    assert pts.groupby("segment").size().max() <= 50
    assert SG.compare_values("gender", [" feminino", "feminino", "masculino", "x"]) == ["feminino", "masculino"]
    assert SG.compare_values("age", None)[0] == "18-19"


def test_conversation_budget_matches_python(spark, tables):
    from passante.operators.conversation import conversation_budget
    ctx = 400
    got = conversation_budget(tables.conversations, context=ctx).toPandas().set_index("conv_id")
    conv = tables.conversations.toPandas().sort_values(["conv_id", "turn"])
    thr = int(ctx * 0.75)
    for cid, g in conv.groupby("conv_id"):
        toks = [len(t or "") // 4 for t in g.text]
        roles = list(g.role)
        total = sum(toks)
        split = 0
        if total > thr:
            users = [i for i, r in enumerate(roles) if r == "user"]
            for keep in (3, 2, 1):
                if keep > len(users):
                    continue
                cand = users[-keep]
                if sum(toks[cand:]) <= thr:
                    split = cand
                    break
        assert got.loc[cid, "n_marked"] == split, cid
        assert got.loc[cid, "total_tokens"] == total


def test_area_compare_shape(star):
    out = B.area_compare(enriched(star), (-23.5505, -46.6333, 9000.0), (-23.50, -46.60, 9000.0)).toPandas()
    assert len(out) == 6
