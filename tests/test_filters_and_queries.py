"""Filter compiler (F1-F6, F11), compare labels (A3, A4), limits (L1),
campaign helpers (A7) -- ported table-driven cases plus brute-force checks."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from passante.operators import campaign as C
from passante.operators import demographics as D
from passante.operators.filters import GeoFilters, clamp_limit, parse_hours
from passante.plans.model import enriched, snowflake


def test_parse_hours_and_limits():
    assert parse_hours(["00", "7", "23", "24", "-1", "x", " 05"]) == [0, 7, 23, 5]
    assert clamp_limit(0) == 5000 and clamp_limit(-3) == 5000 and clamp_limit(None) == 5000
    assert clamp_limit(20000) == 10000 and clamp_limit(42) == 42


def test_unknown_values_impose_no_condition(star):
    j = snowflake(star)
    n_all = j.count()
    assert GeoFilters(genero=("x",), faixa_etaria=("??",), classe_social=("zz",)).apply(j).count() == n_all
    assert GeoFilters(horario=("99", "ab")).apply(j).count() == n_all


def test_filters_match_pandas(star):
    pdf = snowflake(star).toPandas()
    f = GeoFilters(uf_estado=("ASIA", "EUROPE"), horario=("01", "02", "03"),
                   genero=("masculino",), faixa_etaria=("50+", "18-19"), classe_social=("c",))
    got = f.apply(snowflake(star)).count()
    m = (pdf.uf_estado.isin(["ASIA", "EUROPE"]) & pdf.impression_hour.isin([1, 2, 3]) & (pdf.masculine > 0.5)
         & (((pdf.x50_59 + pdf.x60_69 + pdf.x70_79 + pdf.x80_plus) > 0.15) | (pdf.x18_19 > 0.15))
         & ((pdf.c1_class + pdf.c2_class) > 0.3))
    assert got == int(m.sum())


def test_hour_range_wraps(star):
    j = snowflake(star)
    a = GeoFilters(hour_range=(22, 2)).apply(j).count()
    b = j.where(F.col("impression_hour").isin([22, 23, 0, 1, 2])).count()
    assert a == b


def test_null_target_events_vanish(star):
    n_geo = star.geodata.count()
    n_null = star.geodata.where(F.col("target_id").isNull()).count()
    assert n_null > 0
    assert snowflake(star).count() == n_geo - n_null


def test_compare_labels_first_wins(spark):
    from passante.functions.columns import dominant_label
    from passante.schemas import CLASS_COLUMNS, CLASS_FILTER_LABELS
    rows = [(0.3, 0.3, 0.1, 0.1, 0.1, 0.1), (0.1, 0.1, 0.1, 0.1, 0.1, 0.5), (0.2, 0.2, 0.2, 0.2, 0.2, 0.2)]
    df = spark.createDataFrame(rows, CLASS_COLUMNS)
    got = [r[0] for r in df.select(dominant_label(CLASS_COLUMNS, CLASS_FILTER_LABELS)).collect()]
    assert got == ["a", "de", "a"]


def test_invalid_group_by_is_error(star):
    with pytest.raises(ValueError):
        D.compare(star, "nope")


def test_points_limit_and_order(star):
    pts = D.geo_points(star, limit=7).collect()
    assert len(pts) == 7
    ids = [p["id"] for p in pts]
    assert ids == sorted(ids)


def test_empty_demographics_returns_nulls(star):
    r = D.demographics(star, GeoFilters(uf_estado=("NOWHERE",))).first()
    assert r["count"] == 0 and r["x18_19"] is None


@pytest.mark.parametrize("lo,hi,want", [
    (18, 19, ["age_18_19_count"]),
    (18, 120, ["age_18_19_count", "age_20_29_count", "age_30_39_count", "age_40_49_count",
               "age_50_59_count", "age_60_69_count", "age_70_79_count", "age_80_plus_count"]),
    (25, 45, ["age_20_29_count", "age_30_39_count", "age_40_49_count"]),
    (19, 20, ["age_18_19_count", "age_20_29_count"]),
    (50, 10, []),
    (0, 10, []),
])
def test_age_band_overlap(lo, hi, want):
    assert C.selected_columns(C.CampaignSpec(age_min=lo, age_max=hi)) == {"gender": [], "age": want, "class": []}


def test_selected_codes():
    def classes(*codes):
        return C.selected_columns(C.CampaignSpec(classes=codes))["class"]

    assert classes("A", "B1") == ["class_a_count", "class_b1_count"]
    assert len(classes("A", "B1", "B2", "C1", "C2", "DE")) == 6
    assert classes("X", "Z") == classes() == []
    assert classes("A", "X", "c2") == ["class_a_count", "class_c2_count"]
    assert classes("de", "b2") == ["class_b2_count", "class_de_count"]
    assert [C.selected_columns(C.CampaignSpec(gender=g))["gender"] for g in ("Female", "MALE", "x", None)] == [["feminine_count"], ["masculine_count"], [], []]


def test_campaign_matches_pandas(star):
    spec = C.CampaignSpec(gender="female", age_min=25, age_max=45, classes=("a", "B1"), limit=5)
    got = C.analyze_campaign(enriched(star), spec).toPandas()
    e = enriched(star).toPandas()
    g = e.groupby(["location_id", "endereco", "numero", "cidade"], dropna=False).agg(
        u=("uniques", "sum"), f=("feminine_count", "sum"),
        a=("age_20_29_count", "sum"), a2=("age_30_39_count", "sum"), a3=("age_40_49_count", "sum"),
        c=("class_a_count", "sum"), c2=("class_b1_count", "sum")).reset_index()
    g["aff"] = (g.f / g.u) * ((g.a + g.a2 + g.a3) / g.u) * ((g.c + g.c2) / g.u) * 100
    want = g.sort_values(["aff", "location_id"], ascending=[False, True]).head(5)
    assert list(got.location_id) == list(want.location_id)
    assert list(got["rank"]) == [1, 2, 3, 4, 5]
    assert (got.affinity.round(9).values == want.aff.round(9).values).all()


def test_campaign_defaults_and_present(star):
    spec = C.CampaignSpec(radius_km=None, limit=None)
    assert spec.radius_m == 2000.0 and spec.k == 10
    df = C.present(C.analyze_campaign(enriched(star), spec))
    r = df.first()
    assert r["affinity"] == pytest.approx(100.0)


def test_multi_campaign_fallback(star):
    city = enriched(star).orderBy("id").first()["cidade"]
    specs = [C.CampaignSpec(city="atlantis", limit=2, campaign_id="x"),
             C.CampaignSpec(city=city.lower(), limit=2, campaign_id="y")]
    out = C.multi_campaign(enriched(star), specs).toPandas()
    x, y = out[out.campaign_id == "x"], out[out.campaign_id == "y"]
    assert len(x) == 2 and not x.city_found.any()
    assert len(y) >= 1 and (y.cidade == city).all() and y.city_found.all()
    single = C.analyze_campaign(enriched(star), C.CampaignSpec(city=city.lower(), limit=2)).toPandas()
    assert list(single.location_id) == list(y.location_id)
    strict = C.multi_campaign(enriched(star), specs, city_fallback=False).toPandas()
    assert set(strict.campaign_id) == {"y"} and list(strict.location_id) == list(y.location_id)
    assert C.multi_campaign(enriched(star), specs[:1], city_fallback=False).count() == 0
