import random

import pytest
from pyspark.sql import functions as F

from passante.operators import campaign as C
from passante.operators import campaign_table as CT
from passante.plans.model import enriched


def specs_of(n, seed=4):
    rnd = random.Random(seed)
    for k in range(n):
        point = rnd.random() < 0.4
        yield C.CampaignSpec(
            gender=rnd.choice([None, "female", "Male", "x"]), age_min=rnd.choice([None, 18, 25, 60]), age_max=rnd.choice([None, 19, 45, 120]),
            classes=rnd.choice([None, (), ("A",), ("b1", "DE", "zz")]), city=rnd.choice([None, None, "", f"nation_{rnd.randrange(25)}", "NATION_7", "atlantis"]),
            endereco=rnd.choice([None, None, "customer#00000000_", "%1%"]), latitude=-23.55 + rnd.uniform(-.1, .1) if point else None,
            longitude=-46.63 + rnd.uniform(-.1, .1) if point else rnd.choice([None, -46.6]), radius_km=rnd.choice([None, 0.0, 0.3, 2.0, 9.0, 40000.0]),
            limit=rnd.choice([None, 0, 1, 7]), campaign_id=f"c{k}")


COLUMNS = ["campaign_id", "city_found", "rank", "location_id", "endereco_ref", "total_flow", "affinity", "target_audience", "latitude"]


def rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("fallback", [True, False])
def test_equals_the_campaigns_as_expressions(spark, star, fallback):
    specs = list(specs_of(60))
    data = enriched(star).persist()
    table = spark.createDataFrame([CT.spec_row(s) for s in specs], CT.SPEC_SCHEMA)
    got, want = rows(CT.rank_campaigns(data, table, fallback)), rows(C.multi_campaign(data, specs, fallback))
    assert [r[0] for r in got] == [r[0] for r in want] and got == want
    data.unpersist()


def test_ten_thousand_campaigns_have_the_plan_of_ten(spark, star):
    specs = [CT.spec_row(s) for s in specs_of(10_000)]
    data = enriched(star).persist()
    few, many = (CT.rank_campaigns(data, spark.createDataFrame(specs[:n], CT.SPEC_SCHEMA)) for n in (10, 10_000))
    size = [df._jdf.queryExecution().optimizedPlan().toString().count("\n") for df in (few, many)]
    assert size[0] == size[1]
    plan = many._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    found = {r.campaign_id: r.n for r in many.groupBy("campaign_id").agg(F.count("*").alias("n")).collect()}
    of = {s[0]: s for s in specs}
    assert all(n <= (of[c][-1] or C.DEFAULT_TOP_K) for c, n in found.items()) and len(found) > 5000
    data.unpersist()
