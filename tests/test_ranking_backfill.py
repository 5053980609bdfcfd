import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from passante.functions.ranking import ranked
from passante.operators import demographics as D
from passante.plans.model import snowflake, snowflake_bucketed, store_bucketed


@pytest.mark.parametrize("parts", [2, 7, 200])
def test_ranks_equal_a_window_per_group(spark, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", None]), rnd.choice([None, 0.0, 0.0, 1.5, rnd.random(), rnd.randrange(5) / 2]), k) for k in range(1200)]
    table = spark.createDataFrame([(g, s, None if k == 7 else k) for g, s, k in rows], "g string, s double, k bigint")
    want = table.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(F.col("s").desc_nulls_last(), F.col("k").asc_nulls_first())))
    got = ranked(table, ["g"], "s", "k", parts)
    key = ["g", "s", "k", "rank"]
    assert sorted(map(repr, got.select(*key).collect())) == sorted(map(repr, want.select(*key).collect()))
    assert ranked(table.limit(0), ["g"], "s", "k", parts).count() == 0


def test_no_range_holds_a_hot_group_or_score(spark):
    table = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("x").alias("g"),
                                       F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.rand(1)).alias("s"), F.col("id").alias("k"))
    plan = ranked(table, ["g"], "s", "k", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "__area" in plan and "__sub" in plan
    table = table.persist()
    at = table.agg(F.percentile_approx("s", [k / 50 for k in range(1, 50)], 5000)).first()[0]
    assert at.count(0.0) > 10  # the frequent score is a quantile, and so a range of its own
    table.unpersist()


def test_stored_buckets_join_without_exchange(spark, star, tmp_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = store_bucketed(star, tmp_dir, 8, "backfill_test")
        joined = snowflake_bucketed(spark, names)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 4 and "Exchange" not in plan
        compared = D.compare(joined, "faixa_etaria", round_to=6)
        below = compared._jdf.queryExecution().executedPlan().toString().split("partial_", 1)[1]
        assert "Exchange" not in below
        assert sorted(compared.collect()) == sorted(D.compare(snowflake(star), "faixa_etaria", round_to=6).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("geodata", "target", "age", "gender", "social_class"):
            spark.sql(f"drop table if exists backfill_test_{name}")
