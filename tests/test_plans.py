"""Plan-shape checks: no Python UDFs and no cartesian / nested-loop joins in
any registered query; pushdown and pruning reach the Parquet scan of the
materialised enriched view."""
import pytest

from passante.registry import QUERIES

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas"]
# these run a stream or write files while building their plan; covered elsewhere
SIDE_EFFECTS = {"stream_warehouse_ingest", "archive_daily_flow", "live_location_hour_flow",
                "live_latest_per_location", "csv_lenient_roundtrip", "csv_bulk_load", "stream_quarantine",
                "stream_enriched_view", "batch_counters", "flush_log", "archive_one_day", "compare_age_backfill", "uniques_panel_daily"}


# the operators whose plans combine aggregates, joins, generators and top-k
# (tools/oracle_check.py-style full scans of every query take minutes)
PLAN_SAMPLE = ["compare_age", "coverage_metadata", "campaign_topk_multi", "hex_color_classes",
               "radius_join", "screen_enrichment", "centre_ranking", "segment_density_domain",
               "joint_distribution", "class_share", "area_compare", "conversation_budget",
               "embedding_centroid_topk", "place_reach", "place_search", "campaign_topk_table", "partition_lag"]


@pytest.mark.parametrize("name", PLAN_SAMPLE)
def test_plan_has_no_udf_or_cross_join(spark, name):
    from conftest import SF_SMALL
    plan = QUERIES[name][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in FORBIDDEN if b in plan], plan[:2000]


@pytest.mark.parametrize("name", ["segment_grid", "segment_grid_gender", "embedding_centroid_topk", "campaign_topk_multi", "conversation_budget"])
def test_ranks_are_limited_before_their_shuffles(spark, name):
    """Both stages of a salted top-k keep k rows per task before they shuffle."""
    from conftest import SF_SMALL
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert sum("Partial" in line for line in limits) >= 2, plan[:3000]


def test_analytics_on_the_stored_view_need_no_join(spark, star, tmp_dir):
    from passante.operators import bi as B
    from passante.operators import demographics as D
    from passante.operators import geo as G
    from passante.plans.model import materialize_enriched
    materialize_enriched(star, f"{tmp_dir}/j3")
    j3 = spark.read.parquet(f"{tmp_dir}/j3")
    for df in (D.compare(j3, "faixa_etaria"), B.peak_hour(j3), G.hexbin(D.point_rows(j3), 300.0)):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_materialized_view_pushdown(spark, star, tmp_dir):
    from passante.operators import campaign as C
    from passante.plans.model import materialize_enriched
    materialize_enriched(star, f"{tmp_dir}/j3")
    j3 = spark.read.parquet(f"{tmp_dir}/j3")
    spec = C.CampaignSpec(gender="female", latitude=-23.5505, longitude=-46.6333, radius_km=3.0)
    df = C.analyze_campaign(j3.where("uf_estado = 'ASIA'"), spec)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(uf_estado" in plan
    assert "GreaterThanOrEqual(latitude,-23.57" in plan and "LessThanOrEqual(longitude,-46.60" in plan
    assert "TakeOrderedAndProject" in plan
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "class_a_count" not in scan and "feminine_count" in scan
