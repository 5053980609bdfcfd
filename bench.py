"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...,
 "ingest_events_per_sec": ...}

Each query runs once after a warm-up; its time covers planning and full
execution (results are consumed by a no-op sink, nothing is collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "compare_age", "demographics_filtered", "geo_points_filtered", "filter_options_cities",
    "coverage_metadata", "campaign_affinity", "campaign_radius", "campaign_topk_multi",
    "hexbin", "hex_color_classes", "segment_density_domain", "radius_join", "location_profile",
    "screen_enrichment", "centre_ranking", "joint_distribution", "long_form_union", "peak_hour",
    "class_share", "area_compare", "partition_lag", "lag_percentiles", "ingest_rate_5min",
    "conversation_budget", "ingest_csv_shred", "csv_bulk_load", "archive_daily_flow", "stream_enriched_view", "stream_warehouse_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import SparkSession

    from passante.registry import QUERIES
    from passante.session import apply_runtime_conf

    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("passante-bench")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="passante-bench-"))
               .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
               .config("spark.sql.session.timeZone", "UTC"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)

    # warm-up on the smallest scale: JVM JIT, codegen cache, Python workers
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            QUERIES[name][0](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    ingest_rate = None
    for name in HEADLINE:
        fn = QUERIES[name][0]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        if name == "stream_warehouse_ingest":
            n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
            ingest_rate = round(n_events / times[name], 1)
    # the deployment path: materialise the enriched view once, then query it
    from passante.operators import campaign as C
    from passante.operators import demographics as D
    from passante.operators import geo as G
    from passante.plans.model import materialize_enriched
    from passante.registry import CAMPAIGNS, MULTI_SPECS, _ctx
    from passante.session import scratch_path
    mat = scratch_path(spark, "bench-j3")
    t0 = time.perf_counter()
    materialize_enriched(_ctx(spark, sf_dir)[1], mat)
    materialized = {"materialize_enriched": round(time.perf_counter() - t0, 3)}
    j3 = spark.read.parquet(mat)
    plans = {
        "compare_age": lambda: D.compare(j3, "faixa_etaria"),
        "campaign_radius": lambda: C.analyze_campaign(j3, CAMPAIGNS["campaign_radius"]),
        "campaign_topk_multi": lambda: C.multi_campaign(j3, MULTI_SPECS),
        "hexbin": lambda: G.hexbin(D.point_rows(j3), G.hex_radius_m(5.0)),
    }
    for name, build in plans.items():
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        materialized[name + "_on_view"] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "ingest_events_per_sec": ingest_rate,
                      "materialized_view": materialized}))
    spark.stop()


if __name__ == "__main__":
    main()
