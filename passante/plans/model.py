"""J1 snowflake join, J3 enriched view, N10 wide counts.

The profile tables are as large as the fact table (one profile per event),
so the joins are shuffle joins on the keys; Catalyst + AQE choose between
sort-merge and shuffled hash, and only broadcast a side whose measured size
is under ``autoBroadcastJoinThreshold``.  Nothing here forces a broadcast.

For repeated analytical use, ``materialize_enriched`` writes J3 once as
Parquet partitioned by state with double coordinates, so later scans get
partition pruning and min/max pushdown on latitude/longitude.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.functions.columns import try_double
from passante.schemas import SHARE_COLUMNS, SHARE_TO_COUNT
from passante.sources.testdata import Star


def snowflake(star: Star) -> DataFrame:
    """geodata ⋈ target ⋈ gender ⋈ age ⋈ social_class, all INNER.

    Events with a NULL ``target_id`` (or a dangling key) drop out, as in the
    reference.  Output: the geodata columns plus the 16 share columns.
    """
    g = star.geodata
    t = star.target.select(F.col("id").alias("target_id"), "age_id", "gender_id", "social_class_id")
    gen = star.gender.withColumnRenamed("id", "gender_id")
    age = star.age.withColumnRenamed("id", "age_id")
    sc = star.social_class.withColumnRenamed("id", "social_class_id")
    j = (g.join(t, "target_id")
         .join(gen, "gender_id")
         .join(age, "age_id")
         .join(sc, "social_class_id"))
    return j.drop("gender_id", "age_id", "social_class_id")


def with_counts(df: DataFrame) -> DataFrame:
    """Every share times ``uniques`` as ``*_count``."""
    return df.withColumns({SHARE_TO_COUNT[c]: F.col(c) * F.col("uniques") for c in SHARE_COLUMNS})


def enriched(star: Star) -> DataFrame:
    """J3 ``vw_geodata_enriched``: one row per joined event, coordinates as
    doubles (NULL when malformed) and the 16 demographic counts."""
    j = snowflake(star)
    j = j.withColumns({"latitude": try_double("latitude"), "longitude": try_double("longitude")})
    return with_counts(j)


def materialize_enriched(star: Star, path: str, mode: str = "overwrite") -> None:
    """Write J3 once, partitioned by ``uf_estado`` and clustered by location
    inside each partition, for repeated planning queries."""
    (enriched(star)
     .repartition("uf_estado", "location_id")
     .sortWithinPartitions("location_id")
     .write.mode(mode).partitionBy("uf_estado").parquet(path))


def store_bucketed(star: Star, path: str, buckets: int = 64, prefix: str = "passante") -> dict[str, str]:
    """J1 for back-fills: the five tables as bucketed and sorted tables of the catalogue,
    all by the target they belong to.  The profile tables get their target's id (one
    shuffle each, when they are stored), so that :func:`snowflake_bucketed` joins bucket to
    bucket, however often it runs.  Returns the table names."""
    links = star.target.select(F.col("id").alias("target_id"), "age_id", "gender_id", "social_class_id")
    tables = {"geodata": star.geodata, "target": links}
    for name in ("age", "gender", "social_class"):
        tables[name] = star.as_dict()[name].withColumnRenamed("id", f"{name}_id").join(links.select("target_id", f"{name}_id"), f"{name}_id")
    for name, table in tables.items():
        # a task per bucket, so a bucket is one file
        (table.repartition(buckets, "target_id").write.mode("overwrite").option("path", f"{path.rstrip('/')}/{name}")
         .bucketBy(buckets, "target_id").sortBy("target_id").saveAsTable(f"{prefix}_{name}"))
    return {name: f"{prefix}_{name}" for name in tables}


def snowflake_bucketed(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """J1 of the stored tables: a merge join per table, without an exchange."""
    out = spark.table(names["geodata"])
    for name in ("target", "gender", "age", "social_class"):
        keyed = spark.table(names[name])
        out = out.join(keyed.drop(*[c for c in keyed.columns if c.endswith("_id") and c != "target_id"]), "target_id")
    return out
