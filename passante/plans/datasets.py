"""Dataset management: ingest contract check (F15), dataset upload and
switch (S8), aggregated export with metadata (K6)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.functions.columns import try_double

# --- fixed values: columns every flow dataset must carry ---
MANDATORY_COLUMNS = ["location_id", "impression_hour", "uniques", "latitude", "longitude"]


class MissingColumn(ValueError):
    def __init__(self, column: str):
        super().__init__(f"missing mandatory column: {column}")
        self.column = column


def check_columns(df: DataFrame) -> None:
    """Header check: name the first mandatory column that is absent."""
    have = set(df.columns)
    for c in MANDATORY_COLUMNS:
        if c not in have:
            raise MissingColumn(c)


def ingest_summary(df: DataFrame) -> DataFrame:
    """after the header check, one aggregation pass: records, min/max
    hour, distinct locations, and the rule counts (hours outside 0..23 or
    not integers, coordinates that do not parse or lie off the globe)."""
    check_columns(df)
    hour = F.col("impression_hour").cast("string").try_cast("bigint")
    lat, lon = try_double(F.col("latitude").cast("string")), try_double(F.col("longitude").cast("string"))
    bad_coord = lat.isNull() | lon.isNull() | ~lat.between(-90, 90) | ~lon.between(-180, 180)
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.min(hour).alias("min_hour"), F.max(hour).alias("max_hour"),
        F.countDistinct("location_id").alias("locations"),
        F.count(F.when(hour.isNull() | ~hour.between(0, 23), 1)).alias("bad_hours"),
        F.count(F.when(bad_coord, 1)).alias("bad_coordinates"))


def register_dataset(df: DataFrame, root: str, dataset: str, table: str = "geodata") -> None:
    """A compatible upload becomes a new dataset partition; re-uploading
    the same name replaces only that partition."""
    check_columns(df) if table == "geodata" else None
    (df.withColumn("dataset", F.lit(dataset)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dataset")
     .parquet(f"{root.rstrip('/')}/{table}"))


def use_dataset(spark: SparkSession, root: str, dataset: str, table: str = "geodata") -> DataFrame:
    """The active dataset (partition pruning on ``dataset``)."""
    return (spark.read.parquet(f"{root.rstrip('/')}/{table}")
            .where(F.col("dataset") == dataset).drop("dataset"))


def list_datasets(spark: SparkSession, root: str, table: str = "geodata") -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}").select("dataset").distinct().orderBy("dataset")


def export_aggregate(df: DataFrame, path: str, metadata: dict) -> None:
    """K6: aggregated rows as CSV plus one metadata JSON document (period,
    applied filters, dataset version)."""
    p = path.rstrip("/")
    df.write.mode("overwrite").option("header", True).csv(f"{p}/data")
    spark = df.sparkSession
    (spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "value string")
     .coalesce(1).write.mode("overwrite").text(f"{p}/_metadata"))
