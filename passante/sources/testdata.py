"""Readers for the base parquet tables and the five-table star.

``Tables`` is a lazy accessor: each property is a parquet scan, so Catalyst
prunes columns and pushes filters into the reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Base tables of a scale-factor folder (`{dir}/{name}.parquet`)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)


@dataclass
class Star:
    """The warehouse model: geodata -> target -> {age, gender, social_class}."""

    geodata: DataFrame
    target: DataFrame
    age: DataFrame
    gender: DataFrame
    social_class: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"geodata": self.geodata, "target": self.target, "age": self.age,
                "gender": self.gender, "social_class": self.social_class}


def read_star(spark: SparkSession, warehouse: str) -> Star:
    """Read the five warehouse tables written by the loaders (`{warehouse}/{table}`)."""
    w = warehouse.rstrip("/")
    return Star(*(spark.read.parquet(f"{w}/{t}") for t in
                  ["geodata", "target", "age", "gender", "social_class"]))
