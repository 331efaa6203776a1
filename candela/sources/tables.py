"""Reading the parquet tables of a scale-factor directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table with declared types: folder names of partitions are never read as numbers or dates."""
    return spark.read.schema(schema).parquet(path).select(schema.names)
