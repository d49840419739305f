"""File listings as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """``(key, last_modified, size)`` of every file below the path; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("key"), F.col("modificationTime").alias("last_modified"), F.col("length").alias("size"))
    )
