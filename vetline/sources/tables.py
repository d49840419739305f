"""Declared sources: names that models use, mapped to where the data lies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """A path ending in a format suffix or folder is read as Parquet, anything else as a table name."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, str]):
        self.spark, self.sources = spark, dict(sources)

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, names: list[str]) -> Tables:
        return cls(spark, {name: f"{folder}/{name}.parquet" for name in names})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.sources:
            raise KeyError(f"undeclared source: {name}")
        location = self.sources[name]
        return self.spark.read.parquet(location) if "/" in location else self.spark.table(location)

    def publish_view(self, name: str, df: DataFrame) -> None:
        """Staging models: a view, inlined by the optimizer."""
        df.createOrReplaceTempView(name)
        self.sources[name] = name

    def publish_table(self, name: str, df: DataFrame, path: str) -> None:
        """Silver and gold models: computed once and stored; a later call is the full refresh."""
        from vetline.sources.sinks import replace_table

        replace_table(df, path)
        self.sources[name] = path
