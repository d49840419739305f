"""Writers that can be rerun."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _partitioned(df: DataFrame, partition_by: Sequence[str]):
    return (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    )


def write_jsonl_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("load_type", "dt"), compression: str = "gzip") -> None:
    """JSON lines under ``load_type=/dt=[/batch=]``; a rerun replaces the partitions it writes, compressed or plain.

    Each record repeats the names of its fields, so the files are compressed; readers tell by the ending (``none``
    writes plain text). Such a file is read by one task: a partition has as many as tasks that wrote it.
    """
    _partitioned(df, partition_by).options(ignoreNullFields=False, compression=compression).json(path)


def write_parquet_daily(df: DataFrame, path: str, date_column: str = "dt") -> None:
    _partitioned(df, [date_column]).parquet(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv_history(spark: SparkSession, path: str, schema: str, columns: Sequence[str] = ("id", "name")) -> DataFrame:
    """Only the named columns of the history; the parser skips the others."""
    return spark.read.schema(schema).option("header", True).csv(path).select(*columns)


def append_new_csv(df: DataFrame, path: str, schema: str, keys: Sequence[str] = ("id", "name")) -> None:
    """Append the rows whose key is not in the history yet.

    As in pandas, two missing key parts are the same key.
    """
    history = read_csv_history(df.sparkSession, path, schema, keys).alias("old")
    same = [F.col(f"new.{key}").eqNullSafe(F.col(f"old.{key}")) for key in keys]
    fresh = df.alias("new").join(history, same, "left_anti")
    fresh.write.mode("append").option("header", True).csv(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and reload; an empty frame leaves an empty table with its columns."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
