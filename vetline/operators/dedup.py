"""Keep one row, or the best k rows, per key.

All of these are ``row_number() <= k`` filters. Spark prunes such a window on the map side
(WindowGroupLimit), so a key that holds a large share of the rows sends at most k rows per
map task through the shuffle. The ordering must be total for a repeatable result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn") -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "_rank").drop("_rank")


def keep_first(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First occurrence per key in the given order; rows with an empty key are dropped."""
    present = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return latest_per_key(present, [key], order)


def concat_keep_first(old: DataFrame, new: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Old rows before new ones, one row per key."""
    both = old.withColumn("_source", F.lit(0)).unionByName(
        new.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, [key], [F.col("_source").asc(), *order]).drop("_source")
