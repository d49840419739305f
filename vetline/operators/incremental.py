"""Which rows, files or partitions a run has to process."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def single_date(df: DataFrame, date_column: str, business_date: str | dt.date) -> DataFrame:
    """Exactly one load date; a literal, so a partitioned source reads one folder."""
    return df.filter(F.col(date_column) == F.lit(str(business_date)).cast("date"))


def rows_since_max(
    source: DataFrame,
    target: DataFrame,
    date_column: str = "load_dt",
    on_empty: str = "nothing",
) -> DataFrame:
    """Source rows newer than anything in the target.

    On an empty target the maximum is NULL and the comparison selects nothing; ``on_empty="all"``
    puts 1900-01-01 in its place. The maximum is one value, fetched before the filter is built: the
    filter then holds a literal, which prunes partitions and row groups while planning.
    """
    newest = target.agg(F.max(date_column)).first()[0]
    if newest is None:
        return source if on_empty == "all" else source.limit(0)
    return source.filter(F.col(date_column) > F.lit(newest))


def rows_since_max_lazy(
    source: DataFrame, target: DataFrame, date_column: str = "load_dt", on_empty: str = "nothing"
) -> DataFrame:
    """The same without an action: the maximum is a scalar subquery of the filter."""
    newest = F.max(date_column)
    if on_empty == "all":
        newest = F.coalesce(newest, F.lit("1900-01-01").cast("date"))
    return source.filter(F.col(date_column) > target.agg(newest).scalar())


def files_since(listing: DataFrame, last_check: str | dt.date) -> DataFrame:
    """Files modified on a later day than the last check (day granularity)."""
    return listing.filter(F.to_date("last_modified") > F.lit(str(last_check)).cast("date"))


def partition_date(key: str | Column) -> Column:
    """The ``dt=`` folder of an object key; empty where there is none."""
    return F.regexp_extract(key, r"/dt=([^/]*)", 1)


def newest_file_per_date(listing: DataFrame) -> DataFrame:
    return (
        listing.filter(F.col("key").contains("/dt="))
        .groupBy(partition_date("key").alias("dt"))
        .agg(F.max("last_modified").alias("last_modified"))
    )


def partitions_to_reload(listing: DataFrame, last_check: str | dt.date) -> DataFrame:
    """Dates with a file modified on a later day than the last check."""
    return files_since(newest_file_per_date(listing), last_check)
