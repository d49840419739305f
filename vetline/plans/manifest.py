"""The expected-ID contract of one load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.operators.dedup import keep_first


def build_manifest(items: DataFrame, ds: str, load_type: str, order: Sequence[Column], key: str = "id") -> DataFrame:
    """One row per id, first occurrence first; a missing load date or type takes the default."""
    return keep_first(items, key, order).select(
        F.col(key).cast("string").alias("vacancy_id"),
        "search_profile",
        "expected_risk_category",
        F.coalesce(F.col("load_dt").cast("string"), F.lit(ds)).alias("load_dt"),
        F.coalesce("load_type", F.lit(load_type)).alias("load_type"),
    )


def file_order() -> list[Column]:
    """Read order of a file source; use it directly on the frame that was read."""
    return [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
