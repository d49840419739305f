"""Numbered batches over an ordered set of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetline.session import ensure_checkpoint_dir

ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the row's 33 bits


def assign_batches(
    df: DataFrame, size: int, order: Sequence[Column], partitions: int | None = None, name: str = "batch_idx"
) -> DataFrame:
    """Number the rows in a global order and cut them into batches of ``size``.

    No task sees more than its own range: rows are range-partitioned and sorted, each takes its
    position in the partition, and the partitions' row counts (one small row each) give the
    offsets. The sorted rows are checkpointed because positions and offsets must come from the
    same partitioning.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_place", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_offset") + F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        # one row per partition of the sort above
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.floor(position / size).cast("int"))
        .drop("_part", "_place", "_offset")
    )


def enrich_from_manifest(details: DataFrame, manifest: DataFrame, key: str = "vacancy_id") -> DataFrame:
    """Manifest metadata and batch number onto the detail rows that the manifest lists."""
    overlap = [name for name in manifest.columns if name in details.columns and name != key]
    return details.drop(*overlap).join(manifest, key)
