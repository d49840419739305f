"""Column-level reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stamp_lineage(df: DataFrame, **values: object) -> DataFrame:
    """Append constant lineage columns (profile, category, load date, load type)."""
    return df.withColumns(
        {name: value if isinstance(value, Column) else F.lit(value) for name, value in values.items()}
    )


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*path, field.name)
        nested = isinstance(field.dataType, T.StructType)
        found.extend(_leaves(field.dataType, here) if nested else [here])
    return found


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Flatten structs to dotted names and keep those of the wanted columns that exist."""
    present = {".".join(path): path for path in _leaves(df.schema)}
    return df.select(
        *[
            F.col(".".join(f"`{part}`" for part in present[name])).alias(name)
            for name in wanted
            if name in present
        ]
    )


def explode_json_array(df: DataFrame, column: str, field: str, alias: str) -> DataFrame:
    """One row per array element; a NULL or empty array drops the row."""
    items = F.from_json(column, f"array<struct<`{field}`: string>>")
    return df.withColumn("_item", F.explode(items)).withColumn(alias, F.col(f"_item.{field}")).drop("_item")


def concat_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column missing in one of them is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
