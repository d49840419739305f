"""Field access on columns that hold raw JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_fields(column: str | Column, *names: str) -> Column:
    """Parse the JSON object once and give the named fields as text.

    Every field is read as a string: scalars lose their quotes, nested values keep their JSON
    text, JSON null becomes NULL. Casts belong to the caller, so that a bad value fails there.
    """
    return F.from_json(column, ", ".join(f"`{name}` string" for name in names))


def empty_json_to_null(column: str | Column) -> Column:
    """NULL for the texts that stand for "nothing" (null, NaN, empty list); ``{}`` is kept."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(~text.rlike(r"^\s*(null|NaN|\[\s*\])\s*$"), text)


def bool_or_null(column: str | Column) -> Column:
    """Truthiness of a raw JSON scalar; NULL for null and NaN."""
    text = F.trim(F.col(column) if isinstance(column, str) else column)
    return F.when(~text.isin("null", "NaN"), ~text.rlike(r"^(|false|False|-?0+(\.0*)?|\[\s*\]|\{\s*\})$"))
