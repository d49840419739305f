"""Sanctions list: XML rows to entities, aliases, nationalities, documents and screening names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions import date_prefix, normalize_name, person_name, safe_text
from vetline.session import materialize

SOURCE_LIST = "UN_SC_1267"
TABLE_COLUMNS = {
    "entities": (
        "entity_id", "data_id", "entity_type", "primary_name", "un_reference_number", "listed_on", "source_list",
        "load_timestamp",
    ),
    "aliases": ("entity_id", "alias_name", "source_list", "load_timestamp"),
    "nationalities": ("entity_id", "nationality", "source_list", "load_timestamp"),
    "documents": ("entity_id", "doc_type", "doc_number", "source_list", "load_timestamp"),
}


def _stamped(df: DataFrame, load_timestamp: Column) -> DataFrame:
    return df.withColumns({"source_list": F.lit(SOURCE_LIST), "load_timestamp": load_timestamp})


def _entity_rows(rows: DataFrame, kind: str, name: Column) -> DataFrame:
    return rows.select(
        F.col("DATAID").alias("entity_id"),
        F.col("VERSIONNUM").alias("data_id"),
        F.lit(kind).alias("entity_type"),
        name.alias("primary_name"),
        safe_text("REFERENCE_NUMBER").alias("un_reference_number"),
        safe_text(date_prefix("LISTED_ON")).alias("listed_on"),
    )


def _children(rows: DataFrame, column: str, **fields: str) -> DataFrame:
    """Child elements with at least one non-empty field."""
    exploded = rows.select(F.col("DATAID").alias("entity_id"), F.explode(column).alias("_child"))
    named = exploded.select(
        "entity_id", *[safe_text(F.col(f"_child.{field}")).alias(alias) for alias, field in fields.items()]
    )
    present = F.lit(False)
    for alias in fields:
        present = present | F.coalesce(F.col(alias) != "", F.lit(False))
    return named.filter(present)


def flatten_sanctions(
    individuals: DataFrame, entities: DataFrame, load_timestamp: Column | None = None
) -> dict[str, DataFrame]:
    """The four staging tables, from one parse.

    The rows of both element kinds are stored as they are parsed; each table reads the fields it needs there.
    """
    individuals, entities = materialize(individuals, "individuals"), materialize(entities, "entities")
    stamp = F.current_timestamp() if load_timestamp is None else load_timestamp
    tables = {
        "entities": _entity_rows(
            individuals, "INDIVIDUAL", person_name("FIRST_NAME", "SECOND_NAME", "THIRD_NAME", "FOURTH_NAME")
        ).unionByName(_entity_rows(entities, "ENTITY", safe_text("FIRST_NAME"))),
        "aliases": _children(individuals, "INDIVIDUAL_ALIAS", alias_name="ALIAS_NAME").unionByName(
            _children(entities, "ENTITY_ALIAS", alias_name="ALIAS_NAME")
        ),
        "nationalities": _children(individuals, "NATIONALITY", nationality="VALUE"),
        "documents": _children(
            individuals, "INDIVIDUAL_DOCUMENT", doc_type="TYPE_OF_DOCUMENT", doc_number="NUMBER"
        ),
    }
    return {name: _stamped(df, stamp) for name, df in tables.items()}


def passthrough(table: str, df: DataFrame) -> DataFrame:
    """The silver copy: declared columns only."""
    return df.select(*TABLE_COLUMNS[table])


def screening_names(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Primary names and aliases in one table with their normalised form; NULL names are left out."""

    def tagged(df: DataFrame, column: str, kind: str) -> DataFrame:
        return df.filter(F.col(column).isNotNull()).select(
            "entity_id",
            F.col(column).alias("name_value"),
            F.lit(kind).alias("name_type"),
            "source_list",
            "load_timestamp",
        )

    both = tagged(entities, "primary_name", "primary").unionByName(tagged(aliases, "alias_name", "alias"))
    return both.withColumn("normalized_name", normalize_name("name_value"))
