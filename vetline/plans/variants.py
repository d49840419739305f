"""Semi-structured columns as VARIANT: parsed once where they land, read by path ever after.

A JSON text that does not parse becomes NULL, as in the text form. Missing fields and JSON nulls are NULL; a value that
does not fit the wanted type is NULL as well. An object read as text is JSON with its keys in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
LIST_JSON = ("area", "salary", "employer", "schedule", "employment", "experience")
DETAIL_JSON = ("employer", "key_skills")


def with_variants(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named JSON text columns as VARIANT; what landed is parsed here and nowhere else."""
    return df.withColumns({name: F.try_parse_json(name) for name in columns if name in df.columns})


def field(column: str, path: str, type_: str = "string") -> Column:
    return F.try_variant_get(F.col(column), f"$.{path}", type_)


def flatten_vacancies(bronze: DataFrame) -> DataFrame:
    """Silver vacancies from list records with VARIANT columns."""
    return bronze.filter(field("employer", "id").isNotNull()).select(
        F.col("id").alias("vacancy_id"),
        F.col("name").alias("title"),
        "published_at",
        field("area", "id").cast("int").alias("area_id"),
        field("area", "name").alias("area_name"),
        field("employer", "id").cast("bigint").alias("employer_id"),
        field("salary", "from", MONEY).alias("salary_from"),
        field("salary", "to", MONEY).alias("salary_to"),
        field("salary", "currency").alias("salary_currency"),
        *[field(name, "name").alias(name) for name in ("schedule", "employment", "experience")],
        "archived",
        "active_from",
        "active_to",
        "load_dt",
        "search_profile",
        "expected_risk_category",
    )


def skills(details: DataFrame) -> DataFrame:
    """Distinct skill names of detail records with a VARIANT list, one generator per record."""
    exploded = details.select("id", "load_dt", "inserted_at", F.explode(F.try_variant_get("key_skills", "$", "array<variant>")).alias("skill"))
    named = exploded.select(
        F.col("id").alias("vacancy_id"),
        F.trim(F.try_variant_get("skill", "$.name", "string")).alias("skill_name"),
        F.col("load_dt").alias("source_load_dt"),
        F.col("inserted_at").alias("ingested_at"),
    )
    return named.filter("skill_name <> ''").distinct()


def discovered_schema(df: DataFrame, column: str) -> T.StructType:
    """The fields that the objects of a VARIANT column hold, by one aggregation that merges schemas as it goes.

    Numbers widen; a field with values that no type holds in common stays VARIANT, and becomes text.
    """
    found = df.agg(F.schema_of_variant_agg(F.col(column)).alias("schema")).first()["schema"]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    return T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<"))


def discovered_columns(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and one for each field that the objects hold, typed by what the data has."""

    def typed(name: str, kind: T.DataType) -> Column:
        simple = kind.simpleString()
        # objects, lists and mixed values as JSON text
        plain = not isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType, T.NullType))
        return F.try_variant_get(F.col(column), f"$['{name}']", simple if plain else "string").alias(name)

    return df.select(*keep, *[typed(f.name, f.dataType) for f in discovered_schema(df, column).fields])
