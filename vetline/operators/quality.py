"""Data-quality checks that give one row per rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vetline.session import materialize


class QualityError(ValueError):
    """Rows that break a rule; ``failures`` counts them by column."""

    def __init__(self, name: str, failures: Mapping[str, int]):
        super().__init__(f"{name}: NULL in {dict(failures)}")
        self.failures = dict(failures)


def store_observed(df: DataFrame, name: str, not_null: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """The rows, stored, and the NULLs of each column, counted while they were written: no scan of their own.

    A task that is run again may count twice, so that a count says for certain only whether there is any.
    """
    counted = Observation(f"{name}_nulls")
    checks = [F.count_if(F.col(column).isNull()).alias(f"nulls_{i}") for i, column in enumerate(not_null)]
    stored = materialize(df.observe(counted, F.count(F.lit(1)).alias("rows"), *checks), name)
    found = counted.get
    return stored, {column: found[f"nulls_{i}"] for i, column in enumerate(not_null)}


def store_checked(df: DataFrame, name: str, not_null: Sequence[str]) -> DataFrame:
    """The rows, stored; a NULL in one of the columns stops the job before anything else reads them."""
    stored, failures = store_observed(df, name, not_null)
    if any(failures.values()):
        raise QualityError(name, {column: n for column, n in failures.items() if n})
    return stored


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. As in SQL, a NULL key is no duplicate of another."""
    present = reduce(lambda left, right: left & right, [F.col(key).isNotNull() for key in keys])
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_constraints(
    table: str, df: DataFrame, not_null: Sequence[str], unique: Sequence[str] = ()
) -> DataFrame:
    """``(table_name, column_name, rule, failures)`` for NOT NULL columns and a primary key, from one scan.

    NULLs are counted per key on the way to the key counts.
    """
    nulls = {f"_null_{i}": F.count_if(F.col(name).isNull()) for i, name in enumerate(not_null)}
    rules = {f"_null_{i}": (name, "not_null") for i, name in enumerate(not_null)}
    if unique:
        present = reduce(lambda left, right: left & right, [F.col(key).isNotNull() for key in unique])
        per_key = df.groupBy(*unique).agg(F.count("*").alias("_n"), *[value.alias(name) for name, value in nulls.items()])
        nulls = {name: F.coalesce(F.sum(name), F.lit(0)) for name in nulls}
        nulls["_repeats"] = F.count_if(present & (F.col("_n") > 1))
        rules["_repeats"] = (",".join(unique), "unique")
        df = per_key
    counts = df.agg(*[value.alias(name) for name, value in nulls.items()])
    entries = F.array(
        *[
            F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), F.col(name).alias("failures"))
            for name, (column, rule) in rules.items()
        ]
    )
    return counts.select(F.explode(entries).alias("c")).select("c.*")


def check_all(tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    checks = [check_constraints(name, *spec) for name, spec in tables.items()]
    return reduce(DataFrame.unionByName, checks)
