"""Rows that share wide columns, which lie in a table of their own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Referred:
    """The inner join of `rows` and `bodies` on `ref`, not yet made: a body may have many rows, a row many bodies or none."""

    rows: DataFrame
    bodies: DataFrame
    ref: str

    def whole(self) -> DataFrame:
        return self.rows.join(self.bodies, self.ref).drop(self.ref)


def join_referred(left: DataFrame, right: Referred, on: Sequence[str]) -> DataFrame:
    """``left.join(right.whole(), on, "left")``, where each body is shuffled once, however many rows refer to it.

    The narrow rows are matched first; then the matches go to their bodies, not the bodies to the matches.
    """
    bodies = right.bodies.withColumnRenamed(right.ref, "_ref")
    rows = right.rows.withColumnRenamed(right.ref, "_ref")
    # a row without a body is no row of the inner join
    real = rows.join(bodies.select("_ref"), "_ref", "left_semi")
    found = left.join(real, list(on), "left")
    # rows without a match are dealt out by what they are, not sent to one task as NULL
    slot = F.when(F.col("_ref").isNotNull(), F.xxhash64("_ref")).otherwise(F.xxhash64(*on))
    return found.withColumn("_slot", slot).join(bodies.withColumn("_slot", F.xxhash64("_ref")), ["_slot", "_ref"], "left").drop("_slot", "_ref")
