"""Upserts on immutable files.

``merge_rows`` gives the target after an INSERT ... ON CONFLICT DO UPDATE. The updates, one per key, are
stored first, so that nothing computes them twice and their number is known. Up to ``SMALL_ROWS`` of them Spark can
broadcast: the target streams through one left join and never shuffles; only its key columns are read a second
time, to find which updates are inserts. More updates meet the target in one full outer join, which shuffles each side
once. Both give the same rows. A null in a key equals another null there, so a replay adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.operators.dedup import latest_per_key
from vetline.session import materialize


SMALL_ROWS = 100_000


class Rule(Enum):
    """What happens to a column of a row that exists on both sides."""

    REPLACE = "replace"
    KEEP_FIRST = "keep_first"
    LEAST = "least"
    GREATEST = "greatest"


def _resolve(rule: Rule | Column, old: Column, new: Column) -> Column:
    if rule is Rule.REPLACE:
        return new
    if rule is Rule.KEEP_FIRST:
        return F.coalesce(old, new)
    if rule is Rule.LEAST:
        return F.least(old, new)
    if rule is Rule.GREATEST:
        return F.greatest(old, new)
    return rule


def _same_key(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")) for key in keys]


def merge_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Rule | Column] | None = None,
    latest_by: Sequence[Column] | None = None,
    stored: bool = False,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """The target with the updates merged in; columns without a rule are replaced.

    A rule may also be an expression over ``new.<column>`` and ``old.<column>``. Two updates of one
    key would be ambiguous: ``latest_by`` picks the one that counts. The result has the columns of
    the target. ``stored`` says that the updates are read from a table, not computed.
    """
    rules = dict(rules or {})
    columns = target.columns
    if latest_by is not None:
        updates = latest_per_key(updates, keys, latest_by)
    updates = updates.select(*columns)
    if not stored or latest_by is not None:
        updates = materialize(updates, "updates")

    small = updates.count() <= small_rows
    new = updates.withColumn("_hit", F.lit(True)).alias("new")
    old = target.withColumn("_here", F.lit(True)).alias("old")
    joined = old.join(new, _same_key(keys), "left" if small else "full")

    def merged(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in keys:
            return F.coalesce(before, after).alias(name)
        resolved = F.when(F.col("old._here").isNull(), after).otherwise(_resolve(rules.get(name, Rule.REPLACE), before, after))
        return F.when(F.col("new._hit"), resolved).otherwise(before).alias(name)

    rows = joined.select(*[merged(name) for name in columns])
    return rows.unionByName(_missing(updates, target, keys)) if small else rows


def _missing(updates: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The updates whose key the target lacks; of the target only keys that the updates hold are moved."""
    known = target.select(*keys).alias("old").join(updates.select(*keys).alias("new"), _same_key(keys), "left_semi")
    return updates.alias("new").join(known.alias("old"), _same_key(keys), "left_anti")


def new_rows_only(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], first_by: Sequence[Column] | None = None
) -> DataFrame:
    """The updates an INSERT ... ON CONFLICT DO NOTHING would add, one per key.

    The target is first cut down to the keys the updates hold, so a small delta is broadcast
    against a large target and the target's rows never move.
    """
    fresh = latest_per_key(updates, keys, first_by) if first_by is not None else updates
    return _missing(fresh, target, keys)


def insert_ignore(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], first_by: Sequence[Column]
) -> DataFrame:
    return target.unionByName(new_rows_only(target, updates, keys, first_by).select(*target.columns))
