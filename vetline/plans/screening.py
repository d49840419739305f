"""Names against the sanctions list: exact after normalisation, and by trigram similarity.

The list is thinned out before any join: names with one normalised form match the same inputs with
the same score, so a ranking that keeps k rows per input never needs more than k of them. A form
shared by a large part of the list, or an input name repeated many times, thus stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions import normalize_name, normalize_name_ascii, screening_verdict
from vetline.operators.dedup import latest_per_key, top_k
from vetline.operators.pairstore import PairStore
from vetline.operators.similarity import similarity_join

THRESHOLD = 0.7
TOP = 3


def _priority() -> Column:
    return F.when(F.col("name_type") == "primary", 1).when(F.col("name_type") == "alias", 2).otherwise(99)


def _exact(inputs: DataFrame, names: DataFrame) -> DataFrame:
    left = inputs.select("input_id", "input_name", normalize_name("input_name").alias("normalized_input_name"))
    right = names.select(
        "normalized_name", "entity_id", F.col("name_value").alias("matched_name"), "name_type", "source_list"
    )
    result = F.when(F.col("entity_id").isNotNull(), "MATCH").otherwise("NO_MATCH")
    return (
        left.join(right, F.col("normalized_input_name") == F.col("normalized_name"), "left")
        .drop("normalized_name")
        .withColumn("screening_result", result)
    )


def screen_exact(inputs: DataFrame, names: DataFrame) -> DataFrame:
    """Every input with all its matches, or once with NO_MATCH."""
    return _exact(inputs, names)


def screen_exact_best(inputs: DataFrame, names: DataFrame) -> DataFrame:
    """One row per input: primary names before aliases, then by name."""
    order = [_priority(), F.col("name_value"), F.col("entity_id"), F.col("name_type"), F.col("source_list")]
    return _exact(inputs, latest_per_key(names, ["normalized_name"], order))


def _name_columns(names: DataFrame) -> DataFrame:
    return names.select(
        "entity_id",
        F.col("name_value").alias("matched_name"),
        F.col("normalized_name").alias("matched_normalized_name"),
        "name_type",
        "source_list",
    )


def update_pairs(store: PairStore, inputs: DataFrame, names: DataFrame) -> DataFrame:
    """The similar normalised names of a store, brought up to date; both fuzzy marts can be made from them."""
    wanted = inputs.select(normalize_name_ascii("input_name").alias("normalized_input_name"))
    return store.update(wanted, names, "normalized_input_name", "normalized_name")


def screen_fuzzy_top(
    inputs: DataFrame, names: DataFrame, k: int = TOP, threshold: float = THRESHOLD, pairs: DataFrame | None = None
) -> DataFrame:
    """The k most similar names per input name.

    An input name listed n times has n copies of each match in its ranking, as specified; the
    copies are made after the join.
    """
    wanted = inputs.groupBy("input_name").agg(F.count("*").alias("_copies"))
    wanted = wanted.withColumn("normalized_input_name", normalize_name_ascii("input_name"))
    ties = [F.col("name_value"), F.col("entity_id"), F.col("name_type"), F.col("source_list")]
    listed = _name_columns(top_k(names, ["normalized_name"], ties, k, "_rank").drop("_rank"))
    pairs = similarity_join(wanted, listed, "normalized_input_name", "matched_normalized_name", threshold, pairs=pairs)
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("_copies"), F.lit(k)).cast("int")))
    order = [
        F.col("similarity_score").desc(),
        *[F.col(name) for name in ("matched_name", "entity_id", "name_type", "source_list", "_copy")],
    ]
    return top_k(pairs.withColumn("_copy", copies), ["input_name"], order, k).select(
        "input_name",
        "normalized_input_name",
        "entity_id",
        "matched_name",
        "name_type",
        "source_list",
        "similarity_score",
        "rn",
    )


def _is_equal() -> Column:
    return F.when(F.col("normalized_input_name") == F.col("matched_normalized_name"), 1).otherwise(0)


def similar_names(inputs: DataFrame, names: DataFrame, threshold: float = THRESHOLD, pairs: DataFrame | None = None) -> DataFrame:
    """Input names with every row of a listed name that is similar or equal."""
    wanted = inputs.select("input_name").distinct()
    wanted = wanted.withColumn("normalized_input_name", normalize_name_ascii("input_name"))
    return similarity_join(
        wanted, _name_columns(names), "normalized_input_name", "matched_normalized_name", threshold, include_equal=True, pairs=pairs
    )


def fuzzy_pairs(inputs: DataFrame, names: DataFrame, threshold: float = THRESHOLD, pairs: DataFrame | None = None) -> DataFrame:
    """Input names with every listed name that is similar or equal, once per pair of names.

    Rows of one listed name differ only in their entity, so the first entity is picked before the join.
    """
    first = latest_per_key(
        names, ["name_value"], [F.col("entity_id"), F.col("name_type"), F.col("source_list")]
    )
    return similar_names(inputs, first, threshold, pairs)


def dedup_pairs(matched: DataFrame) -> DataFrame:
    """Best row per input and matched name of any set of matches: equal first, then score, then entity."""
    order = [
        _is_equal().desc(),
        F.col("similarity_score").desc(),
        F.col("entity_id"),
        F.col("name_type"),
        F.col("source_list"),
    ]
    return latest_per_key(matched, ["input_name", "matched_name"], order)


def rank_candidates(pairs: DataFrame, k: int = TOP) -> DataFrame:
    order = [_is_equal().desc(), F.col("similarity_score").desc(), F.col("matched_name")]
    return top_k(pairs, ["input_name"], order, k)


def screen_fuzzy_best(
    inputs: DataFrame, names: DataFrame, k: int = TOP, threshold: float = THRESHOLD, pairs: DataFrame | None = None
) -> DataFrame:
    """The k best distinct names per input name with a verdict."""
    first = latest_per_key(
        names, ["name_value"], [F.col("entity_id"), F.col("name_type"), F.col("source_list")]
    )
    few = top_k(first, ["normalized_name"], [F.col("name_value")], k, "_rank").drop("_rank")
    ranked = rank_candidates(fuzzy_pairs(inputs, few, threshold, pairs), k)
    verdict = screening_verdict(
        F.col("normalized_input_name"), F.col("matched_normalized_name"), F.col("similarity_score")
    )
    return ranked.withColumn("screening_result", verdict).select(
        "input_name",
        "normalized_input_name",
        "entity_id",
        "matched_name",
        "matched_normalized_name",
        "name_type",
        "source_list",
        "similarity_score",
        "screening_result",
        "rn",
    )


def demo_results(best: DataFrame) -> DataFrame:
    """The best match per input with a rounded score."""
    return best.filter(F.col("rn") == 1).select(
        "input_name",
        "normalized_input_name",
        "entity_id",
        F.col("matched_name").alias("best_match"),
        "matched_normalized_name",
        "name_type",
        "source_list",
        F.round("similarity_score", 4).alias("similarity_score"),
        "screening_result",
    )
