"""Exact trigram-similarity join without a cross product.

Trigrams have one order: the rarest in the list come first. For a score above ``t`` a pair must share ``t * n`` of
the ``n`` trigrams of either side. So the first ``n - ceil(t * n) + 1`` trigrams of both sides, their *signatures*,
share one. Any order is exact; a rare start only makes it cheap. The order is a table of fixed size, the rank of
each bucket of trigrams by how often the list has it. It is a constant of the plan, so a value is cut, ranked and
signed where it lies, without a shuffle. Both signatures are exploded and joined on the trigram. Bounds on that
join, all exact, thin pairs out before any text is compared:

* length: ``t <= n1 / n2 <= 1 / t``;
* place: trigrams shared at places ``i`` and ``j`` leave room for ``min(i, j)`` shared ones before and
  ``min(n1 - i, n2 - j)`` from there on, and a pair needs ``t * (n1 + n2) / (1 + t)`` in all;
* bitmap: each value carries one bit per trigram in a few words. Every bit that only one side has is a trigram, at
  least, that the other lacks.

Values travel as 64-bit hashes with sizes and bitmaps until then; the texts are joined back by hash and every
surviving pair is scored in full from its two texts. Nothing is capped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions.names import packed_trigrams
from vetline.session import materialize

BROADCAST_LIMIT = 128 * 1024 * 1024
ENTRY_BYTES = 128  # one index row in a broadcast hash table
BUCKETS = 1 << 12  # of trigrams, for their order
WORDS = 4  # of 64 bits in a bitmap
SLACK = 1e-9  # keeps rounding from cutting a pair that lies exactly on a bound


def _distinct_values(df: DataFrame, column: str, side: str) -> DataFrame:
    """``(<side>_value, <side>_hash)`` for the values that are not NULL."""
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias(f"{side}_value")).distinct()
    return values.withColumn(f"{side}_hash", F.xxhash64(f"{side}_value"))


def _once(value: Column) -> Column:
    """Evaluate the expression once per row.

    A filter on a projected column is pushed below joins and aggregates with the expression
    copied into it; a generated column stays where it is.
    """
    return F.explode(F.array(value))


def _outside_signature(size: Column, threshold: float) -> Column:
    return (F.ceil(size * threshold - SLACK) - 1).cast("int")


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def gram_order(listed: DataFrame) -> bytes:
    """Two bytes for each bucket of trigrams: its place among all by how many listed values have such a trigram."""
    grams = listed.select(F.explode(packed_trigrams("right_value")).alias("gram"))
    counts = grams.groupBy(_bucket(F.col("gram")).alias("bucket")).agg(F.count("*").alias("n")).toArrow()  # BUCKETS rows at most
    ranks = {n: rank for rank, n in enumerate(sorted(set(counts["n"].to_pylist())), 1)}
    table = bytearray(2 * BUCKETS)
    for bucket, n in zip(counts["bucket"].to_pylist(), counts["n"].to_pylist(), strict=True):
        table[2 * bucket : 2 * bucket + 2] = ranks[n].to_bytes(2, "big")
    return bytes(table)


def signed_values(values: DataFrame, side: str, order: bytes, threshold: float, sizes: tuple[int, int] | None = None) -> DataFrame:
    """``(<side>_hash, <side>_size, <side>_bits, <side>_grams)``: how many trigrams, their bitmap, and the signature.

    sizes: the least and most trigrams of the other side; values that can be similar to none of them are left out
    before they are signed.
    """

    def ranked(gram: Column) -> Column:
        rank = F.substring(F.lit(order), 2 * _bucket(gram) + 1, F.lit(2))
        return F.struct(rank.alias("rank"), gram.alias("gram"))

    def word(k: int) -> Column:
        own = F.filter("places", lambda place: F.shiftright(place, 6) == k)
        bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))
        return F.aggregate(own, F.lit(0).cast("long"), lambda bits, place: bits.bitwiseOR(bit(place)))

    size = F.size("grams")
    cut = values.select(f"{side}_hash", _once(packed_trigrams(f"{side}_value")).alias("grams")).filter(size > 0)
    if sizes is not None:
        cut = cut.filter(size.between(threshold * sizes[0] - SLACK, sizes[1] / threshold + SLACK))
    kept = F.slice(F.sort_array(F.transform("grams", ranked)), F.lit(1), F.greatest(size - _outside_signature(size, threshold), F.lit(0)))
    placed = cut.withColumn("places", F.transform("grams", lambda gram: F.pmod(F.xxhash64(gram, F.lit(1)), F.lit(64 * WORDS)).cast("int")))
    return placed.select(
        f"{side}_hash", size.alias(f"{side}_size"), F.struct(*[word(k).alias(f"w{k}") for k in range(WORDS)]).alias(f"{side}_bits"), kept["gram"].alias(f"{side}_grams")
    )


def _posted(signed: DataFrame, side: str) -> DataFrame:
    """A row per signature trigram, with its place."""
    held = [f"{side}_hash", f"{side}_size", f"{side}_bits"]
    return signed.select(*held, F.posexplode(f"{side}_grams").alias(f"{side}_place", f"{side}_gram"))


def _alone(own: str, other: str) -> Column:
    """Bits that one side has and the other lacks."""
    total = F.lit(0)
    for k in range(WORDS):
        total = total + F.bit_count(F.col(f"{own}_bits.w{k}").bitwiseAND(F.bitwise_not(F.col(f"{other}_bits.w{k}"))))
    return total


def candidate_rows(left: DataFrame, right: DataFrame, threshold: float, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``(left_hash, right_hash)`` of signed values, a row per shared signature trigram within the bounds.

    The right side is broadcast where the number of its signature trigrams proves it small; otherwise both are
    shuffled on the trigram, where the adaptive join splits a frequent one.
    """
    grams = right.agg(F.sum(F.size("right_grams"))).first()[0] or 0
    side = F.broadcast if grams * ENTRY_BYTES <= broadcast_limit else (lambda df: df.hint("merge"))
    n1, n2 = F.col("left_size"), F.col("right_size")
    i, j = F.col("left_place"), F.col("right_place")
    needed = threshold * (n1 + n2) / (1 + threshold) - SLACK
    close_lengths = (n1 >= threshold * n2 - SLACK) & (n2 >= threshold * n1 - SLACK)
    room = F.least(i, j) + F.least(n1 - i, n2 - j) >= needed
    bits = (n1 - _alone("left", "right") >= needed) & (n2 - _alone("right", "left") >= needed)
    return (
        _posted(left, "left")
        .join(side(_posted(right, "right")), (F.col("left_gram") == F.col("right_gram")) & close_lengths & room & bits)
        .select("left_hash", "right_hash")
    )


def scored_pairs(candidates: DataFrame, probes: DataFrame, listed: DataFrame, threshold: float) -> DataFrame:
    """Distinct ``(left_value, right_value, score)`` above the threshold, scored from the texts."""
    # stored, so that no rule of the optimizer cuts other probes into trigrams
    with_candidate = materialize(probes.join(candidates.select("left_hash").distinct(), "left_hash", "left_semi"), "with_candidate")
    common = F.size(F.array_intersect("left_grams", "right_grams"))
    score = F.col("common") / (F.size("left_grams") + F.size("right_grams") - F.col("common"))
    return (
        candidates.join(listed.withColumn("right_grams", packed_trigrams("right_value")), "right_hash")
        .join(with_candidate.withColumn("left_grams", packed_trigrams("left_value")), "left_hash")
        .select("left_value", "right_value", "left_grams", "right_grams", _once(common).alias("common"))
        .select("left_value", "right_value", score.alias("score"))
        .filter(F.col("score") > threshold)
        .distinct()
    )


def similar_values(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    threshold: float,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Distinct ``(left_value, right_value, score)`` with a score above the threshold.

    The listed values and the candidate pairs (two hashes each) are stored in between, so building this plan runs
    jobs.
    """
    probes = _distinct_values(left, left_value, "left")
    listed = materialize(_distinct_values(right, right_value, "right"), "listed")
    order = gram_order(listed)
    index = materialize(signed_values(listed, "right", order, threshold), "index")
    least, most = index.agg(F.min("right_size"), F.max("right_size")).first()
    # stored, so that no rule of the optimizer moves the work on a value behind the explosion
    signed = materialize(signed_values(probes, "left", order, threshold, (least or 0, most or 0)), "signed")
    candidates = candidate_rows(signed, index, threshold, broadcast_limit).distinct()
    return scored_pairs(materialize(candidates, "candidates"), probes, listed, threshold)


def similarity_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    threshold: float = 0.7,
    *,
    include_equal: bool = False,
    score: str = "similarity_score",
    broadcast_limit: int = BROADCAST_LIMIT,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """All row pairs scoring above the threshold, with the score.

    ``pairs`` are similar values found before (``left_value, right_value, score``); without them they are found here.
    ``include_equal`` adds pairs of equal texts without any trigram (two empty names); other equal
    texts score 1 and are found anyway.
    """
    if pairs is None:
        pairs = similar_values(left, right, left_on, right_on, threshold, broadcast_limit)
    if include_equal:
        blank = _distinct_values(right, right_on, "right").filter(~F.col("right_value").rlike(r"[\p{L}\p{N}]"))
        equal = blank.select(F.col("right_value").alias("left_value"), "right_value", F.lit(0.0).alias("score"))
        pairs = pairs.unionByName(equal)
    pairs = pairs.withColumnRenamed("score", score)
    return (
        left.join(pairs, F.col(left_on) == F.col("left_value"))
        .join(right, F.col("right_value") == F.col(right_on))
        .drop("left_value", "right_value")
    )
