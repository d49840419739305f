"""Similar pairs of two growing sets of texts, kept up to date from what is new."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.operators.similarity import BROADCAST_LIMIT, WORDS, _distinct_values, candidate_rows, gram_order, scored_pairs, signed_values
from vetline.session import materialize

_BITS = "struct<" + ", ".join(f"w{k}: bigint" for k in range(WORDS)) + ">"
VALUES = f"side string, hash bigint, text string, size int, bits {_BITS}, grams array<bigint>"
PAIRS = "left_value string, right_value string, score double"


class PairStore:
    """Signed values of both sides and their similar pairs, in batches.

    The order of the trigrams is frozen with the first batch, so a signature made once stays valid: any order is
    exact, and a list that has changed much only makes it less cheap. An update signs the texts that it has not seen
    and joins new probes with the whole list and old probes with new names; pairs of old texts are read as they are.
    Texts that are gone stay in the store: who joins the pairs with present rows does not meet them.

    A batch counts once its commit is written, after pairs and values; what a failed update leaves is
    overwritten by the next. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float, broadcast_limit: int = BROADCAST_LIMIT):
        self.spark, self.path, self.threshold, self.broadcast_limit = spark, path.rstrip("/"), threshold, broadcast_limit

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, batch int").parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{schema}, batch int")

    def last_batch(self) -> int:
        """The last committed batch, -1 before the first."""
        last = self._table("commits", "values bigint").agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def _values(self, side: str, last: int) -> DataFrame:
        held = self._table("values", VALUES).filter((F.col("batch") <= last) & (F.col("side") == side))
        return held.select(F.col("text").alias(f"{side}_value"), *[F.col(c).alias(f"{side}_{c}") for c in ("hash", "size", "bits", "grams")])

    def pairs(self) -> DataFrame:
        """``(left_value, right_value, score)`` of all texts seen, each pair once."""
        return self._table("pairs", PAIRS).filter(F.col("batch") <= self.last_batch()).drop("batch")

    def _order(self, listed: DataFrame) -> bytes:
        """The trigrams' order, from the list of the first batch."""
        stored = self._table("order", "ranks binary").first()
        if stored is None:
            ranks = gram_order(listed)
            self.spark.createDataFrame([(ranks,)], "ranks binary").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/order/batch=0")
            return ranks
        return bytes(stored["ranks"])

    def _new(self, df: DataFrame, column: str, side: str, known: DataFrame) -> DataFrame:
        seen = known.select(f"{side}_hash", f"{side}_value")
        # texts without a letter or digit have no trigram and no pair
        values = _distinct_values(df.filter(F.col(column).rlike(r"[\p{L}\p{N}]")), column, side)
        return materialize(values.join(seen, [f"{side}_hash", f"{side}_value"], "left_anti"), f"new_{side}")

    def update(self, left: DataFrame, right: DataFrame, left_value: str, right_value: str) -> DataFrame:
        """Take in the texts of both sides; all pairs as stored."""
        last = self.last_batch()
        known = {side: self._values(side, last) for side in ("left", "right")}
        fresh = {"left": self._new(left, left_value, "left", known["left"]), "right": self._new(right, right_value, "right", known["right"])}
        if all(values.isEmpty() for values in fresh.values()):
            return self.pairs()
        order = self._order(fresh["right"])
        signed = {
            side: materialize(values.join(signed_values(values, side, order, self.threshold), f"{side}_hash"), f"signed_{side}") for side, values in fresh.items()
        }
        listed = known["right"].unionByName(signed["right"])
        met = candidate_rows(signed["left"], listed, self.threshold, self.broadcast_limit).union(
            candidate_rows(known["left"], signed["right"], self.threshold, self.broadcast_limit)
        )
        candidates = materialize(met.distinct(), "candidates")
        texts = {side: known[side].select(f"{side}_value", f"{side}_hash").unionByName(signed[side].select(f"{side}_value", f"{side}_hash")) for side in known}
        found = scored_pairs(candidates, texts["left"], texts["right"], self.threshold)
        batch = last + 1
        found.write.mode("overwrite").parquet(f"{self.path}/pairs/batch={batch}")
        columns = ("hash", "value", "size", "bits", "grams")
        rows = [signed[side].select(F.lit(side).alias("side"), *[F.col(f"{side}_{c}").alias("text" if c == "value" else c) for c in columns]) for side in signed]
        rows[0].unionByName(rows[1]).write.mode("overwrite").parquet(f"{self.path}/values/batch={batch}")
        # the commit
        self.spark.range(1).select(F.lit(sum(values.count() for values in fresh.values())).cast("long").alias("values")).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/commits/batch={batch}"
        )
        return self.pairs()
