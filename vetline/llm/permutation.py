"""Nearest neighbours with a permutation index.

A vector is represented by its `prefix` nearest pivots in order. The index is cut into shards of about
`shard_rows` vectors, whatever their number; each shard keeps an inverted file per pivot, which posts the
vectors that have this pivot among their nearest together with its place. A query goes to every shard; there it
scans the files of its own nearest pivots, and what it reads adds up to the footrule distance of the two
orders (pivots missing from an order stand at its end). The closest `examine` share of the shard by footrule, and
all that tie with the last of them, are ranked again by exact cosine in double precision. Only each shard's k best
per query leave the shard.

Equal vectors are indexed once, with their k + 1 smallest ids and how often each occurs (k at most): one more than a
query can return, as its own id is left out. A hit is expanded to these ids.

Pivots are drawn from the distinct vectors with the smallest hash, at most PIVOT_SAMPLE of them; one that is
too close to a pivot chosen before is passed over, and taken after all if pivots are missing: vectors that all lie in
one cone need pivots among them to be told apart. The sample is for the pivots only: every vector is indexed.

Vectors that are null, zero or of another length than most, or hold null or non-finite values, take no part. Rows that repeat
an id are candidates of their own; a query's own id is no candidate. Rows with a null id take no part. Equal
scores go to the smaller id. With fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 512
PREFIX = 128
PIVOT_SAMPLE = 4096
PIVOT_COSINE = 0.8
SHARD_ROWS = 8192
EXAMINE = 0.15
_BLOCK = 2048


def choose_pivots(vectors: np.ndarray, n: int = PIVOTS, limit: float = PIVOT_COSINE) -> np.ndarray:
    """Up to n different unit vectors; those with a cosine above `limit` to one before come after all others."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    _, first = np.unique(unit, axis=0, return_index=True)
    unit = unit[np.sort(first)]
    chosen: list[int] = []
    passed: list[int] = []
    for i in range(len(unit)):
        if len(chosen) == n:
            break
        if not chosen or (unit[chosen] @ unit[i]).max() <= limit:
            chosen.append(i)
        else:
            passed.append(i)
    return unit[chosen + passed[: n - len(chosen)]]


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the nearest pivots of each vector, nearest first."""
    closeness = unit @ pivots.T
    if prefix < closeness.shape[1]:
        part = np.argpartition(-closeness, prefix - 1, axis=1)[:, :prefix]
        inner = np.argsort(-np.take_along_axis(closeness, part, axis=1), axis=1, kind="stable")
        return np.take_along_axis(part, inner, axis=1)
    return np.argsort(-closeness, axis=1, kind="stable")


class Shard:
    """The inverted files of one shard, and its vectors."""

    def __init__(self, ids: np.ndarray, times: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        """Each distinct vector has a row of ascending ids and of how often they occur, 0 where there are fewer ids."""
        self.ids, self.times, self.vectors = ids, times, vectors
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.pivots, self.prefix = pivots, min(prefix, len(pivots))
        ranks = np.concatenate([nearest_pivots(self.vectors[i : i + _BLOCK] / self.norms[i : i + _BLOCK, None], pivots, self.prefix) for i in range(0, len(ids), _BLOCK)])
        posted = ranks.ravel()
        by_pivot = np.argsort(posted, kind="stable")
        self.rows = by_pivot // self.prefix
        self.places = by_pivot % self.prefix
        self.edges = np.searchsorted(posted[by_pivot], np.arange(len(pivots) + 1))

    def search(self, query_id: int, vector: np.ndarray, k: int, examine: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the best k, best first, ties to the smaller id."""
        unit = vector / np.linalg.norm(vector)
        shared = np.zeros(len(self.ids), np.int64)
        for place, pivot in enumerate(nearest_pivots(unit[None], self.pivots, self.prefix)[0].tolist()):
            a, b = self.edges[pivot], self.edges[pivot + 1]
            # |place - other| in place of both pivots' distance to the end: footrule = constant - 2 * shared
            shared[self.rows[a:b]] += self.prefix - np.maximum(self.places[a:b], place)
        asks = self.ids[:, 0] == query_id
        own = asks & (self.times[:, 1] == 0)
        shared[own] = -1
        n = min(len(self.ids), max(int(np.ceil(examine * len(self.ids))), 16 * k))
        rows = np.flatnonzero((shared >= -np.partition(-shared, n - 1)[n - 1]) & ~own)
        cosines = (self.vectors[rows] @ vector) / (self.norms[rows] * np.linalg.norm(vector))
        best = np.lexsort((np.where(asks[rows], self.ids[rows, 1], self.ids[rows, 0]), -cosines))[:k]
        ids, times = self.ids[rows[best]], self.times[rows[best]]
        times = np.where(ids == query_id, 0, times).ravel()
        ids, cosines = np.repeat(ids.ravel(), times), np.repeat(np.repeat(cosines[best], self.ids.shape[1]), times)
        best = np.lexsort((ids, -cosines))[:k]
        return ids[best], cosines[best]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _search(batches: Iterator[pa.RecordBatch], pivots, prefix: int, k: int, examine: float) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, its vectors before the queries; a shard is held whole, queries pass by."""
    number, held, shard = None, [], None
    for batch in batches:
        shards, is_query, ids, matrix = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), _matrix(batch.column(3))
        copies, times = _matrix(batch.column(4)), _matrix(batch.column(5))
        found = []
        edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(is_query.astype(np.int8)) != 0)) + 1
        for a, b in pairwise([0, *edges.tolist(), len(ids)]):
            if a == b:
                continue
            if shards[a] != number:
                number, held, shard = shards[a], [], None
            if not is_query[a]:
                held.append((copies[a:b].copy(), times[a:b].copy(), matrix[a:b].astype(np.float64)))
                continue
            if shard is None and held:
                shard, held = Shard(*(np.concatenate(x) for x in zip(*held, strict=True)), pivots.value, prefix), []
            if shard is not None:
                for query_id, vector in zip(ids[a:b].tolist(), matrix[a:b].astype(np.float64), strict=True):
                    near, cosines = shard.search(query_id, vector, k, examine)
                    found.append((np.full(len(near), query_id), near, cosines))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def nearest(table: DataFrame, queries: str = "vec_id % 50 = 0", k: int = 5, vector: str = "embedding", vec_id: str = "vec_id", pivots: int = PIVOTS, prefix: int = PREFIX, examine: float = EXAMINE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k nearest rows by cosine of every row that `queries` (a condition on vec_id) holds for.

    Returns query_id, rank (from 1), vec_id, score. Of rows with one query id the least vector asks.
    """
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.filter("vec_id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("v")).alias("vectors"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    width, vectors = (most["size"], most["vectors"]) if most else (1, 0)
    rows = rows.filter(F.size("v") == width)
    # distinct vectors by hash, so that copies do not fill the sample
    thinned = rows.select("v", F.xxhash64("v").alias("hash")).filter(F.pmod("hash", F.lit(max(1, vectors // (4 * PIVOT_SAMPLE)))) == 0)
    sample = thinned.distinct().orderBy("hash").limit(PIVOT_SAMPLE).select(F.col("v").cast("array<double>").alias("v")).toArrow()
    drawn = sample.column("v").combine_chunks().flatten().to_numpy()
    held = spark.sparkContext.broadcast(choose_pivots(drawn.reshape(-1, width), pivots))
    shards = max(1, -(-vectors // shard_rows))
    smallest = Window.partitionBy("v").orderBy("vec_id")
    copies = rows.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("times")).withColumn("at", F.row_number().over(smallest)).filter(F.col("at") <= k + 1)
    distinct = copies.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "times"))).alias("held"))

    def filled(values: str) -> Column:
        return F.expr(f"concat({values}, array_repeat(0L, {k + 1} - size({values})))")

    index = distinct.select(F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), F.lit(False).alias("query"), F.lit(0).cast("long").alias("vec_id"), "v", filled("held.vec_id").alias("ids"), filled("held.times").alias("times"))
    asking = rows.filter(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asking.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(True).alias("query"), "vec_id", "v", F.array_repeat(F.lit(0).cast("long"), k + 1).alias("ids"), F.array_repeat(F.lit(0).cast("long"), k + 1).alias("times"))
    ordered = index.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "query")
    found = ordered.mapInArrow(lambda it: _search(it, held, prefix, k, examine), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
