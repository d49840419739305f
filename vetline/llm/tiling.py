"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of `words` words (a seed) are compared: the longest common
run of words not yet marked is marked, again and again, until none of `words` words is left. Runs are found
with Karp-Rabin hashes of `words` words and grown along them. The share of the item's words so covered does
not depend on the order of its passages. From `coverage` on the document is contaminated by the item.

Words are lower-cased (A-Z). Null and empty texts share nothing. Items of fewer than `words` words cannot
hold a seed and are not searched. Of items with one id the best covered counts. Rows that repeat an id, or id and
text, give a row each; a null id stays null. Texts of any length are compared whole. Empty tables give no rows; other columns are not read.

Items of up to BROADCAST_WORDS words in all are sent to every task, and texts are not shuffled. Beyond that
bound seeds of both sides are joined and counted, and a text goes only to the items that its shared seeds could
cover enough of.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.kernels import LOWER, sequence_hashes, slices, word_hashes, words
from vetline.session import materialize

WORDS = 5
COVERAGE = 0.8
BROADCAST_WORDS = 1 << 20
RESULT = "doc_id long, mark long, item_id long, n_words long, n_covered long, n_tiles long, coverage double"


def tiles(at_text: np.ndarray, at_item: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (text place, item place, length) from all places where both hold the same `n` words.

    Longest first; ties go to the smaller item place, then the smaller text place.
    """
    lane = at_text - at_item
    order = np.lexsort((at_item, lane))
    lane, at_item = lane[order], at_item[order]
    split = np.flatnonzero((np.diff(lane) != 0) | (np.diff(at_item) != 1)) + 1
    edges = np.concatenate([[0], split, [len(lane)]])
    heap = [(-(int(b - a) + n - 1), int(at_item[a]), int(at_item[a] + lane[a])) for a, b in pairwise(edges)]
    heapq.heapify(heap)
    used_text: set[int] = set()
    used_item: set[int] = set()
    out = []
    while heap:
        size, item, text = heapq.heappop(heap)
        free = [item + i not in used_item and text + i not in used_text for i in range(-size)]
        if all(free):
            out.append((text, item, -size))
            used_item.update(range(item, item - size))
            used_text.update(range(text, text - size))
            continue
        start = None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                if i - start >= n:
                    heapq.heappush(heap, (start - i, item + start, text + start))
                start = None
    return out


class Seeds:
    """The items' seeds: sorted distinct hashes and, for each, the items and places that hold it."""

    def __init__(self, items: list[tuple[int, np.ndarray]], n: int):
        self.n = n
        self.ids = [item for item, _ in items]
        self.sizes = [len(hashes) for _, hashes in items]
        runs = [(i, sequence_hashes(hashes, n)) for i, (_, hashes) in enumerate(items)]
        runs = [(item, run) for item, run in runs if len(run)]
        every = np.concatenate([run for _, run in runs]) if runs else np.zeros(0, np.uint64)
        item = np.concatenate([np.full(len(run), i) for i, run in runs]) if runs else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(run)) for _, run in runs]) if runs else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, first = np.unique(every[order], return_index=True)
        self.edges = np.concatenate([first, [len(every)]])
        # most words of texts belong to no seed: one bit per hash value modulo 2**22 says so
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.keys & np.uint64((1 << 22) - 1)] = True

    def compare(self, hashes: np.ndarray, coverage: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(item, its words, covered words, tiles, coverage) for the items that the text covers enough of."""
        runs = sequence_hashes(hashes, self.n)
        at = np.flatnonzero(self.maybe[runs & np.uint64((1 << 22) - 1)])
        if not len(at) or not len(self.keys):
            return
        slot = np.minimum(np.searchsorted(self.keys, runs[at]), len(self.keys) - 1)
        real = self.keys[slot] == runs[at]
        at, slot = at[real], slot[real]
        counts = self.edges[slot + 1] - self.edges[slot]
        listed = np.repeat(self.edges[slot] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        item, place, text = self.item[listed], self.place[listed], np.repeat(at, counts)
        best: dict[int, tuple[int, int, int, int, float]] = {}
        for i in np.unique(item).tolist():
            own = item == i
            covered = np.zeros(self.sizes[i], bool)
            for shift in range(self.n):
                covered[place[own] + shift] = True
            if covered.sum() < coverage * self.sizes[i]:
                continue  # tiles cover no more than all seeds do
            found = tiles(text[own], place[own], self.n)
            n_covered = sum(size for _, _, size in found)
            share = n_covered / self.sizes[i]
            if n_covered >= coverage * self.sizes[i] and share > best.get(self.ids[i], (0,) * 5)[4]:
                best[self.ids[i]] = (self.ids[i], self.sizes[i], n_covered, len(found), share)
        yield from best.values()


def _hashed(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, data, offsets in slices(column):
        data = LOWER[data]
        starts, ends, first = words(data, offsets)
        hashes = word_hashes(data, starts, ends)
        for a, b in pairwise(first.tolist()):
            yield hashes[a:b]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.float64()]
    names = ["doc_id", "mark", "item_id", "n_words", "n_covered", "n_tiles", "coverage"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def _compare_all(batches: Iterator[pa.RecordBatch], seeds, coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for doc, mark, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _hashed(batch.column(2)), strict=True):
            found += [(doc, mark, *row) for row in seeds.value.compare(hashes, coverage)]
        yield _batch(found)


def _compare_pairs(batches: Iterator[pa.RecordBatch], n: int, coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, found = [], []
        for key, hashes, item, own in zip(batch.column(0).to_pylist(), _hashed(batch.column(1)), batch.column(2).to_pylist(), _hashed(batch.column(3)), strict=True):
            for row in Seeds([(item, own)], n).compare(hashes, coverage):
                keys.append(key)
                found.append((None, None, *row))
        rest = _batch(found)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *rest.columns[2:]], ["key", *rest.schema.names[2:]])


def _seed_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row per distinct seed of a text: key, seed, at how many places, and the words of the text."""
    for batch in batches:
        for at, hashes in enumerate(_hashed(batch.column(1))):
            seeds, places = np.unique(sequence_hashes(hashes, n), return_counts=True)
            key = batch.column(0).slice(at, 1).take(pa.array(np.zeros(len(seeds), np.int32)))
            yield pa.RecordBatch.from_arrays([key, pa.array(seeds.view(np.int64)), pa.array(places.astype(np.int64)), pa.array(np.full(len(seeds), len(hashes), np.int64))], ["key", "seed", "places", "words"])


def contaminated(docs: DataFrame, items: DataFrame, n: int = WORDS, coverage: float = COVERAGE, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """A row per contaminated document and item: doc_id, mark, item_id, n_words, n_covered, n_tiles, coverage.

    `mark` is a 64-bit hash of the text; with doc_id it names the row. An item with a null id is not searched.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("body")).filter("body is not null")
    tests = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("item_body")).filter("item_id is not null")
    # a word takes two bytes with the blank behind it, which bounds their number
    if (tests.agg(F.sum(F.octet_length("item_body") + 1)).first()[0] or 0) <= 2 * broadcast_words:
        held = [(r["item_id"], next(_hashed(pa.array([r["item_body"]])))) for r in tests.collect()]
        seeds = spark.sparkContext.broadcast(Seeds(held, n))
        return rows.mapInArrow(lambda it: _compare_all(it, seeds, coverage), RESULT)
    # a text is compared once however many rows hold it; each of these gets its result
    rows = rows.withColumn("key", F.unhex(F.md5("body")))
    texts = rows.select("key", "body").dropDuplicates(["key"])
    held = texts.mapInArrow(lambda it: _seed_rows(it, n), "key binary, seed long, places long, words long").select("key", "seed")
    posted = tests.select("item_id", "item_body").mapInArrow(lambda it: _seed_rows(it, n), "key long, seed long, places long, words long")
    posted = posted.groupBy(F.col("key").alias("item_id"), "seed").agg(F.sum("places").alias("places"), F.min("words").alias("words"))
    # a pair meets only where the places of its shared seeds could cover enough of the item
    enough = F.col("places") * n >= coverage * F.col("words")
    shared = held.join(posted, "seed").groupBy("key", "item_id").agg(F.sum("places").alias("places"), F.min("words").alias("words")).filter(enough)
    pairs = materialize(shared.select("key", "item_id"), "seeded").join(tests, "item_id").join(texts, "key").select("key", "body", "item_id", "item_body")
    found = pairs.mapInArrow(lambda it: _compare_pairs(it, n, coverage), RESULT.replace("doc_id long, mark long", "key binary"))
    best = found.groupBy("key", "item_id").agg(F.max(F.struct("coverage", "n_words", "n_covered", "n_tiles")).alias("best"))
    return rows.join(best, "key").select("doc_id", "mark", "item_id", "best.n_words", "best.n_covered", "best.n_tiles", "best.coverage")
