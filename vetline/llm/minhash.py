"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets fold into one class first. Classes that share a band of MinHash values
are candidates. Byte-sized signatures of candidates are compared batch by batch; a pair is dropped as soon
as the posterior probability that its similarity reaches the threshold falls below `miss`. Surviving pairs
are confirmed on their full shingle sets, and links become components.

A band's bucket does not yield all its pairs. Its first member is compared with all others, and the links so
found are joined into components. Then only members of different components can still change anything. They
are compared within tasks, bucket by bucket, on their signatures; what leaves a task is at most one row per
member, which ties members with promising pairs into clusters. The texts of a cluster meet in a task, which takes
exact intersections of members that links have not joined meanwhile; again at most one row per member leaves. Large buckets and clusters are cut into tiles, and tiles meet in pairs, so that every pair meets.

The number of rows in a band is the largest at which `hashes` values leave a true pair without a common
band with a probability of at most `miss`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.components import components
from vetline.llm.kernels import mix64, shingle_sets, slices
from vetline.session import materialize

HASHES = 336
BATCH = 48
MISS = 1e-6
TILE_ROWS = 2048
TILE_BYTES = 8 << 20
FILTER_BITS = 1 << 26


def bands(threshold: float, hashes: int = HASHES, miss: float = MISS) -> tuple[int, int]:
    """Rows of a band and number of bands."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** (hashes // (rows + 1)) <= miss:
        rows += 1
    return rows, hashes // rows


def least_matches(threshold: float, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """After n compared values, the fewest matches with which P(similarity >= threshold | matches) >= miss.

    The prior of the match rate is uniform. Signatures keep one byte of each value, so that two
    different values agree once in 256 times.
    """
    rate = threshold + (1 - threshold) / 256
    out = []
    for n in range(batch, hashes + 1, batch):
        # the posterior is Beta(m + 1, n - m + 1); its upper tail is a binomial sum
        terms = [math.comb(n + 1, k) * rate**k * (1 - rate) ** (n + 1 - k) for k in range(n + 2)]
        tails = np.cumsum(terms)  # tails[m] = P(rate of matches >= `rate` | m matches)
        out.append((n, int(np.searchsorted(tails, miss))))
    return out


def signatures(sets: np.ndarray, seeds: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over one set of shingle hashes."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(seeds), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 1024):
        part = x[lo : lo + 1024]
        np.minimum(least, (seeds[:, None] * part[None, :] + shifts[:, None]).min(axis=1), out=least)
    return least


def _code(least: np.ndarray) -> np.ndarray:
    """One byte of each value, mixed from all of its bits."""
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _functions(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = mix64(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return (drawn >> np.uint64(32)).astype(np.uint32) | np.uint32(1), drawn.astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch], words: int, hashes: int, rows: int) -> Iterator[pa.RecordBatch]:
    seeds, shifts = _functions(hashes)
    n_bands = hashes // rows
    factors = mix64(np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
    places = mix64(np.arange(1, n_bands + 1, dtype=np.uint64))
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            ids, marks = batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo)
            counts, digests, codes, keys = [], [], [], []
            for own in shingle_sets(data, offsets, words):
                counts.append(len(own))
                if not len(own):
                    digests.append(None)
                    codes.append(None)
                    keys.append(None)
                    continue
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                least = signatures(own, seeds, shifts)
                codes.append(_code(least).tobytes())
                held = least[: n_bands * rows].reshape(n_bands, rows).astype(np.uint64)
                keys.append(mix64((held * factors).sum(axis=1, dtype=np.uint64) ^ places).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, marks, pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(codes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "mark", "n_shingles", "digest", "code", "bands"],
            )


def _prune(batches: Iterator[pa.RecordBatch], stops: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(len(batch), -1) for i in (4, 5))
        alive = np.arange(len(batch))
        matches = np.zeros(len(batch), np.int64)
        done = 0
        for n, least in stops:
            matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
            alive = alive[matches[alive] >= least]
            done = n
        yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in range(4)], ["a", "b", "mark_a", "mark_b"])


def _confirm(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            sets = [[s for _, _, data, offsets in slices(part.column(i)) for s in shingle_sets(data, offsets, words)] for i in (2, 3)]
            keep = [_linked(x, y, percent) for x, y in zip(*sets, strict=True)]
            yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _near_wanted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows of `texts` whose node is one of `wanted`, and few others: those with an equal place in a bitmap.

    The bitmap has FILTER_BITS bits however many nodes there are, and is broadcast, so that the join that has to
    follow shuffles few of the texts that nobody asks for.
    """
    place = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    bits = (
        wanted.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("position"))
        .repartition("part")  # tasks send places, not a bitmap each
        .groupBy("part")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
    )
    placed = texts.withColumns({"own_part": F.bitmap_bucket_number(place), "own_bit": F.bitmap_bit_position(place)})
    is_set = F.expr("shiftright(cast(conv(hex(substring(bits, cast(own_bit DIV 8 AS int) + 1, 1)), 16, 10) AS int), cast(own_bit % 8 AS int)) % 2 = 1")
    return placed.join(F.broadcast(bits), (F.col("own_part") == F.col("part")) & is_set, "left_semi").select(*texts.columns)


def _links(pairs: DataFrame, codes: DataFrame, texts: DataFrame, words: int, percent: int, stops: list) -> DataFrame:
    """The candidate pairs (a, b) that hold on the full sets."""
    sides = [(F.col("node").alias(x), F.col("mark").alias(f"mark_{x}")) for x in ("a", "b")]
    left, right = (codes.select(*side, F.col("code").alias(f"code_{x}")) for side, x in zip(sides, "ab", strict=True))
    alive = materialize(
        pairs.join(left, "a").join(right, "b").select("a", "b", "mark_a", "mark_b", "code_a", "code_b").mapInArrow(lambda it: _prune(it, stops), "a long, b long, mark_a long, mark_b long"),
        "alive",
    )
    asked = (_near_wanted(texts, alive.select(F.col(x).alias("node"))) for x in ("a", "b"))
    left, right = (own.select(*side, F.col("body").alias(f"body_{x}")) for own, side, x in zip(asked, sides, "ab", strict=True))
    full = alive.join(left, ["a", "mark_a"]).join(right, ["b", "mark_b"]).select("a", "b", "body_a", "body_b")
    return materialize(full.mapInArrow(lambda it: _confirm(it, words, percent), "a long, b long").distinct(), "links")


def _tiled(rows: DataFrame, group: str, tiles: str) -> DataFrame:
    """Each row for every pair of tiles of its group that holds its own; ordered by (group, one, other)."""
    own = F.pmod(F.xxhash64("node"), F.col(tiles))
    paired = rows.withColumn("tile", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col(tiles) - 1)))
    keyed = paired.withColumns({"one": F.least("tile", "with"), "other": F.greatest("tile", "with")}).drop("tile", "with", tiles)
    return keyed.repartition(group, "one", "other").sortWithinPartitions(group, "one", "other", "node")


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    """Runs of rows with equal (group, one, other), as tuples of `columns`."""
    held: list[tuple] = []
    key = None
    for batch in batches:
        keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        for own, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if own != key:
                if len(held) > 1:
                    yield held
                key, held = own, []
            held.append(row)
    if len(held) > 1:
        yield held


def _promising(codes: np.ndarray, i: int, others: np.ndarray, stops: list[tuple[int, int]]) -> np.ndarray:
    """Those of `others` whose signatures do not rule out a link with i, the best first."""
    matches = np.zeros(len(others), np.int64)
    done = 0
    for n, least in stops:
        matches += (codes[others, done:n] == codes[i, done:n]).sum(axis=1)
        alive = matches >= least
        others, matches, done = others[alive], matches[alive], n
    return others[np.argsort(-matches, kind="stable")]


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _cluster(batches: Iterator[pa.RecordBatch], stops: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Edges that tie members with promising pairs between different labels together."""
    for group in _groups(batches, ["node", "label", "code"]):
        nodes, labels = np.array([g[0] for g in group]), np.array([g[1] for g in group])
        codes = np.frombuffer(b"".join(g[2] for g in group), np.uint8).reshape(len(group), -1)
        root = np.arange(len(nodes))
        pairs = []
        for i in range(len(nodes) - 1):
            others = np.flatnonzero((labels != labels[i]) & (root != root[i]))
            for j in _promising(codes, i, others[others > i], stops).tolist():
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    pairs.append((int(nodes[i]), int(nodes[j])))
        yield _pair_batch(pairs)


def _confirm_clusters(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between different labels, as many as it takes to join what is linked.

    A member's shingles are marked once, which gives its exact intersections with all others in one pass.
    """
    for group in _groups(batches, ["node", "label", "body"]):
        nodes = np.array([g[0] for g in group])
        sets = [s for _, _, data, offsets in slices(pa.array([g[2] for g in group], pa.binary())) for s in shingle_sets(data, offsets, words)]
        sizes = np.array([len(own) for own in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
        root = np.unique([g[1] for g in group], return_inverse=True)[1]
        marked = np.zeros(int(numbers.max()) + 1, np.int64)
        pairs = []
        for i in range(len(nodes) - 1):
            if (root[i + 1 :] == root[i]).all():
                continue
            own = numbers[starts[i] : starts[i + 1]]
            marked[own] = 1
            common = np.add.reduceat(marked[numbers[starts[i + 1] :]], starts[i + 1 : -1] - starts[i + 1])
            marked[own] = 0
            linked = 100 * common >= percent * (sizes[i] + sizes[i + 1 :] - common)
            for j in (np.flatnonzero(linked) + i + 1).tolist():
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    pairs.append((int(nodes[i]), int(nodes[j])))
        yield _pair_batch(pairs)


def _links_between(members: DataFrame, labels: DataFrame, codes: DataFrame, texts: DataFrame, words: int, percent: int, stops: list) -> DataFrame:
    """The links that join different components and share a bucket."""
    named = members.select("band", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
    open_ = named.join(mixed.select("band", F.ceil(F.col("n") / TILE_ROWS).alias("tiles")), "band").join(codes.select("node", "code"), "node")
    tied = _tiled(open_.select("band", "node", "label", "code", "tiles"), "band", "tiles").select("band", "one", "other", "node", "label", "code")
    edges = materialize(tied.mapInArrow(lambda it: _cluster(it, stops), "a long, b long").distinct(), "tied")
    clusters = materialize(components(edges).withColumnRenamed("label", "cluster"), "clusters")
    named = clusters.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).join(codes.select("node", "mark"), "node")
    rows = named.join(_near_wanted(texts, clusters), ["node", "mark"])
    rows = rows.dropDuplicates(["node", "mark"])  # rows may repeat id and text
    tiles = rows.groupBy("cluster").agg(F.ceil(F.sum(F.length("body") + 1) / TILE_BYTES).alias("tiles"))
    met = _tiled(rows.join(tiles, "cluster").select("cluster", "node", "label", "body", "tiles"), "cluster", "tiles").select("cluster", "one", "other", "node", "label", "body")
    return materialize(met.mapInArrow(lambda it: _confirm_clusters(it, words, percent), "a long, b long"), "more_links")


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5, text: str = "text", doc_id: str = "doc_id", hashes: int = HASHES, miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, mark, n_shingles, component_id (the smallest id reachable), kept (it is that id).

    `mark` is a 64-bit hash of the text.
    Links join documents with 100 * intersection >= percent * union of their sets of `words`-word shingles.
    Null, empty and blank texts have empty sets and are linked with nothing. Rows that repeat an id give a
    row each. A null id stays null; such a row takes part as a copy of an equal set, not as a near copy,
    and is kept where its component has no id. An empty table gives no rows; other columns are not read.
    """
    rows_in_band, _ = bands(percent / 100, hashes, miss)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("mark", F.xxhash64("body"))
    signed = materialize(
        rows.mapInArrow(lambda it: _sign(it, words, hashes, rows_in_band), "doc_id long, mark long, n_shingles long, digest binary, code binary, bands array<long>"),
        "signed",
    )
    # any member can speak for its class, as all have one set; the one with the smallest id does
    classes = materialize(
        signed.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("head"), F.first("code").alias("code"), F.first("bands").alias("bands"))
        .select("digest", F.col("head.doc_id").alias("node"), F.col("head.mark").alias("mark"), "code", "bands"),
        "classes",
    )
    # dealt by band once, for the buckets and for their members
    banded = classes.filter("node is not null").select("node", F.explode("bands").alias("band")).repartition("band")
    buckets = banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    members = materialize(banded.join(buckets.select("band", "first"), "band"), "buckets")
    codes = classes.filter("node is not null").select("node", "mark", "code")
    texts = rows.filter("doc_id is not null").select(F.col("doc_id").alias("node"), "mark", "body")
    stops = least_matches(percent / 100, hashes, miss=miss)
    tried = members.filter("node > first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = _links(tried, codes, texts, words, percent, stops)
    labels = materialize(components(links), "labels")
    more = _links_between(members, labels, codes, texts, words, percent, stops)
    final = components(links.union(more))
    grouped = signed.select("doc_id", "mark", "n_shingles", "digest").join(classes.select("digest", "node"), "digest", "left").join(final, "node", "left")
    return grouped.select("doc_id", "mark", "n_shingles", F.coalesce("label", "node", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
