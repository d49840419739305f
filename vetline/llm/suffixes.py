"""Removal of long repeated substrings with two-stage suffix sorting.

Every byte covered by a `length`-byte string that also starts anywhere else is removed.

1. Each `length`-byte window names an anchor: the smallest hash among its GRAM-byte grams. Equal windows
   name the same gram at the same place within them, so only windows with one anchor value can be equal.
   All windows that name one anchor lie together; their union is the anchor's region, about 1.5 windows long.
2. Regions whose anchor value stands nowhere else hold no repeat and go. Regions equal byte for byte fold
   into one class; with two members or more, all of their windows are repeats. Equal regions that touch
   within a text (a text of short periods has very many) are one row from the start.
3. Classes that share an anchor value but differ are sorted. Their bytes are put one behind the other and
   suffixes are sorted in two stages: those smaller than their successors directly, the others induced by
   scanning the buckets of first bytes. Adjacent suffixes with a common prefix of `length` bytes are repeats.
4. Classes of an anchor value with very many of them (a passage in a large part of all texts) are not sorted in
   one place: the hashes of their windows are counted instead, which splits over all tasks and gives the same.

Rows of an anchor value with very many regions are not brought to one task: these few values are broadcast, and
the rows stay where they are. Nor are rows of a large class: those that are not in one are taken out by their places.

Texts are compared as UTF-8 bytes. Null and empty texts have no bytes. Repeated rows and rows with equal ids
are texts of their own: each is a repeat of the other. Null ids stay null. An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.kernels import mix64, prefix_sums, slices, window_hashes
from vetline.llm.rowkeys import row_key
from vetline.session import materialize

GRAM = 160
SORT_CLASSES = 4096
SORT_BYTES = 1 << 20
HOT_ROWS = 1024
_SEGMENT = 1 << 20
_SLICES = 4096
_BREAK = 0xFF  # never part of UTF-8


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest value of each window of `size` (one for each start)."""
    n = len(values) - size + 1
    padded = -(-len(values) // size) * size
    held = np.full(padded, np.iinfo(values.dtype).max, values.dtype)
    held[: len(values)] = values
    blocks = held.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[size - 1 : size - 1 + n])


def regions(text: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor value, start and end of the region, hash of the region, and the anchor's place in it.

    Long texts go in segments that overlap by a window, so that memory does not follow their length;
    each window belongs to one segment.
    """
    low = np.uint64((1 << 24) - 1)
    for base in range(0, max(len(text) - length + 1, 0), _SEGMENT):
        part = text[base : base + _SEGMENT + length - 1]
        sums = prefix_sums(part)
        at = np.arange(len(part) - gram + 1)
        hashes = mix64(window_hashes(sums, at, at + gram))
        # the place breaks ties to the left; it is the same in equal windows
        chosen = (window_minima((hashes & ~low) | at.astype(np.uint64), length - gram + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.concatenate([first[1:], [len(chosen)]]) - 1
        anchors = chosen[first]
        yield hashes[anchors], base + first, base + last + length, window_hashes(sums, first, last + length), anchors - first


def _firsts(data: np.ndarray, wide: int = 8) -> np.ndarray:
    """The `wide` bytes from each place on as a number that orders as they do; zeros follow the end."""
    return np.ndarray(len(data), ">u8", data.tobytes() + bytes(8), strides=(1,)).astype(np.uint64) >> np.uint64(64 - 8 * wide)


def _in_order(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """`starts` in the order of their next `depth` bytes; ties keep their order.

    Large groups of equal beginnings go on by eight bytes at a time, small ones are sorted by the bytes that
    are left, so that only one small group's bytes are copied at once.
    """
    n, held, eights = len(data), data.tobytes(), _firsts(data)
    order, tied, group = starts.copy(), np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for step in range(0, depth, 8):
        at = order[tied] + step
        value = np.where(at < n, eights[np.minimum(at, n - 1)], np.uint64(0))
        turn = np.lexsort((value, group))
        order[tied], value = order[tied][turn], value[turn]
        first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (group[1:] != group[:-1])]))
        sizes = np.diff(np.append(first, len(tied)))
        small = (sizes > 1) & (sizes <= _SLICES)
        for a, size in zip(tied[first[small]].tolist(), sizes[small].tolist(), strict=True):
            order[a : a + size] = sorted(order[a : a + size].tolist(), key=lambda i: held[i + step + 8 : i + depth])
        large = np.repeat(sizes > _SLICES, sizes)
        tied, group = tied[large], np.repeat(np.arange(len(sizes)), sizes)[large]
        if not len(tied):
            break
    return order


def sorted_suffixes(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of `data` in the order of their first `depth` bytes at least, by two-stage sorting.

    `data` ends with a byte that is larger than all others. Suffixes smaller than their successors are
    sorted directly; each larger one follows from the place of its successor, in one scan over the
    buckets of first bytes.
    """
    n = len(data)
    # smaller[i]: suffix i < suffix i + 1. In a run of equal bytes it is as at the run's end.
    change = np.flatnonzero(np.concatenate([data[1:] != data[:-1], [True]]))
    run_end = change[np.searchsorted(change, np.arange(n))]
    following = np.minimum(run_end + 1, n - 1)
    smaller = (data[run_end] < data[following]) & (run_end + 1 < n)
    direct = np.flatnonzero(smaller)
    direct = _in_order(data, direct, depth) if len(direct) else direct
    direct_byte = data[direct]
    larger = np.flatnonzero(~smaller)
    larger = larger[np.argsort(data[larger], kind="stable")]
    larger_bounds = np.searchsorted(data[larger], np.arange(257))
    direct_bounds = np.searchsorted(direct_byte, np.arange(257))
    rank = np.full(n + 1, -1, np.int64)
    rank[n] = -1 if n else 0
    order = np.empty(n, np.int64)
    filled = 0
    for byte in range(256):
        own = larger[larger_bounds[byte] : larger_bounds[byte + 1]]
        if len(own):
            # successors in earlier buckets are placed already; the text's end comes before all
            successor = own + 1
            outside = (successor == n) | (data[np.minimum(successor, n - 1)] != byte)
            wave = own[outside]
            wave = wave[np.argsort(rank[wave + 1], kind="stable")]
            while len(wave):
                order[filled : filled + len(wave)] = wave
                rank[wave] = np.arange(filled, filled + len(wave))
                filled += len(wave)
                before = wave - 1
                before = before[before >= 0]
                wave = before[(data[before] == byte) & ~smaller[before]]
        ready = direct[direct_bounds[byte] : direct_bounds[byte + 1]]
        order[filled : filled + len(ready)] = ready
        rank[ready] = np.arange(filled, filled + len(ready))
        filled += len(ready)
    return order


def long_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each neighbour in `order` whether it shares `length` bytes with the one before."""
    n = len(data)
    room = np.flatnonzero((order[1:] + length <= n) & (order[:-1] + length <= n))
    wide = min(8, length)
    held = _firsts(data, wide)
    left, right = order[room], order[room + 1]
    for step in [*range(0, length - wide + 1, wide), length - wide]:
        same = held[left + step] == held[right + step]
        room, left, right = room[same], left[same], right[same]
    out = np.zeros(max(n - 1, 0), bool)
    out[room] = True
    return out


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the starts of its `length`-byte windows that also stand elsewhere in the list."""
    data = np.frombuffer(b"".join(t + bytes([_BREAK]) for t in texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order = sorted_suffixes(data, length)
    # windows that run over a break are none; without them all others stay neighbours
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = np.arange(len(data)) + length <= (begins + sizes)[owner]
    order = order[whole[order]]
    same = long_prefixes(data, order, length) if len(order) else np.zeros(0, bool)
    same = same[: max(len(order) - 1, 0)]
    hit = np.zeros(len(data), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    found = np.flatnonzero(hit)
    edges = np.searchsorted(owner[found], np.arange(len(texts) + 1))
    return [found[edges[i] : edges[i + 1]] - begins[i] for i in range(len(texts))]


def stretches(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of windows as disjoint stretches; touching ones are one."""
    if not len(starts):
        return []
    split = np.flatnonzero(np.diff(starts) > length) + 1
    firsts = starts[np.concatenate([[0], split])]
    lasts = starts[np.concatenate([split - 1, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + length).tolist(), strict=True))


def _find_regions(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, data, offsets in slices(batch.column(1)):
            keys = batch.column(0).slice(lo, len(offsets) - 1)
            rows, parts = [], []
            for i in range(len(offsets) - 1):
                for found in regions(data[offsets[i] : offsets[i + 1]], length, gram):
                    rows.append(np.full(len(found[0]), i))
                    parts.append(found)
            if not rows:
                continue
            anchor, start, end, content, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            row = np.concatenate(rows)
            content = mix64(content ^ mix64((end - start).astype(np.uint64) << np.uint64(16) | place.astype(np.uint64)))
            # equal regions that follow each other and touch: one row for all, with their number
            same = (row[1:] == row[:-1]) & (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1]) & (start[1:] <= end[:-1])
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            last = np.concatenate([first[1:], [len(row)]]) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(row[first])),
                    pa.array(anchor[first].view(np.int64)),
                    pa.array(content[first].view(np.int64)),
                    pa.array(start[first].astype(np.int64)),
                    pa.array((end - start)[first].astype(np.int32)),
                    pa.array(end[last].astype(np.int64)),
                    pa.array((last - first + 1).astype(np.int64)),
                ],
                ["key", "anchor", "content", "start", "size", "end", "n"],
            )


def _cut_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            anchors, contents, bodies = [], [], []
            for body, wanted in zip(part.column(0), part.column(1), strict=True):
                held = body.as_py()
                for w in wanted.as_py():
                    anchors.append(w["anchor"])
                    contents.append(w["content"])
                    bodies.append(held[w["start"] : w["start"] + w["size"]])
            yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(contents, pa.int64()), pa.array(bodies, pa.binary())], ["anchor", "content", "body"])


def _sort_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by anchor; whole groups are put together up to SORT_BYTES for one suffix sort.

    Windows of different groups are never equal, so that sorting groups together changes nothing.
    """

    def done(group: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        rows = [(a, c, x, y) for (a, c, _), starts in zip(group, repeated_windows([b for _, _, b in group], length), strict=True) for x, y in stretches(starts, length)]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "content", "from", "until"])

    held: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        for anchor, content, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if size >= SORT_BYTES and anchor != held[-1][0]:
                yield done(held)
                held, size = [], 0
            if held and held[-1][:2] == (anchor, content):
                continue  # a repeated row has the same regions
            held.append((anchor, content, body))
            size += len(body)
    if held:
        yield done(held)


def _hash_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), 512):
            part = batch.slice(lo, 512)
            anchors, contents, places, hashes = [], [], [], []
            for anchor, content, body in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                at = np.arange(len(body) - length + 1)
                hashes.append(window_hashes(prefix_sums(np.frombuffer(body, np.uint8)), at, at + length))
                anchors.append(np.full(len(at), anchor))
                contents.append(np.full(len(at), content))
                places.append(at)
            if anchors:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(anchors)), pa.array(np.concatenate(contents)), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(hashes).view(np.int64))],
                    ["anchor", "content", "place", "window"],
                )


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _remove(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            sizes, removed, counts, digests, kept = [], [], [], [], []
            for body, spans in zip(part.column(1), part.column(2), strict=True):
                held = body.as_py() or b""
                gone = _merged([(s["a"], s["b"]) for s in spans.as_py() or ()])
                edges = [0, *(x for span in gone for x in span), len(held)]
                rest = b"".join(held[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                sizes.append(len(held))
                removed.append(len(held) - len(rest))
                counts.append(len(gone))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep_text, names)


def remove_repeats(
    docs: DataFrame, length: int = 400, text: str = "text", doc_id: str = "doc_id", keep_text: bool = False, gram: int | None = None, sort_classes: int = SORT_CLASSES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with `keep_text`, kept (bytes).

    `sort_classes`: from so many different regions of one anchor value on, windows are counted, not sorted.
    `hot_rows`: from so many on, the rows of an anchor value are not shuffled to one task.
    """
    gram = min(GRAM, max(1, length // 2)) if gram is None else gram
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    # an id need not be unique and rows may repeat: equal rows get the same spans, counted as often as they occur
    rows = rows.withColumn("key", row_key("doc_id", "body"))
    found = rows.filter(F.length("body") >= length).select("key", "body").mapInArrow(
        lambda it: _find_regions(it, length, gram), "key binary, anchor long, content long, start long, size int, end long, n long"
    )
    found = materialize(found, "regions")
    # per anchor value: how many regions, and whether they are of one class
    anchors = found.groupBy("anchor").agg(F.sum("n").alias("regions"), F.count("*").alias("held"), F.min("content").alias("x"), F.max("content").alias("y")).filter("regions > 1")
    anchors = materialize(anchors.select("anchor", "held", (F.col("x") < F.col("y")).alias("mixed")), "shared_anchors")
    hot, rare = (anchors.filter(f).drop("held") for f in (F.col("held") >= hot_rows, F.col("held") < hot_rows))
    rest = found.join(F.broadcast(hot.select("anchor")), "anchor", "left_anti").join(rare, "anchor")
    shared = materialize(rest.unionByName(found.join(F.broadcast(hot), "anchor")), "shared_regions")
    classes = (
        shared.groupBy("anchor", "content")
        .agg(F.sum("n").alias("n"), F.max("mixed").alias("mixed"), F.min(F.struct("key", "start", "size")).alias("head"))
        .select("anchor", "content", "n", "mixed", "head.*")
    )
    classes = materialize(classes, "region_classes")
    wanted = classes.filter("mixed").groupBy("key").agg(F.collect_list(F.struct("anchor", "content", "start", "size")).alias("wanted"))
    bodies = rows.join(wanted, "key").select("body", "wanted").mapInArrow(_cut_regions, "anchor long, content long, body binary")
    many = classes.filter("mixed").groupBy("anchor").agg(F.count("*").alias("classes")).filter(F.col("classes") >= sort_classes)
    bodies = materialize(bodies.join(F.broadcast(many), "anchor", "left"), "region_bytes")
    few = bodies.filter("classes is null").select("anchor", "content", "body")
    # sorting costs far more than its bytes suggest, so parts are not merged by size
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_spans = few.repartition(parts, "anchor").sortWithinPartitions("anchor", "content").mapInArrow(
        lambda it: _sort_groups(it, length), "anchor long, content long, `from` int, until int"
    )
    windows = (
        bodies.filter("classes is not null")
        .select("anchor", "content", "body")
        .mapInArrow(lambda it: _hash_windows(it, length), "anchor long, content long, place int, window long")
    )
    place = F.struct("content", "place")
    again = windows.groupBy("anchor", "window").agg(F.min(place).alias("x"), F.max(place).alias("y")).filter("x < y").select("anchor", "window")
    counted_spans = windows.join(again, ["anchor", "window"]).select("anchor", "content", F.col("place").alias("from"), (F.col("place") + length).alias("until"))
    # regions of a class of several go whole, whatever sorting says; a class of one is its head
    single = classes.filter("n = 1").select("anchor", "content", "key", "start")
    whole = shared.join(single.select("key", "start"), ["key", "start"], "left_anti").select("key", F.col("start").alias("a"), F.col("end").alias("b"))
    parted = sorted_spans.union(counted_spans).join(single, ["anchor", "content"])
    parted = parted.select("key", (F.col("start") + F.col("from")).alias("a"), (F.col("start") + F.col("until")).alias("b"))
    spans = whole.union(parted).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return rows.join(spans, "key", "left").select("doc_id", "body", "spans").mapInArrow(lambda it: _remove(it, keep_text), schema)
