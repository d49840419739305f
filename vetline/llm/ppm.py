"""Language-model scoring by prediction with partial matching, over bytes, with counts of all contexts.

Training texts give, in one pass, the counts of all byte strings of ORDER + 1 bytes (shorter contexts are
sums of these) and of all words. A text is its bytes with A-Z lower-cased, after ORDER start marks and
before one end mark; the mark is 0xFF, which UTF-8 never uses.

All counts are kept, however rare the string, and stored. A context escapes as often as it has symbols (method
C), and the symbols of a context are excluded from shorter ones. What a symbol costs depends on its string of
ORDER + 1 bytes alone. Strings that make up at least 1 / 2**COMMON of the training bytes are broadcast with
their costs (so at most 2**COMMON of them); all others, seen or not, are looked up by a join of the distinct
strings of each text. The share says which way a string goes and changes no score.

Word counts have no bound either. Words that make up at least 1 / 2**SUPPORT of the training tokens are broadcast
(again at most 2**SUPPORT); all others are looked up by a join. Words are told apart by a 64-bit hash.

Null texts count as empty: one end token, one end mark. A null id is in training if crc32 of "" says so.
Repeated rows count and score as often as they occur. Without training text every symbol costs log10 256
(the 255 bytes besides the mark and the end) and c = N = V = 0. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.kernels import LOWER, slices, word_hashes, words
from vetline.session import materialize

ORDER = 5
SUPPORT = 20
COMMON = 22
MARK = 0xFF
END_TOKEN = np.uint64(0)
ALPHA = 0.1
#: a counting task holds so many keys of a kind, and looks at so many bytes at once
HELD_KEYS = 1 << 20
COUNT_BYTES = 1 << 19
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of each symbol with the `order` bytes before it, and where each text's codes start."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    begins = offsets[:-1] + np.arange(n) * (order + 1)
    flow = np.full(len(data) + n * (order + 1), MARK, np.uint8)
    flow[np.arange(len(data)) + np.repeat(np.arange(n) * (order + 1) + order, sizes)] = data
    codes = np.zeros(len(flow), np.uint64)
    for back in range(order + 1):
        codes[back:] |= flow[: len(flow) - back].astype(np.uint64) << np.uint64(8 * back)
    real = np.ones(len(flow), bool)
    real[(begins[:, None] + np.arange(order)).ravel()] = False
    return codes[real], np.concatenate([offsets[:-1] + np.arange(n), [len(data) + n]])


class Lookup:
    """Values of a sorted set of keys; a direct table answers for most keys in one step."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = min(22, max(8, int(np.ceil(np.log2(max(len(keys), 1)))) + 2))
        self.shift = np.uint64(64 - bits)
        self.slot_keys = np.zeros(1 << bits, np.uint64)
        self.slot_values = np.full(1 << bits, np.nan)
        slots = (keys * _FACTOR) >> self.shift
        self.slot_keys[slots] = keys
        self.slot_values[slots] = values

    def fast(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN where the direct table does not hold the key."""
        slots = (keys * _FACTOR) >> self.shift
        return np.where(self.slot_keys[slots] == keys, self.slot_values[slots], np.nan)

    def exact(self, keys: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)

    def __call__(self, keys: np.ndarray, missing: float) -> np.ndarray:
        out = self.fast(keys)
        open_ = np.flatnonzero(np.isnan(out))
        out[open_] = self.exact(keys[open_], missing)
        return out


def _contexts(grams: DataFrame) -> DataFrame:
    """Each context before strings of a length: what follows it in all, how many symbols, what these weigh in the
    next shorter context (hidden), and how often it stood before strings that were left out (lost)."""
    shorter = grams.select((F.col("length") + 1).alias("length"), F.col("key").alias("ending"), F.col("n").alias("weight"))
    ending = F.col("key").bitwiseAND(F.expr("shiftleft(1L, 8 * (length - 1)) - 1"))
    weighed = grams.withColumn("ending", ending).join(shorter, ["length", "ending"], "left")
    followed = weighed.groupBy("length", F.expr("shiftright(key, 8)").alias("context")).agg(
        F.sum("n").cast("double").alias("total"), F.count("*").cast("double").alias("symbols"), F.sum(F.coalesce("weight", F.lit(0))).cast("double").alias("hidden")
    )
    lost = F.greatest(F.coalesce("weight", F.lit(0)) - F.col("total"), F.lit(0.0))
    return followed.join(shorter.withColumnRenamed("ending", "context"), ["length", "context"], "left").withColumn("lost", lost).drop("weight")


_WALK = """aggregate(levels, named_struct('cost', 0D, 'n', 0D, 'q', 0D, 'done', false), (a, x) -> CASE
    WHEN a.done OR x.total IS NULL THEN a
    ELSE named_struct(
        'cost', a.cost + CASE
            WHEN x.n > 0 THEN log10(x.n / (x.total - a.n + x.symbols - a.q + x.lost))
            WHEN x.symbols - a.q + x.lost > 0 THEN log10((x.symbols - a.q + x.lost) / (x.total - a.n + x.symbols - a.q + x.lost))
            ELSE 0D END,
        'n', x.hidden, 'q', x.symbols, 'done', x.n > 0)
    END, a -> IF(a.done, a.cost, a.cost - log10(256 - a.q)))"""


def _unseen(keys: DataFrame, grams: DataFrame, contexts: DataFrame, order: int) -> DataFrame:
    """key, cost: log10 probability of each symbol after its context, from the longest context down."""

    def levels(lengths: list[int], small: bool) -> DataFrame:
        own = F.explode(F.array(*[F.struct(F.lit(k).alias("length"), F.col("key").bitwiseAND((1 << 8 * k) - 1).alias("own")) for k in lengths]))
        asked = keys.select("key", own.alias("o")).select("key", "o.length", "o.own", F.expr("shiftright(o.own, 8)").alias("context"))
        held = [t.filter(F.col("length").isin(lengths)) for t in (grams.withColumnRenamed("key", "own"), contexts)]
        counts, stats = (F.broadcast(t) for t in held) if small else held
        return asked.join(counts, ["length", "own"], "left").join(stats, ["length", "context"], "left")

    # strings of one or two bytes are few, and every key asks for them
    found = levels([k for k in (1, 2) if k <= order + 1], True)
    if order > 1:
        found = found.unionByName(levels(list(range(3, order + 2)), False))
    level = F.struct((-F.col("length")).alias("at"), F.coalesce(F.col("n").cast("double"), F.lit(0.0)).alias("n"), "total", "symbols", "hidden", "lost")
    return found.groupBy("key").agg(F.sort_array(F.collect_list(level)).alias("levels")).select("key", F.expr(_WALK).alias("cost"))


class Tally:
    """Counts of keys in sorted arrays of bounded size: what grows too large leaves as partial counts."""

    def __init__(self, limit: int = HELD_KEYS):
        self.limit = limit
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        at = np.searchsorted(self.keys, keys)
        held = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        held[inside] = self.keys[at[inside]] == keys[inside]
        self.counts[at[held]] += counts[held]
        self.keys = np.insert(self.keys, at[~held], keys[~held])
        self.counts = np.insert(self.counts, at[~held], counts[~held])

    def spare(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Over the limit, the rarer half of the keys with their counts, which are no longer held here."""
        if len(self.keys) <= self.limit:
            return None
        gone = self.counts <= np.partition(self.counts, len(self.counts) // 2)[len(self.counts) // 2]
        out = self.keys[gone], self.counts[gone]
        self.keys, self.counts = self.keys[~gone], self.counts[~gone]
        return out


def _count(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    tallies = (Tally(), Tally())

    def rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(keys), 1 << 14):
            part = keys[lo : lo + (1 << 14)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), kind, np.int32)), pa.array(part.view(np.int64)), pa.array(counts[lo : lo + (1 << 14)])], ["kind", "key", "n"]
            )

    texts = 0
    for batch in batches:
        texts += len(batch)
        for _, _, data, offsets in slices(batch.column(0), COUNT_BYTES):
            data = LOWER[data]
            starts, ends, _ = words(data, offsets)
            tallies[0].add(word_hashes(data, starts, ends))
            # a single text can be far longer than a slice
            codes = gram_codes(data, offsets, order)[0]
            for lo in range(0, len(codes), COUNT_BYTES):
                tallies[1].add(codes[lo : lo + COUNT_BYTES])
                if (spare := tallies[1].spare()) is not None:
                    yield from rows(1, *spare)
            if (spare := tallies[0].spare()) is not None:
                yield from rows(0, *spare)
    if texts:
        yield from rows(0, np.array([END_TOKEN]), np.array([texts]))
    for kind, tally in enumerate(tallies):
        yield from rows(kind, tally.keys, tally.counts)


def _score(batches: Iterator[pa.RecordBatch], costs, frequent, order: int, ends_seen: int, tokens: int, kinds: int) -> Iterator[pa.RecordBatch]:
    floor, total = ALPHA, tokens + ALPHA * (kinds + 1)
    model, common = costs.value, frequent.value
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(2)):
            data = LOWER[data]
            codes, begins = gram_codes(data, offsets, order)
            cost = model(codes, np.nan)
            open_ = np.flatnonzero(np.isnan(cost))
            cost[open_] = 0.0
            scores = np.add.reduceat(cost, begins[:-1])
            texts, strings = np.searchsorted(begins, open_, "right") - 1, codes[open_]
            at = np.lexsort((strings, texts))
            texts, strings = texts[at], strings[at]
            new = np.flatnonzero(np.concatenate([[True], (texts[1:] != texts[:-1]) | (strings[1:] != strings[:-1])])[: len(at)])
            times = np.diff(np.append(new, len(at)))
            gram_edges = np.searchsorted(texts[new], np.arange(hi - lo + 1)).astype(np.int32)
            asked = pa.StructArray.from_arrays([pa.array(strings[new].view(np.int64)), pa.array(times)], ["key", "times"])
            starts, ends, first = words(data, offsets)
            hashes = word_hashes(data, starts, ends)
            counts = common(hashes, 0.0)
            known = counts > 0
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            base = np.bincount(row, np.where(known, np.log10((counts + floor) / total), 0.0), hi - lo).astype(float)
            base += np.log10((ends_seen + floor) / total)
            n_known = np.bincount(row[known], minlength=hi - lo) + int(ends_seen > 0)
            rare = hashes[~known].view(np.int64)
            edges = np.searchsorted(row[~known], np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(1).slice(lo, hi - lo),
                    pa.array(np.diff(first).astype(np.int64) + 1),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(base),
                    pa.array(scores),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(rare)),
                    pa.ListArray.from_arrays(pa.array(gram_edges), asked),
                ],
                ["doc_id", "held_out", "n_tokens", "n_common", "base_common", "score_common", "rare", "strings"],
            )


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", order: int = ORDER, support: int | None = None, common: int = COMMON) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out: crc32 of the id as text is 0 modulo 10; all others are learnt from. score is the log10
    probability of the text under all counts; base_score that of its words and its end under smoothed counts.
    A smaller model has to be asked for: `support` leaves out strings under 1 / 2**support of the training bytes.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    )
    counted = rows.filter("not held_out").select("body").mapInArrow(lambda it: _count(it, order), "kind int, key long, n long")
    counts = materialize(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    sums = {r["kind"]: (r["n"], r["kinds"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    tokens, kinds = sums.get(0, (0, 0))
    symbols = sums.get(1, (0, 0))[0]
    ends_seen = counts.filter((F.col("kind") == 0) & (F.col("key") == int(END_TOKEN))).agg(F.sum("n")).first()[0] or 0
    lengths = F.explode(F.array(*[F.struct(F.lit(k).alias("length"), F.col("key").bitwiseAND((1 << 8 * k) - 1).alias("key")) for k in range(1, order + 2)]))
    grams = counts.filter("kind = 1").select(lengths.alias("g"), "n").groupBy("g.length", "g.key").agg(F.sum("n").alias("n"))
    if support is not None:
        grams = grams.filter(F.col("n") >= symbols / 2**support)
    grams = materialize(grams, "grams")
    contexts = materialize(_contexts(grams), "contexts")
    whole = grams.filter(F.col("length") == order + 1).withColumn("context", F.expr("shiftright(key, 8)"))
    cost = F.log10(F.col("n") / (F.col("total") + F.col("symbols") + F.col("lost")))
    known = materialize(whole.join(contexts, ["length", "context"]).select("key", "n", cost.alias("cost")), "known")
    # shares bound what is broadcast: at most as many rows can reach them
    frequent_share = 2.0 ** -(SUPPORT if support is None else support)
    frequent = counts.filter((F.col("kind") == 0) & (F.col("n") >= tokens * frequent_share)).select("key", "n").toArrow()
    held = known.filter(F.col("n") >= symbols / 2**common).select("key", "cost").toArrow()

    def ordered(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64)
        at = np.argsort(keys)
        return keys[at], values[at].astype(float)

    costs, words_seen = (spark.sparkContext.broadcast(Lookup(*ordered(*(t.column(i).to_numpy() for i in range(2))))) for t in (held, frequent))
    scored = materialize(
        rows.mapInArrow(
            lambda it: _score(it, costs, words_seen, order, ends_seen, tokens, kinds),
            "doc_id long, held_out boolean, n_tokens long, n_common long, base_common double, score_common double, rare array<long>, strings array<struct<key: long, times: long>>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    rare = scored.select("row", F.explode("rare").alias("key"))
    found = rare.join(counts.filter("kind = 0").select("key", "n"), "key", "left")
    share = F.log10((F.coalesce("n", F.lit(0)) + ALPHA) / F.lit(tokens + ALPHA * (kinds + 1)))
    added = found.groupBy("row").agg(F.sum(share).alias("base_rare"), F.count("n").alias("n_rare"))
    strings = scored.select("row", F.explode("strings").alias("s")).select("row", "s.key", "s.times")
    unseen = materialize(strings.select("key").distinct().join(known, "key", "left_anti"), "unseen")
    table = known.select("key", "cost").unionByName(_unseen(unseen, grams, contexts, order))
    spelt = strings.join(table, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("score_rare"))
    zero = F.lit(0)
    return scored.join(added, "row", "left").join(spelt, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", zero)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_common") + F.coalesce("base_rare", zero)).alias("base_score"),
        (F.col("score_common") + F.coalesce("score_rare", zero)).alias("score"),
    )
