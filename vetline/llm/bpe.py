"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last bytes cuts every text into chunks, so equal passages give equal chunks
wherever they stand. A chunk that occurs more than once is encoded in one place only; its ids travel
to the other texts. A chunk's first and last words may be parts of words, so its ids cover its inner
words only, and each join is encoded again in its text, over a stretch that overlaps the chunks on
both sides and grows until the ids of the overlap agree exactly.

White space (0x20, 0x09-0x0D) never lies inside a token of this vocabulary, and no token's ids depend
on what stands beyond it. So words between white space can be encoded one by one.

Null texts count as empty; a null or repeated id is an ordinary value. Rows equal in id and text give
equal rows. An empty table gives an empty table; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.kernels import prefix_sums, slices, window_hashes
from vetline.llm.rowkeys import row_key
from vetline.session import materialize

WINDOW = 32
CHUNK_BYTES = 2048
MEMO_WORDS = 150_000
MEMO_LENGTH = 64
_BLANKS = b" \t\n\r\x0b\x0c"


class WordEncoder:
    """Encodes bytes of text; words seen before come from a bounded memo."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, tuple[int, ...]] = {}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.decimals = [b"%d" % i for i in range(size)]

    def word(self, word: bytes) -> tuple[int, ...]:
        ids = tuple(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)
        if len(word) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = ids
        return ids

    def ids(self, text: bytes) -> list[int]:
        memo, out = self.memo, []
        for word in text.split():
            found = memo.get(word)
            out += self.word(word) if found is None else found
        return out


def cuts(data: np.ndarray, size: int = CHUNK_BYTES) -> np.ndarray:
    """Where chunks end: after every byte at which the hash of the last WINDOW bytes is 0 modulo `size`."""
    out, base, step = [], 0, 1 << 19
    while base + WINDOW <= len(data):
        part = data[base : base + step + WINDOW - 1]
        starts = np.arange(len(part) - WINDOW + 1)
        hashes = window_hashes(prefix_sums(part), starts, starts + WINDOW)
        out.append(np.flatnonzero((hashes >> np.uint64(40)) % np.uint64(size) == 0) + base + WINDOW)
        base += step
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return np.unique(np.concatenate([[0], found, [len(data)]])).astype(np.int64)


def inner(chunk: bytes) -> tuple[int, int]:
    """The stretch between a chunk's first and last white space (empty where there are not two)."""
    first = next((i for i, b in enumerate(chunk) if b in _BLANKS), -1)
    last = max(chunk.rfind(b) for b in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
    return (first, last) if 0 <= first < last else (0, 0)


def joined(encoder: WordEncoder, text: bytes, pieces: list[tuple[int, int, np.ndarray]]) -> list[int]:
    """The ids of `text`, given ids of the inner words of some of its stretches (start, end, ids), in order.

    The text between two pieces is encoded here, with the last word of the piece before and the first
    word of the piece behind. If the ids of these words differ from the piece's own, the stretch grows.
    """
    out: list[int] = []
    at = 0
    for start, end, given in pieces:
        if start < at:
            continue
        a, b = inner(text[start:end])
        ids = given.tolist()
        body = text[start + a : start + b]
        agreed = False
        take = 1
        while not agreed and body:
            head = body.split(None, take)
            tail = body.rsplit(None, take)
            edge_front = [i for w in head[:take] for i in encoder.ids(w)]
            edge_back = [i for w in tail[-take:] for i in encoder.ids(w)]
            agreed = ids[: len(edge_front)] == edge_front and (not edge_back or ids[-len(edge_back) :] == edge_back)
            if not agreed and len(head) <= take:
                ids, agreed = encoder.ids(body), True
            take *= 2
        out += encoder.ids(text[at : start + a])
        out += ids
        at = start + b
    return out + encoder.ids(text[at:])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_for(path: str) -> WordEncoder:
    """One encoder for each vocabulary file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _chunk_keys(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks = batch.column(0), batch.column(1)
        for lo, hi, data, offsets in slices(batch.column(2)):
            row, starts, ends, keys = [], [], [], []
            for i in range(hi - lo):
                text = data[offsets[i] : offsets[i + 1]]
                held = text.tobytes()
                edges = cuts(text, size).tolist()
                for a, b in zip(edges, edges[1:], strict=False):
                    if b - a >= WINDOW:
                        row.append(lo + i)
                        starts.append(a)
                        ends.append(b)
                        keys.append(hashlib.blake2b(held[a:b], digest_size=16).digest())
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), marks.take(take), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(keys, pa.binary())],
                ["doc_id", "mark", "from", "until", "chunk"],
            )


def _encode_chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = encoder_for(path)
    for batch in batches:
        keys, blobs = [], []
        for text, owned in zip(batch.column(0), batch.column(1), strict=True):
            held = text.as_py() or b""
            for piece in owned.as_py():
                chunk = held[piece["from"] : piece["until"]]
                a, b = inner(chunk)
                keys.append(piece["chunk"])
                blobs.append(np.array(encoder.ids(chunk[a:b]), "<u2" if len(encoder.tokens) <= 65536 else "<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], ["chunk", "ids"])


def _encode_texts(batches: Iterator[pa.RecordBatch], path: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = encoder_for(path)
    width = "<u2" if len(encoder.tokens) <= 65536 else "<u4"
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids
    for batch in batches:
        for lo in range(0, len(batch), 512):
            part = batch.slice(lo, 512)
            counts, digests, decodes, kept, said = [], [], [], [], []
            for text, pieces in zip(part.column(1), part.column(2), strict=True):
                held = text.as_py() or b""
                found = sorted({(p["from"], p["until"], p["ids"]) for p in pieces.as_py() or ()})
                ids = joined(encoder, held, [(a, b, np.frombuffer(blob, width)) for a, b, blob in found])
                decoded = b" ".join(map(encoder.tokens.__getitem__, ids))
                counts.append(len(ids))
                digests.append(hashlib.sha256(b" ".join(map(encoder.decimals.__getitem__, ids))).hexdigest())
                decodes.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    kept.append(ids)
                    said.append(decoded.decode())
            columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decodes)]
            if keep_ids:
                columns += [pa.array(kept, pa.list_(pa.int32())), pa.array(said, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", chunk_bytes: int = CHUNK_BYTES, keep_ids: bool = False) -> DataFrame:
    """Token ids of every text and what they decode to.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with `keep_ids`, ids and decoded.
    `path` names the vocabulary file, which must lie at the same place on every machine.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    # an id need not be unique: id and text together are
    rows = rows.withColumn("mark", row_key("doc_id", "body"))
    chunks = materialize(
        rows.select("doc_id", "mark", "body").mapInArrow(lambda it: _chunk_keys(it, chunk_bytes), "doc_id long, mark binary, `from` long, until long, chunk binary"),
        "chunks",
    )
    shared = chunks.groupBy("chunk").agg(F.count("*").alias("times"), F.min(F.struct("mark", "from")).alias("owner")).filter("times > 1")
    uses = materialize(chunks.join(shared, "chunk").select("chunk", "mark", "from", "until", "owner"), "chunk_uses")
    owned = (
        uses.filter((F.col("owner.mark") == F.col("mark")) & (F.col("owner.from") == F.col("from")))
        .dropDuplicates(["chunk"])
        .groupBy("mark")
        .agg(F.collect_list(F.struct("from", "until", "chunk")).alias("owned"))
    )
    published = materialize(
        rows.join(owned, "mark").select("body", "owned").mapInArrow(lambda it: _encode_chunks(it, path), "chunk binary, ids binary").dropDuplicates(["chunk"]),
        "chunk_ids",
    )
    # a set: rows that repeat id and text bring the same pieces
    given = uses.join(published, "chunk").groupBy("mark").agg(F.collect_set(F.struct("from", "until", "ids")).alias("pieces"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return rows.join(given, "mark", "left").select("doc_id", "body", "pieces").mapInArrow(lambda it: _encode_texts(it, path, keep_ids), schema)
