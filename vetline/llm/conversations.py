"""Repair of conversation structure with a suffix-shared automaton.

A conversation's rows, by turn (nulls first), become a signature: one symbol a row, from the initial of its role and
its fault. The cheapest edits that give a legal order of roles depend on what follows alone, so they are found from the
end, and signatures that end alike share the nodes of one automaton:

1. Faults come from SQL: blank and truncated rows from their text, duplicates from the first turn of each role and
   text in the conversation. Equal rows are folded into one with a count first.
2. Rows are range-sorted over the cluster and cut into pieces of at most PIECE rows (and PIECE_BYTES of text), so that
   a conversation with a large part of all rows lies in many tasks. Most conversations are one piece.
3. `Grammar` numbers all ways in which the costs to go of the grammar's states can differ, and their order where costs
   are equal: these classes of nodes are few, whatever the data. A piece maps the class at its right end to that
   at its left end, and a conversation of several pieces folds these maps from its end, one short row a piece.
4. The distinct signatures (with the class at their right end) are sorted by their reversed symbols. One walk over the
   sorted signatures makes each shared suffix once, with cost and best audit for each grammar state.
5. The audits are joined to the pieces and applied to the rows. SHA-256 has to read a text from front to back: a
   conversation of several pieces streams through one task, sorted, with one piece in memory.

Rows tie by turn, then role, then text. A null role, text or key is one space, a null turn comes first and counts for
no gap. An empty role has no initial and cannot be kept. Long texts stand alone in a piece and are never put together
but for the digest. Every id of `ids` gets a row, without rows zeros. Repeated rows are duplicates, extra columns are not
read, and an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetline.session import materialize

PIECE = 256
PIECE_BYTES = 1 << 20
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
#: symbols: the initial (o: any other), in capitals where the text is truncated; x must be deleted
SYMBOLS = "suaoSUAOx"
BLANKS = " \t\n\x0b\x0c\r"
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = (START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT)
END = -1  # where a conversation ends; its costs are those of class 0, but what is missing is inserted there


def expected(state: int) -> str:
    """The initial that a rerole or an insertion gives."""
    return "a" if state == AFTER_USER else "u"


def after(state: int, initial: str) -> int | None:
    """The state behind a row, None where the grammar `(s?(ua)+)?` has no such row."""
    if initial == "s":
        return AFTER_SYSTEM if state == START else None
    if initial != expected(state):
        return None
    return AFTER_ASSISTANT if initial == "a" else AFTER_USER


class Grammar:
    """Classes of automaton nodes: costs to go by state less the smallest, and the order of the best audits.

    `move[class][symbol]` is (class, smallest cost added, and by state the edits, the state behind the row and the
    cost). Where costs are equal, edits that come first in ASCII win; then the order of what follows decides, which
    is part of the class, so that no audit is compared as a string.
    """

    def __init__(self) -> None:
        # what is missing at the end is inserted
        ends = {START: 0, AFTER_SYSTEM: 2, AFTER_USER: 1, AFTER_ASSISTANT: 0}
        self.closing = ["I" * ends[s] for s in STATES]
        first = (tuple(INSERT * ends[s] for s in STATES), tuple(ends[s] for s in STATES))
        self.classes, known = [first], {first: 0}
        self.move: list[dict[str, tuple[int, int, list[tuple[str, int, int]]]]] = []
        while len(self.move) < len(self.classes):
            costs, order = self.classes[len(self.move)]
            moves = {}
            for symbol in SYMBOLS:
                best = [min((cost + costs[t], edits, order[t], t, cost) for edits, t, cost in self.edits(s, symbol)) for s in STATES]
                least = min(b[0] for b in best)
                ranks = sorted({b[1:3] for b in best})
                found = tuple(b[0] - least for b in best), tuple(ranks.index(b[1:3]) for b in best)
                if found not in known:
                    known[found] = len(self.classes)
                    self.classes.append(found)
                moves[symbol] = known[found], least, [(b[1], b[3], b[4]) for b in best]
            self.move.append(moves)
        # by symbol the class at the left of each class
        self.maps = {symbol: np.array([m[symbol][0] for m in self.move], np.int16) for symbol in SYMBOLS}

    @staticmethod
    def edits(state: int, symbol: str) -> Iterator[tuple[str, int, int]]:
        """Edits that consume one row, insertions before it included: letters, state behind, cost."""
        initial, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        for inserted in range(3):
            letters, cost = "I" * inserted, INSERT * inserted
            yield letters + "D", state, cost + DELETE
            if symbol != "x":
                if (kept := after(state, initial)) is not None:
                    yield letters + "K", kept, cost + KEEP + extra
                yield letters + "R", after(state, expected(state)), cost + REROLE + extra
            state = after(state, expected(state))


@functools.cache
def grammar() -> Grammar:
    return Grammar()


class Suffixes:
    """Nodes of the automaton along one signature: each a class and, by state, audit, state at the end, cost."""

    def __init__(self) -> None:
        self.rules = grammar()
        self.right, self.symbols, self.nodes = None, "", []

    def outcomes(self, symbols: str, right: int) -> list[tuple[str, int, int]]:
        """By state at the left: audit, state at the right, cost. Nodes shared with the signature before stay."""
        if right != self.right:
            self.right, self.symbols = right, ""
            closing = self.rules.closing if right == END else [""] * len(STATES)
            self.nodes = [(max(right, 0), [(closing[s], s, INSERT * len(closing[s])) for s in STATES])]
        shared = 0
        for mine, other in zip(reversed(symbols), reversed(self.symbols), strict=False):
            if mine != other:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in symbols[: len(symbols) - shared][::-1]:
            kind, below = self.nodes[-1]
            left, _, choices = self.rules.move[kind][symbol]
            self.nodes.append((left, [(edits + below[t][0], below[t][1], cost + below[t][2]) for edits, t, cost in choices]))
        self.symbols = symbols
        return self.nodes[-1][1]


def _key(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A twentieth each of the rows dropped, emptied, without sentence ends, repeated, or given the role user.

    The choice is crc32 of `conv_id:turn`; nulls are one space.
    """
    kind = F.crc32(F.concat(_key(F.col(conv_id)), F.lit(":"), _key(F.col(turn))).cast("binary")) % 20
    rows = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"), kind.alias("kind")
    ).filter("kind <> 0")
    texts = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    roles = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", roles.alias("role"), texts.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _folded(rows: DataFrame) -> DataFrame:
    """Equal rows once with their count (n), and whether role and text stand in an earlier turn (seen)."""
    order = [F.col("turn").isNotNull().alias("timed"), F.coalesce(F.col("turn"), F.lit(0)).cast("long").alias("at")]
    folded = rows.select("c", *order, "role", "text").groupBy("c", "timed", "at", "role", "text").agg(F.count("*").alias("n"))
    folded = folded.withColumn("said", F.unhex(F.md5(F.concat("role", F.lit("\n"), "text").cast("binary"))))
    first = folded.groupBy("c", "said").agg(F.min(F.struct("timed", "at")).alias("first"))
    return folded.join(first, ["c", "said"]).withColumn("seen", F.col("first") != F.struct("timed", "at")).drop("first", "said")


_PIECE_SCHEMA = (
    "c string, ord long, symbols string, rows array<struct<role: string, text: string>>, head string, tail string, "
    "illegal long, blank long, duplicate long, truncated long, turns long, low long, high long"
)


class _Piece:
    """Rows of one conversation, in order."""

    def __init__(self, c: str):
        self.c, self.symbols, self.rows, self.size = c, [], [], 0
        self.head = self.tail = self.low = self.high = None
        self.illegal = self.blank = self.duplicate = self.truncated = self.turns = 0

    def add(self, symbol: str, initial: str, turn: int | None, row: dict | None) -> None:
        if self.head is None:
            self.head = initial
        elif self.tail + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.tail = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.symbols.append(symbol)
        if row is not None:
            self.rows.append(row)
            self.size += len(row["text"])

    def out(self, ord_: int) -> dict:
        names = ("c", "rows", "head", "tail", "illegal", "blank", "duplicate", "truncated", "turns", "low", "high")
        return {"ord": ord_, "symbols": "".join(self.symbols), **{name: getattr(self, name) for name in names}}


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; a piece ends with its conversation, after `most` rows or when it holds `most_bytes`."""
    piece: _Piece | None = None
    done: list[dict] = []
    held, number = 0, 0

    def close() -> None:
        nonlocal piece, number, held
        if piece is not None:
            done.append(piece.out((part << 33) + number))
            held += piece.size
            number, piece = number + 1, None

    part = 0
    for batch in batches:
        for lo in range(0, len(batch), 512):
            for row in batch.slice(lo, 512).to_pylist():
                part = row["part"]
                turn = row["at"] if row["timed"] else None
                initial = row["role"][:1]
                own = initial if initial in ("s", "u", "a") else "o"
                for copy in range(row["n"]):
                    if piece is not None and (piece.c != row["c"] or len(piece.symbols) >= most or piece.size >= most_bytes):
                        close()
                        if len(done) >= 256 or held >= most_bytes:
                            yield pa.RecordBatch.from_pylist(done, schema)
                            done, held = [], 0
                    if piece is None:
                        piece = _Piece(row["c"])
                    if row["blank"]:
                        piece.blank += 1
                        piece.add("x", initial, turn, None)
                    elif row["seen"] or copy:
                        piece.duplicate += 1
                        piece.add("x", initial, turn, None)
                    else:
                        piece.truncated += not row["ended"]
                        piece.add(own if row["ended"] else own.upper(), initial, turn, {"role": row["role"], "text": row["text"]})
    close()
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece the class at its left end by the class at its right end."""
    rules = grammar()
    for batch in batches:
        maps = []
        for symbols in batch.column(2).to_pylist():
            found = np.arange(len(rules.classes), dtype=np.int16)
            for symbol in reversed(symbols):
                found = rules.maps[symbol][found]
            maps.append(found.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], ["c", "ord", "map"])


def _rights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's pieces, last first, the class at the right end of each."""
    for batch in batches:
        for c, pieces in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            orders, kinds, kind = [], [], END
            for piece in reversed(pieces.values.to_pylist()):
                orders.append(piece["ord"])
                kinds.append(kind)
                kind = int(np.frombuffer(piece["map"], np.int16)[max(kind, 0)])
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(orders)), pa.array(orders, pa.int64()), pa.array(kinds, pa.int32())], ["c", "ord", "right"])


def _lefts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's pieces in order, the grammar state at the left end of each."""
    for batch in batches:
        for c, pieces in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            orders, states, state = [], [], START
            for piece in pieces.values.to_pylist():
                orders.append(piece["ord"])
                states.append(state)
                state = piece["to"][state]
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(orders)), pa.array(orders, pa.int64()), pa.array(states, pa.int32())], ["c", "ord", "state"])


def _walk(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Signatures come sorted by right class and reversed symbols."""
    shared = Suffixes()
    for batch in batches:
        for lo in range(0, len(batch), 1024):
            part = batch.slice(lo, 1024)
            rows = []
            for symbols, right in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                outcomes = [{"audit": audit, "to": to, "cost": cost} for audit, to, cost in shared.outcomes(symbols, right)]
                rows.append({"symbols": symbols, "right": right, "outcomes": outcomes})
            yield pa.RecordBatch.from_pylist(rows, schema)


def repaired_lines(audit: str, state: int, symbols: str, rows: list[dict]) -> list[str]:
    """The lines `role:text` that the edits leave of a piece."""
    lines, at, held = [], 0, iter(rows)
    for edit in audit:
        if edit == "I":
            role, text = {"u": "user", "a": "assistant"}[expected(state)], ""
        else:
            own = next(held) if symbols[at] != "x" else None
            at += 1
            if edit == "D":
                continue
            role, text = own["role"], own["text"]
            if edit == "R":
                role = {"u": "user", "a": "assistant"}[expected(state)]
        state = after(state, role[:1])
        lines.append(f"{role}:{text}")
    return lines


_APPLIED = "c string, ord long, audit string, cost long, n_lines long, body string, digest string"


def _apply(batches: Iterator[pa.RecordBatch], schema: pa.Schema, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), 64):
            rows = []
            for row in batch.slice(lo, 64).to_pylist():
                lines = repaired_lines(row["audit"], row["state"], row["symbols"], row["rows"])
                body = "\n".join(lines)
                alone = row["alone"]
                digest = hashlib.sha256(body.encode()).hexdigest() if alone else None
                rows.append({"c": row["c"], "ord": row["ord"], "audit": row["audit"], "cost": row["cost"], "n_lines": len(lines), "body": body if keep_text or not alone else None, "digest": digest})
            yield pa.RecordBatch.from_pylist(rows, schema)


def _stream(batches: Iterator[pa.RecordBatch], schema: pa.Schema, keep_text: bool) -> Iterator[pa.RecordBatch]:
    """Pieces come by conversation and in order; the digest reads them one by one."""
    c, audits, bodies, cost, any_line, digest = None, [], [], 0, False, hashlib.sha256()

    def out() -> pa.RecordBatch:
        body = "".join(bodies) if keep_text else None
        return pa.RecordBatch.from_pylist([{"c": c, "ord": 0, "audit": "".join(audits), "cost": cost, "n_lines": 0, "body": body, "digest": digest.hexdigest()}], schema)

    for batch in batches:
        for row in (r for lo in range(0, len(batch), 64) for r in batch.slice(lo, 64).to_pylist()):
            if row["c"] != c:
                if c is not None:
                    yield out()
                c, audits, bodies, cost, any_line, digest = row["c"], [], [], 0, False, hashlib.sha256()
            audits.append(row["audit"])
            cost += row["cost"]
            if row["n_lines"]:
                body = ("\n" if any_line else "") + row["body"]
                digest.update(body.encode())
                any_line = True
                if keep_text:
                    bodies.append(body)
    if c is not None:
        yield out()


def repair(
    rows: DataFrame,
    ids: DataFrame | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece: int = PIECE,
    piece_bytes: int = PIECE_BYTES,
    keep_text: bool = False,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The first five describe the rows as they come. `audit` holds the cheapest edits (Keep, Rerole, Delete, Insert) in
    order, the digest is that of the lines `role:text` that they leave; with `keep_text` these come as `repaired`.
    ids: a table with the ids that get a row; by default those of `rows`.
    """
    named = rows.select(
        F.col(conv_id).alias("conv_id"),
        _key(F.col(conv_id)).alias("c"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    blank = F.translate("text", BLANKS, "") == ""
    ended = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?")
    order = ["c", "timed", "at", "role", "text"]
    marked = _folded(named).withColumns({"blank": blank, "ended": ended}).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long"))
    cut_schema, walk_schema, applied = _arrow(_PIECE_SCHEMA), _arrow("symbols string, right int, outcomes array<struct<audit: string, to: int, cost: long>>"), _arrow(_APPLIED)
    pieces = materialize(marked.mapInArrow(lambda it: _cut(it, cut_schema, piece, piece_bytes), _PIECE_SCHEMA), "pieces")

    # signatures: conversations of one piece end where the piece ends
    thin = pieces.select("c", "ord", "symbols")
    sizes = pieces.groupBy("c").agg(F.count("*").alias("pieces"))
    several = thin.join(sizes.filter("pieces > 1").select("c"), "c", "left_semi")
    maps = several.mapInArrow(_maps, "c string, ord long, map binary").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("ord", "map"))).alias("pieces"))
    rights = materialize(maps.mapInArrow(_rights, "c string, ord long, right int"), "rights")
    asked = materialize(thin.join(rights, ["c", "ord"], "left").withColumns({"alone": F.col("right").isNull(), "right": F.coalesce("right", F.lit(END))}), "asked")
    backwards = [F.col("right"), F.reverse("symbols")]
    signatures = asked.select("symbols", "right").distinct().repartitionByRange(*backwards).sortWithinPartitions(*backwards)
    walked = materialize(signatures.mapInArrow(lambda it: _walk(it, walk_schema), "symbols string, right int, outcomes array<struct<audit: string, to: int, cost: long>>"), "signatures")
    onward = asked.filter("not alone").join(walked, ["symbols", "right"]).groupBy("c").agg(F.sort_array(F.collect_list(F.struct("ord", F.col("outcomes.to").alias("to")))).alias("pieces"))
    states = onward.mapInArrow(_lefts, "c string, ord long, state int")
    chosen = asked.join(states, ["c", "ord"], "left").withColumn("state", F.coalesce("state", F.lit(START))).join(walked, ["symbols", "right"])
    own = F.get("outcomes", F.col("state"))
    chosen = chosen.select("c", "ord", "alone", "state", own["audit"].alias("audit"), own["cost"].alias("cost"))

    done = pieces.select("c", "ord", "symbols", "rows").join(chosen, ["c", "ord"]).mapInArrow(lambda it: _apply(it, applied, keep_text), _APPLIED)
    done = materialize(done, "repaired")
    streamed = done.filter("digest is null").repartition("c").sortWithinPartitions("c", "ord").mapInArrow(lambda it: _stream(it, applied, keep_text), _APPLIED)
    repaired = done.filter("digest is not null").unionByName(streamed).drop("ord", "n_lines")

    return _report(named, ids, conv_id, pieces, repaired, keep_text)


def _report(named: DataFrame, ids: DataFrame | None, conv_id: str, pieces: DataFrame, repaired: DataFrame, keep_text: bool) -> DataFrame:
    # pieces meet: their border is an adjacent pair, and a turn may go on
    before = Window.partitionBy("c").orderBy("ord")
    border = F.concat(F.lag("tail").over(before), F.col("head"))
    held = pieces.select("c", "ord", "head", "tail", "illegal", "blank", "duplicate", "truncated", "turns", "low", "high")
    met = held.withColumns(
        {
            "illegal": F.col("illegal") + F.when(border.isNull() | border.isin("su", "ua", "au"), 0).otherwise(1),
            "turns": F.col("turns") - F.when(F.lag("high").over(before) == F.col("low"), 1).otherwise(0),
        }
    )
    counts = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "turns")]
    summed = met.groupBy("c").agg(*counts, F.min("low").alias("low"), F.max("high").alias("high"))
    every = (named.select("conv_id", "c") if ids is None else ids.select(F.col(conv_id).alias("conv_id"), _key(F.col(conv_id)).alias("c"))).distinct()
    gaps = F.col("high") - F.col("low") + 1 - F.col("turns")
    zero = F.lit(0).cast("long")
    return (
        every.join(summed, "c", "left")
        .join(repaired, "c", "left")
        .select(
            "conv_id",
            F.coalesce(gaps, zero).alias("gaps"),
            *[F.coalesce(name, zero).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
            *([F.coalesce("body", F.lit("")).alias("repaired")] if keep_text else []),
        )
    )
