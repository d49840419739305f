"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stand. Wider patterns propose
further candidates: numbers without a country code, spelled-out addresses, IPv6, cards with other separators.
On every candidate and base span five labelers vote for, against or not at all: form, validity (check
digits, number ranges), gazetteers (endings, issuers, dialling codes), the words before it, and its neighbours.

Spans with equal votes, kind and shape are one cell; counts of cells are all that leaves the tasks, and their
number is fixed (CELLS at most), whatever the input. Expectation-maximisation over cells estimates for each
kind how labelers vote on true and on false spans; its posteriors are the soft labels on which a logistic
classifier of cells is trained. Candidates that it gives ACCEPT or more and that overlap no base span are added.

Null texts count as empty. Null, repeated ids and repeated rows give a row each. An empty table gives no
rows; other columns are not read. Positions count code points; ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.session import materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = 5
SHAPES = 4
CELLS = len(KINDS) * 3**LABELERS * SHAPES
ACCEPT = 0.9

# The base patterns
EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a start within a run of digits fails like the run's start, so only run starts are tried
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")

# Gazetteers
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn br in ch at be se no fi dk pl ru".split())
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "65")
DIALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "64", "7", "81", "82", "86", "90", "91")
BEFORE = {
    "email": re.compile(r"(?i)\b(e-?mail|mail|contact|write|reach|correo|courriel)\W*(to|at|is)?\W*$"),
    "ip": re.compile(r"(?i)\b(ip|ipv[46]|host|server|address|client|from)\W*(is)?\W*$"),
    "card": re.compile(r"(?i)\b(card|credit|debit|visa|mastercard|amex|karte|carte|tarjeta)\W*(number|no|nr)?\W*(is)?\W*$"),
    "phone": re.compile(r"(?i)\b(phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|t[ée]l[ée]fono)\W*(number|no|nr|me|us)?\W*(at|is)?\W*$"),
}
AGAINST = re.compile(r"(?i)\b(token|password|secret|key|hash|sha\d*|md5|version|v|isbn|issn|doi|order|invoice|sku|id|serial|build)\W*$")
WIDE = (
    ("email", re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\s?(?:[\[({]\s?at\s?[\])}]|\s at \s?)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:[\[({]\s?dot\s?[\])}]|\s dot \s?|\.)\s?[A-Za-z]{2,24}){1,4}\b", re.X | re.I)),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+=.-])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])")),
)
_AT = re.compile(r"(?i)\bat\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; a name is the whole run before its @, from the end of the match before on."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        found = EMAIL_END.match(text, at) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base spans, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def wide_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that overlap no base span."""
    out = []
    for kind, pattern in WIDE:
        if kind == "email" and not _AT.search(text):
            continue
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for a, _, b in base):
                out.append((m.start(), KINDS.index(kind), m.end()))
    return out


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """1 for, -1 against, 0 none: form, validity, gazetteers, words before, neighbours."""
    span, name = text[start:end], KINDS[kind]
    digits = digits_of(span)
    before = text[max(0, start - 32) : start]
    left, right = text[start - 1 : start], text[end : end + 1]
    if name == "email":
        words = re.split(r"[^A-Za-z0-9-]+", span)
        ending = words[-1].lower()
        form = 1 if "@" in span else 0
        valid = 1 if ending.isalpha() and 2 <= len(ending) <= 24 and ".." not in span else -1
        listed = 1 if ending in ENDINGS else 0
    elif name == "ip":
        form = 1
        valid = 1 if ":" in span or not span.startswith("0") else -1
        listed = -1 if span.split(".")[0] in ("0", "255") else 0
    elif name == "card":
        form = 1 if len(digits) in (15, 16) else 0
        valid = 1 if luhn(digits) and len(set(digits)) > 2 else -1
        listed = 1 if digits.startswith(ISSUERS) else -1
    else:
        form = 1 if span.startswith("+") or re.fullmatch(r"\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}", span) else 0
        national = digits[-10:]
        valid = 1 if national[:1] not in ("0", "1") and len(set(digits)) > 2 else -1
        listed = (1 if digits.startswith(DIALLING) else -1) if span.startswith("+") else 0
    context = 1 if BEFORE[name].search(before) else -1 if AGAINST.search(before) else 0
    apart = -1 if (left.isalnum() or right.isalnum() or left in ("=", "/", "#")) else 1 if not left.strip() and right in ("", " ", "\n", ".", ",", ";", ")") else 0
    return form, valid, listed, context, apart


def cell(text: str, start: int, kind: int, end: int) -> int:
    """The number of the span's cell: kind, votes, shape."""
    number = kind
    for vote in votes(text, start, kind, end):
        number = number * 3 + vote + 1
    length = end - start
    return number * SHAPES + (length > 12) + (length > 16) + (length > 22)


def _cell_parts(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes and shapes of cell numbers."""
    shape, rest = cells % SHAPES, cells // SHAPES
    given = np.zeros((len(cells), LABELERS), np.int64)
    for j in range(LABELERS - 1, -1, -1):
        given[:, j], rest = rest % 3 - 1, rest // 3
    return rest, given, shape


def estimate(given: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over rows of votes: P(true) per row, and P(vote | truth) by labeler, truth, vote.

    It starts from the majority and treats labelers as independent given the truth.
    """
    true = 1 / (1 + np.exp(-1.0 * given.sum(axis=1)))
    tables = np.zeros((given.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - true), counts * true])
        share = (weight[1].sum() + 1) / (weight.sum() + 2)
        for j in range(given.shape[1]):
            for y in (0, 1):
                table = np.bincount(given[:, j] + 1, weight[y], 3) + 1.0
                tables[j, y] = table / table.sum()
        log = np.log([1 - share, share])[:, None] + sum(np.log(tables[j][:, given[:, j] + 1]) for j in range(given.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - true).max() < 1e-9:
            break
        true = new
    return true, tables


def train(cells: np.ndarray, counts: np.ndarray) -> dict[int, float]:
    """P(true span) of each cell by the final classifier."""
    kinds, given, shapes = _cell_parts(cells)
    soft = np.zeros(len(cells))
    for kind in range(len(KINDS)):
        own = kinds == kind
        if own.any():
            soft[own] = estimate(given[own], counts[own])[0]
    x = np.column_stack([np.eye(len(KINDS))[kinds], given > 0, given < 0, np.eye(SHAPES)[shapes]]).astype(float)
    weights, beta = counts / max(counts.mean(), 1e-9) if len(counts) else counts, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weights * (p - soft)) + 0.01 * beta
        step = np.linalg.solve((x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.01 * np.eye(x.shape[1]), grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(cells.tolist(), (1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))).tolist(), strict=True))


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = pa.list_(pa.int64())
    for batch in batches:
        base, wide = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            own = base_spans(text)
            base.append([x for s in own for x in (*s, cell(text, *s))])
            wide.append([x for s in wide_spans(text, own) for x in (*s, cell(text, *s))])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, numbers), pa.array(wide, numbers)], ["doc_id", "base", "wide"])


def _fours(flat: list[int]) -> list[tuple[int, ...]]:
    return list(zip(*(flat[i::4] for i in range(4)), strict=True))


def _judge(batches: Iterator[pa.RecordBatch], model: dict[int, float], accept: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[] for _ in KINDS]
        hashes, spans, added = [], [], []
        for base, wide in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            own = [s[:3] for s in _fours(base)]
            more = [s[:3] for s in _fours(wide) if model.get(s[3], 0.0) >= accept]
            for kind, column in enumerate(counts):
                column.append(sum(s[1] == kind for s in own))
            hashes.append(hashlib.sha256(_written(own).encode()).hexdigest())
            spans.append(_written(own + more))
            added.append(len(more))
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", accept: float = ACCEPT) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (all), n_added."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"))
    found = materialize(rows.mapInArrow(_find, "doc_id long, base array<long>, wide array<long>"), "spans")
    every = F.concat("base", "wide")
    cells = found.filter(F.size(every) > 0).select(F.explode(F.filter(every, lambda x, i: i % 4 == 3)).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    held = cells.orderBy("cell").collect()
    model = train(np.array([r["cell"] for r in held], np.int64), np.array([r["n"] for r in held], float))
    return found.mapInArrow(
        lambda it: _judge(it, model, accept), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    )
