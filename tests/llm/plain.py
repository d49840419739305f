"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lowered(text))


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    own = words(text)
    if len(own) < n:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def near_duplicates(rows: list[tuple[int, str | None]], percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of its set, smallest id reachable)"""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = Counter(pair for held in holders.values() for pair in itertools.combinations(sorted(held), 2))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """For each text: bytes, removed bytes, removed runs, sha256 of the rest."""
    held = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + length] for t in held for i in range(len(t) - length + 1))
    out = []
    for t in held:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


class Ppm:
    """Counts in dictionaries and a walk down the contexts, symbol by symbol."""

    def __init__(self, texts: list[str | None], order: int, share: float):
        self.order, counts = order, Counter()
        for text in texts:
            flow = self.flow(text)
            for at in range(order, len(flow)):
                for d in range(order + 1):
                    counts[flow[at - d : at + 1]] += 1
        total = sum(n for gram, n in counts.items() if len(gram) == 1)
        self.counts = {gram: n for gram, n in counts.items() if n >= total * share}
        self.contexts = defaultdict(dict)
        for gram, n in self.counts.items():
            self.contexts[gram[:-1]][gram[-1]] = n

    def flow(self, text: str | None) -> bytes:
        return b"\xff" * self.order + lowered(text).encode() + b"\xff"

    def symbol(self, before: bytes, symbol: int) -> float:
        excluded: set[int] = set()
        out = 0.0
        for d in range(self.order, -1, -1):
            context = before[len(before) - d :]
            held = self.contexts.get(context)
            if not held:
                continue
            open_ = {s: n for s, n in held.items() if s not in excluded}
            lost = max(self.counts.get(context, 0) - sum(held.values()), 0) if d else 0
            total, escapes = sum(open_.values()), len(open_) + lost
            if symbol in open_:
                return out + math.log10(open_[symbol] / (total + escapes))
            if escapes:
                out += math.log10(escapes / (total + escapes))
            excluded |= set(held)
        return out - math.log10(256 - len(excluded))

    def text(self, text: str | None) -> float:
        flow = self.flow(text)
        return sum(self.symbol(flow[at - self.order : at], flow[at]) for at in range(self.order, len(flow)))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def unigrams(rows: list[tuple[int | None, str | None]]) -> dict[int | None, tuple[int, int, int, float]]:
    """doc_id -> tokens, known tokens, training tokens, score"""
    counts: Counter = Counter()
    for i, t in rows:
        if not held_out(i):
            counts.update([*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    out = {}
    for i, t in rows:
        own = [*words(t), None]
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        out[i] = (len(own), sum(w in counts for w in own), total, score)
    return out


def tiling(text: list[str], item: list[str], n: int) -> int:
    """Covered words of the item by greedy string tiling, straight from its definition."""
    used_text, used_item, covered = [False] * len(text), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(text)):
                size = 0
                while i + size < len(text) and j + size < len(item) and text[i + size] == item[j + size] and not used_text[i + size] and not used_item[j + size]:
                    size += 1
                if size > best[0]:
                    best = (size, i, j)
        size, i, j = best
        if size < n:
            return covered
        used_text[i : i + size] = used_item[j : j + size] = [True] * size
        covered += size


PATTERNS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def pii(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                doubled = (int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
                good = 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            else:
                good = kind == "email" or 10 <= len(digits) <= 15
            if good:
                out.append((m.start(), number, m.end()))
    return sorted(out)
