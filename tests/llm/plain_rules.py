"""Plain versions of conversation repair, rule measures and the manifest, for small tables."""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- conversations


def damaged(rows):
    """(conv, turn, role, text) after damage."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def step(state, initial):
    """Grammar by prefix: what has been written so far is '', 's', '..u' or '..a'."""
    if initial == "s":
        return "s" if state == "" else None
    wanted = "a" if state == "u" else "u"
    return initial if initial == wanted else None


def repaired(rows):
    """rows: (role, text, fault) in order -> (cost, audit, lines), over all edits."""

    @functools.cache
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if (then := step(state, role[0])) is not None:
                    c, a, lines = best(i, then, inserted + 1)
                    options.append((5 + c, "I" + a, (f"{role}:", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, lines = best(i + 1, state, 0)
            options.append((2 + c, "D" + a, lines))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role and (then := step(state, role[0])) is not None:
                    c, a, lines = best(i + 1, then, 0)
                    options.append((extra + c, "K" + a, (f"{role}:{text}", *lines)))
                for other in ("user", "assistant"):
                    if (then := step(state, other[0])) is not None:
                        c, a, lines = best(i + 1, then, 0)
                        options.append((1 + extra + c, "R" + a, (f"{other}:{text}", *lines)))
        return min(options) if options else (10**9, "", ())

    for i in range(len(rows), 0, -100):  # not too deep at once
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def conversations(ids, rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)"""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn, role, text))
    out = {}
    for conv in ids:
        own = sorted(held.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, marked = set(), []
        for _, role, text in own:
            solid = text.strip(SPACE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        count = Counter(f for _, _, f in marked)
        initials = [r[:1] for r, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = repaired(tuple(marked))
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(lines)))
    return out


# -- rules


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), [0] * len(words)
    for i, window in enumerate(windows):
        if count[window] > 1:
            covered[i : i + 8] = [1] * 8
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(covered)


# -- manifest


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout=16):
    """Root and, for each node, the (left, right) siblings level by level."""
    ways, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for lo in range(0, len(nodes), fanout):
            run = nodes[lo : lo + fanout]
            for k in range(len(run)):
                for i in owners[lo + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            above_owners.append([i for own in owners[lo : lo + fanout] for i in own])
        nodes, owners = above, above_owners
    return nodes[0], ways


def manifest(rows, fanout=16):
    """rows: (doc_id, source, lang, n_chars, text) -> rows of the query, sorted."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: (sorted(groups[s], key=lambda x: x[:3]), *tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fanout)) for s in names}
    if not names:
        return []
    root, tops = tree([built[s][1] for s in names], fanout)
    out = []
    for s, top in zip(names, tops, strict=True):
        held, subroot, ways = built[s]
        for (_, _, own, row), way in zip(held, ways, strict=True):
            way, node = way + top, own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in way:
                node = sha(left + node + right)
            out.append((row[0], own, subroot, root, sha("".join(left + right for left, right in way)), node, node == root))
    return sorted(out, key=repr)
