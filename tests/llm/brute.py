"""Plain Python versions of the text operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(docs: dict, items: dict, window: int = 13) -> dict:
    """id -> (n_words, n_hit, sorted items, contaminated)."""
    owners = defaultdict(set)
    for item, text in items.items():
        w = FOLDED.findall((text or "").translate(ASCII_LOWER))
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            owners[tuple(w[i:i + k])].add(str(item))
    out = {}
    for d, text in docs.items():
        w = FOLDED.findall((text or "").translate(ASCII_LOWER))
        hit, found = set(), set()
        for k in {len(x) for x in owners}:
            for i in range(len(w) - k + 1):
                if own := owners.get(tuple(w[i:i + k])):
                    found |= own
                    hit.update(range(i, i + k))
        out[d] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def shingles(text: str | None, n: int = 5) -> set:
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(docs: dict, share: int = 80) -> dict:
    """id -> (set size, least id reachable)."""
    sets = {d: shingles(t) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    met = defaultdict(list)
    for d in sorted(sets):
        for e, both in Counter(e for s in sets[d] for e in met[s]).items():
            if 100 * both >= share * (len(sets[d]) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            met[s].append(d)
    return {d: (len(sets[d]), root(d)) for d in docs}


def suffix_dedup(docs: list[tuple], width: int = 100) -> dict:
    """id -> (kept bytes, removed, runs); docs in order."""
    seen, out = set(), {}
    for d, text in docs:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - width + 1):
            w = raw[p:p + width]
            if w in seen:
                gone[p:p + width] = [True] * width
            seen.add(w)
        runs = sum(g and not h for g, h in zip(gone, [False, *gone], strict=False))
        out[d] = bytes(b for b, g in zip(raw, gone, strict=True) if not g), sum(gone), runs
    return out


def line_dedup(docs: list[tuple], min_words: int = 10) -> dict:
    """id -> (non-blank lines kept, lines deleted); docs in order. From each place the longest run
    that also starts earlier, found line by line, goes if it holds enough words."""
    lines = [(d, [x for x in (text or "").split("\n") if x.encode().strip()]) for d, text in docs]
    gone, met = defaultdict(set), defaultdict(list)
    for d, x in lines:
        for k in range(len(x)):
            best = 0
            for y, j in met[x[k]]:
                size = 0
                while max(j - len(y), k - len(x)) + size < 0 and x[k + size] == y[j + size]:
                    size += 1
                best = max(best, size)
            if sum(max(s.count(" ") + 1, len(s.encode()) // 20) for s in x[k:k + best]) >= min_words:
                gone[d].update(range(k, k + best))
            met[x[k]].append((x, k))
    return {d: ([s for k, s in enumerate(x) if k not in gone[d]], len(gone[d])) for d, x in lines}
