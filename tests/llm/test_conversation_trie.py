"""The conversation trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tarmac.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, ids string"


def plain_sequences(rows) -> dict:
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()), (role, text)))
    return {c: [x for _, x in sorted(own[c])] for c in own}


def plain_trie(seqs: dict) -> Counter:
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = Counter()
    for p, m in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], sum(not kids[q] for q in sub), saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def rebuilt(seqs: dict) -> dict:
    def h(c):
        return zlib.crc32(str(c).encode()) % 9
    return {c: seqs.get(c - int(c - 5 * int(c / 5)), [])[:h(c)] + s[h(c):] for c, s in seqs.items()}


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def chats(ready):
    """Shared starts, a very common conversation, one of 150 turns twice (and its start),
    NULLs, ties, repeated rows, a row without a conversation, clashing names."""
    rng = random.Random(5)
    rows = []
    for c in range(60):
        seq = [("user", f"q{rng.randrange(3)}"), ("bot", f"a{rng.randrange(2)}é"), ("user", f"x{rng.randrange(4)}")][:rng.randrange(1, 4)]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(seq)]
    rows += [(c, i, "user", f"common {i}") for c in range(100, 160) for i in range(3)]
    rows += [(c, i, "user", f"long {i}") for c, n in ((-7, 150), (200, 150), (201, 70), (202, 151)) for i in range(n)]
    rows += [(300, None, "user", "no number"), (300, 1, None, "tie"), (300, 1, "user", None), (300, 1, "user", None), (None, 1, "user", "lost"), (301, 0, None, None)]
    return [(*r, "n", 1, "i") for r in rows]


@pytest.mark.parametrize("shards", [1, 11])
def test_trie(ready, chats, shards, monkeypatch):
    monkeypatch.setattr(ct, "partitions", lambda spark: shards)
    monkeypatch.setattr(ct, "PIECE_IDS", 4)
    df = ready.createDataFrame(chats, SCHEMA).repartition(3)
    seqs = plain_sequences(chats)
    each = ct.conversations(df)
    assert rows_of(ct.prefix_trie(each)) == plain_trie(seqs)
    assert rows_of(ct.prefix_trie(ct.with_shared_heads(each))) == plain_trie(rebuilt(seqs))


def test_only_turnless_and_empty(ready):
    none = ready.createDataFrame([], SCHEMA)
    assert ct.prefix_trie(ct.conversations(none)).count() == 0
    # a conversation shorter than its head whose head is missing has no turns: the root alone
    c = next(x for x in range(1, 99) if x % 5 and zlib.crc32(str(x).encode()) % 9 > 1)
    one = ready.createDataFrame([(c, 0, "user", "x", "", 1, "")], SCHEMA)
    got = rows_of(ct.prefix_trie(ct.with_shared_heads(ct.conversations(one))))
    assert got == Counter({(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest()): 1})
