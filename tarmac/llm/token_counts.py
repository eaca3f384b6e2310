"""Token counts under a unigram vocabulary, on a trie shared by all words of a task.

A word's best segmentation (highest sum of piece scores) is a forward recursion over its
characters: the best score of a prefix needs only the best scores of shorter prefixes.
Words with a common prefix share these values, so the distinct new pre-tokens of a slice of
text are put in a trie; every node is scored once (all nodes of one depth together), and the
node a word ends at holds its token count. A document's count is a sum of stored counts.

The counts of distinct words stay in the Python worker, up to ``max_words``; that is only a
cache, so memory is bounded whatever the vocabulary of the corpus, and no row moves between
tasks.

Rules: pre-tokens are the maximal runs without white space (``str.split``), each with the
word mark in front. Equal scores: the longer last piece wins. A character that no piece
covers counts as its UTF-8 bytes (byte fallback). NULL and empty texts have 0 tokens.
Repeated rows are counted each; a NULL id is carried through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm.common import id_and_text, map_slices

WORD_MARK = "▁"


def piece_scores(model_path: str) -> dict[str, float]:
    """Log-probabilities for the pieces of a vocabulary file, by the Zipf-Mandelbrot rule
    over the file's own order: p(rank) ~ 1 / (rank + 2.7). Control and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    ids.sort(key=lambda i: (-sp.get_score(i), i))
    total = math.log(sum(1 / (r + 2.7) for r in range(len(ids))))
    return {sp.id_to_piece(i): -math.log(r + 2.7) - total for r, i in enumerate(ids)}


class PieceTable:
    """Piece -> score by 64-bit polynomial hash: a sparse table, looked up for many spans at once."""

    SIZE_BITS = 20

    def __init__(self, scores: dict[str, float]):
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - 10.0
        names = list(scores)
        hashes = np.array([self.of(np.array([ord(c) for c in p], np.uint64)) for p in names], np.uint64)
        values = np.array([scores[p] for p in names], np.float64)
        self.layers = []
        while len(hashes):  # what collides in one layer goes to the next
            slot = self._slot(hashes, len(self.layers))
            _, first = np.unique(slot, return_index=True)
            key, val = np.zeros(1 << self.SIZE_BITS, np.uint64), np.full(1 << self.SIZE_BITS, -np.inf)
            key[slot[first]], val[slot[first]] = hashes[first], values[first]
            self.layers.append((key, val))
            rest = np.ones(len(hashes), bool)
            rest[first] = False
            hashes, values = hashes[rest], values[rest]

    @staticmethod
    def of(codes: np.ndarray) -> int:
        h = 0
        for c in codes.tolist():
            h = (h * BASE + c + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _slot(self, hashes: np.ndarray, layer: int) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * layer)) >> np.uint64(64 - self.SIZE_BITS)).astype(np.int64)

    def scores(self, hashes: np.ndarray) -> np.ndarray:
        """Score of each span, minus infinity where it is no piece."""
        out = np.full(len(hashes), -np.inf)
        for i, (key, val) in enumerate(self.layers):
            slot = self._slot(hashes, i)
            out = np.where(key[slot] == hashes, val[slot], out)
        return out


#: Multiplier of the span hashes (odd, 64 bits).
BASE = 0xD6E8FEB86659FD93
#: Words up to this length go through the trie together; longer ones one by one.
TRIE_DEPTH = 48


def trie_counts(words: list[str], table: PieceTable) -> tuple[dict[str, int], int]:
    """Token counts of distinct ``words``, and the number of trie nodes scored.

    Sorted words form a trie: word i makes the nodes deeper than its common prefix with
    word i - 1. All nodes of one depth are scored at once from the depths above; a word's
    count is read at its terminal node.
    """
    words = sorted(words)
    n = len(words)
    if not n:
        return {}, 0
    lens = np.fromiter(map(len, words), np.int64, n)
    m = int(lens.max())
    codes = np.array(words, dtype=f"U{m}").view(np.uint32).reshape(n, m).astype(np.uint64)
    shared = np.zeros(n, np.int64)
    shared[1:] = np.minimum.accumulate(codes[1:] == codes[:-1], axis=1).sum(axis=1)
    shared[1:] = np.minimum(shared[1:], np.minimum(lens[1:], lens[:-1]))
    prefix = [np.zeros(n, np.uint64)]  # hash of each word's prefix by length
    for d in range(m):
        prefix.append(prefix[-1] * np.uint64(BASE) + codes[:, d] + np.uint64(1))
    power = [np.uint64(pow(BASE, k, 1 << 64)) for k in range(table.longest + 1)]
    node = [np.zeros(n, np.int32)]  # of each word's prefix by length, numbered within the depth
    best, count = [np.zeros(1)], [np.zeros(1, np.int64)]
    result, nodes = np.zeros(n, np.int64), 0
    for d in range(1, m + 1):
        fresh = (shared < d) & (lens >= d)
        rows = np.flatnonzero(fresh)
        node.append((np.cumsum(fresh) - 1).astype(np.int32))
        top, cnt = np.full(len(rows), -np.inf), np.zeros(len(rows), np.int64)
        for k in range(min(d, table.longest), 0, -1):  # the longer last piece wins a tie
            span = prefix[d][rows] - prefix[d - k][rows] * power[k]
            s = table.scores(span)
            from_node = node[d - k][rows]
            value = best[d - k][from_node] + s
            better = value > top
            top = np.where(better, value, top)
            cnt = np.where(better, count[d - k][from_node] + 1, cnt)
            if k == 1:  # a character that is no piece
                value = np.where(np.isinf(s), best[d - 1][from_node] + table.unknown, -np.inf)
                better = value > top
                c = codes[rows, d - 1]
                size = 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
                top = np.where(better, value, top)
                cnt = np.where(better, count[d - 1][from_node] + size, cnt)
        best.append(top)
        count.append(cnt)
        nodes += len(rows)
        ends = np.flatnonzero(lens == d)
        result[ends] = cnt[node[d][ends]]
    return dict(zip(words, result.tolist(), strict=True)), nodes


def long_count(word: str, scores: dict[str, float], longest: int, unknown: float) -> int:
    """The same recursion for one long word; keeps the last ``longest`` values only."""
    best, count = [0.0], [0]
    for end in range(1, len(word) + 1):
        top, n = -math.inf, 0
        for k in range(min(end, longest), 0, -1):
            s = scores.get(word[end - k:end])
            if s is not None and best[-k] + s > top:
                top, n = best[-k] + s, count[-k] + 1
        if word[end - 1] not in scores and best[-1] + unknown > top:
            top, n = best[-1] + unknown, count[-1] + len(word[end - 1].encode())
        best, count = [*best[-longest:], top], [*count[-longest:], n]
    return count[-1]


class Counter:
    """Token counts per distinct word, remembered for the Python worker's later tasks."""

    def __init__(self, scores: dict[str, float], max_words: int):
        self.scores, self.table, self.max_words = scores, PieceTable(scores), max_words
        self.known: dict[str, int] = {}

    def counts(self, words: set[str]) -> dict[str, int]:
        if len(self.known) > self.max_words:
            self.known = {}
        new = [w for w in words if w not in self.known]
        short = [WORD_MARK + w for w in new if len(w) < TRIE_DEPTH and "\0" not in w]
        for i in range(0, len(short), 200_000):
            got, _ = trie_counts(short[i:i + 200_000], self.table)
            self.known.update((w[1:], n) for w, n in got.items())
        for w in new:
            if w not in self.known:
                self.known[w] = long_count(WORD_MARK + w, self.scores, self.table.longest, self.table.unknown)
        return self.known


_COUNTERS: dict = {}


def token_counts(docs: DataFrame, scores: dict[str, float], id_col: str = "doc_id", text_col: str = "text", max_words: int = 1_000_000) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, max_pretoken_tokens) for every row of ``docs``.

    ``scores`` (piece -> log-probability) is the vocabulary: a fixed table of the caller's,
    broadcast once.
    """
    table = docs.sparkSession.sparkContext.broadcast(scores)
    key = hash(frozenset(scores.items()))

    def task():
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(table.value, max_words)
        counter = _COUNTERS[key]

        def each(part: pa.RecordBatch) -> dict:
            lists = [t.split() for t in part.column("text").to_pylist()]
            counts = counter.counts(set().union(*lists))
            each_n = [list(map(counts.__getitem__, ws)) for ws in lists]
            return {
                "doc_id": part.column("doc_id"),
                "n_pretokens": pa.array(map(len, lists), pa.int64()),
                "n_tokens": pa.array(map(sum, each_n), pa.int64()),
                "max_pretoken_tokens": pa.array([max(x, default=0) for x in each_n], pa.int64()),
            }

        return each

    base = id_and_text(docs, id_col, text_col)
    return map_slices(base, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, n_pretokens bigint, n_tokens bigint, max_pretoken_tokens bigint", task)
