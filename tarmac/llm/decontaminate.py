"""Benchmark decontamination by binary search in suffix arrays of the training text.

Each task turns the documents it holds into shards of about ``SHARD_WORDS`` words, maps
words to the benchmark's word numbers and sorts the shard's suffixes (a suffix array; only
suffixes whose first words all occur in the benchmark can match, the others are left out).
Every benchmark window (``window`` consecutive words of an item) is then binary-searched in
the array, all windows at once; the range found gives every place where it occurs. Places
that go on along the same item are joined to the longest verbatim matches. Documents are
judged by the share of their words inside matches.

The documents are neither shuffled nor copied. The benchmark is taken in blocks of at most
``BLOCK_WORDS`` words; each block is broadcast, so what a task holds does not grow with
the benchmark, and a task searches each of its shards against each block in turn.

Rules: A-Z are lower-cased; words are runs of digits, a-z and non-ASCII characters. An item
shorter than the window, but not empty, is one window; an empty or NULL item has none. A
NULL or empty document has no words and is not contaminated. Repeated rows are judged each;
a NULL doc_id is carried through; rows of an equal item_id count as one item, a NULL
item_id as the item "". Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import free_name, id_and_text, map_slices

SHARD_WORDS = 1 << 20
BLOCK_WORDS = 4 << 20
#: Bytes that are part of words: digits, letters (upper case is folded first), non-ASCII.
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Block:
    """A part of the benchmark: its words numbered from 1, and its distinct windows by length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        number = self.vocabulary
        by_window: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(items):
            ids = [number.setdefault(w, len(number) + 1) for w in words]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1):
                by_window[tuple(ids[at:at + size])].append((k, at))
        self.bits = max(1, len(number).bit_length())
        self.per_key = 63 // self.bits
        self.windows: dict[int, tuple[np.ndarray, list]] = {}
        for size in sorted({len(w) for w in by_window}):
            own = [w for w in by_window if len(w) == size]
            self.windows[size] = np.array(own, np.int64), [by_window[w] for w in own]
        self.least = min(self.windows, default=0)
        self.most = max(self.windows, default=0)

    def keys(self, ids: np.ndarray, starts: np.ndarray, size: int) -> list[np.ndarray]:
        """The first ``size`` words from each start, packed into integers that sort alike.
        ``ids`` is padded by zeros."""
        out = []
        for a in range(0, size, self.per_key):
            key = np.zeros(len(starts), np.int64)
            for j in range(a, min(a + self.per_key, size)):
                key = (key << self.bits) | ids[starts + j]
            out.append(key)
        return out


def suffix_array(ids: np.ndarray, block: Block) -> np.ndarray:
    """Starts of the suffixes that begin with ``block.least`` known words, in the order of
    their first ``block.most`` words. ``ids`` ends with at least ``block.most`` zeros."""
    zeros = np.flatnonzero(ids == 0)
    next_zero = zeros[np.searchsorted(zeros, np.arange(len(ids) - block.most))]
    starts = np.flatnonzero(next_zero - np.arange(len(next_zero)) >= block.least)
    return starts[np.lexsort(block.keys(ids, starts, block.most)[::-1])] if len(starts) else starts


def _less(a: list[np.ndarray], at: np.ndarray, b: list[np.ndarray], or_equal: bool) -> np.ndarray:
    """Whether a[at] < b (or <=), comparing keys in turn."""
    out, same = np.zeros(len(at), bool), np.ones(len(at), bool)
    for x, y in zip(a, b, strict=True):
        v = x[at]
        out |= same & (v < y)
        same &= v == y
    return out | same if or_equal else out


def search(ids: np.ndarray, array: np.ndarray, block: Block) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(window length, window numbers, starts) of every occurrence of a window."""
    found = []
    for size, (windows, _) in block.windows.items():
        n, w = len(array), len(windows)
        if not n:
            continue
        have = block.keys(ids, array, size)
        flat = np.append(windows.ravel(), np.zeros(size, np.int64))
        want = block.keys(flat, np.arange(w) * size, size)
        edge = []
        for or_equal in (False, True):  # first suffix not below the window, first above it
            low, high = np.zeros(w, np.int64), np.full(w, n, np.int64)
            for _ in range(n.bit_length()):
                open_ = low < high
                mid = np.minimum((low + high) >> 1, n - 1)
                right = _less(have, mid, want, or_equal) & open_
                low = np.where(right, mid + 1, low)
                high = np.where(open_ & ~right, mid, high)
            edge.append(low)
        lens = edge[1] - edge[0]
        which = np.repeat(np.arange(w), lens)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(lens) - lens, lens)
        found.append((size, which, array[edge[0][which] + offset]))
    return found


def benchmark_blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_words: int):
    """Broadcast blocks of the benchmark; the driver holds one block's words at a time."""
    sc = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("i"), benchmark[text_col].alias("t"))
    blocks, items, size = [], [], 0
    for r in rows.toLocalIterator():
        words = words_of(r["t"])
        if not words:
            continue
        for a in range(0, max(1, len(words) - window + 1), block_words):  # a huge item is cut, windows overlapping
            part = words[a:a + block_words + window - 1]
            items.append((r["i"], part))
            size += len(part)
            if size >= block_words:
                blocks.append(sc.broadcast(Block(items, window)))
                items, size = [], 0
    if items or not blocks:
        blocks.append(sc.broadcast(Block(items, window)))
    return blocks


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    min_share: tuple[int, int] = (1, 20),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: n_words, n_hit (words inside matches), n_items, items (names
    of the matched items, sorted), items_sha256, contaminated (n_hit / n_words >= min_share),
    longest_match, longest_at (words and first word of the longest verbatim match) and spans
    (of the matched words, [start, end)).

    With ``keep`` the named columns of ``docs`` are returned instead, for the documents that
    are not contaminated.
    """
    blocks = benchmark_blocks(benchmark, window, item_col, item_text_col, block_words)
    part, whole = min_share

    def judge(texts: list[str]) -> list[dict]:
        words = [words_of(t) for t in texts]
        out = []
        a = 0
        while a < len(words):  # shards of a bounded number of words, one document at least
            b, n = a, 0
            while b < len(words) and (b == a or n + len(words[b]) <= SHARD_WORDS):
                n += len(words[b])
                b += 1
            out += judge_shard(words[a:b])
            a = b
        return out

    def judge_shard(words: list[list[bytes]]) -> list[dict]:
        lens = np.array([len(w) + 1 for w in words], np.int64)
        first = np.cumsum(lens) - lens
        total = int(lens.sum())
        cover = np.zeros(total + 1, np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        longest = [(0, 0)] * len(words)
        for blk in blocks:
            block = blk.value
            if not block.most:
                continue
            ids = np.zeros(total + block.most, np.int64)
            get = block.vocabulary.get
            for f, w in zip(first.tolist(), words, strict=True):
                ids[f:f + len(w)] = np.fromiter((get(x, 0) for x in w), np.int64, len(w))
            array = suffix_array(ids, block)
            for size, which, starts in search(ids, array, block):
                if not len(starts):
                    continue
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + size, -1)
                doc = np.searchsorted(first, starts, side="right") - 1
                places = block.windows[size][1]
                runs = defaultdict(list)  # (document, item, diagonal) -> starts, joined to the longest matches
                for d, w, s in zip(doc.tolist(), which.tolist(), starts.tolist(), strict=True):
                    for item, at in places[w]:
                        items[d].add(block.names[item])
                        runs[d, item, s - at].append(s)
                for (d, _, _), ss in runs.items():
                    ss.sort()
                    begin = last = ss[0]
                    for s in [*ss[1:], None]:
                        if s is None or s > last + 1:
                            longest[d] = max(longest[d], (last - begin + size, -(begin - int(first[d]))))
                            begin = s
                        last = s
        hit = np.cumsum(cover[:-1]) > 0
        n_hit = np.add.reduceat(hit.astype(np.int64), first) if len(words) else np.zeros(0, np.int64)
        rows = []
        for d, w in enumerate(words):
            names, n = sorted(items.get(d, ())), int(n_hit[d])
            spans = []
            if n:
                own = np.flatnonzero(np.diff(np.concatenate([[0], hit[first[d]:first[d] + len(w)].astype(np.int8), [0]])))
                spans = [{"start": int(x), "end": int(y)} for x, y in own.reshape(-1, 2)]
            rows.append({"n_words": len(w), "n_hit": n, "items": names, "contaminated": bool(n and whole * n >= part * len(w)), "longest_match": longest[d][0], "longest_at": -longest[d][1], "spans": spans})
        return rows

    if keep is not None:
        text = free_name(docs, "__checked_text")
        kept = docs.select(*[docs[c] for c in keep], F.coalesce(docs[text_col], F.lit("")).alias(text))
        schema = kept.drop(text).schema

        def filter_task(batches):
            for batch in batches:
                from tarmac.llm.common import slices

                for p in slices(batch, text):
                    good = [not r["contaminated"] for r in judge(p.column(text).to_pylist())]
                    yield pa.RecordBatch.from_arrays(p.columns[:-1], names=p.schema.names[:-1]).filter(pa.array(good, pa.bool_()))

        return kept.mapInArrow(filter_task, schema)

    def task():
        def each(p: pa.RecordBatch) -> dict:
            rows = judge(p.column("text").to_pylist())
            col = lambda c, t: pa.array([r[c] for r in rows], t)
            return {
                "doc_id": p.column("doc_id"),
                "n_words": col("n_words", pa.int64()),
                "n_hit": col("n_hit", pa.int64()),
                "n_items": pa.array([len(r["items"]) for r in rows], pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(r["items"]).encode()).hexdigest() for r in rows], pa.string()),
                "contaminated": col("contaminated", pa.bool_()),
                "longest_match": col("longest_match", pa.int64()),
                "longest_at": col("longest_at", pa.int64()),
                "items": col("items", pa.list_(pa.string())),
                "spans": col("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }

        return each

    base = id_and_text(docs, id_col, text_col)
    return map_slices(
        base,
        [f"doc_id {base.schema['doc_id'].dataType.simpleString()}", "n_words bigint", "n_hit bigint", "n_items bigint", "items_sha256 string", "contaminated boolean", "longest_match bigint", "longest_at bigint", "items array<string>", "spans array<struct<start:bigint,end:bigint>>"],
        task,
    )
