"""Removal of byte strings that occur earlier, by a hash-compared suffix sort.

A string of ``width`` bytes is removed where it also starts earlier (smaller document, or the
same document further left). Not every suffix of the corpus is sorted: of each window of
``width`` bytes the ``GRAM`` bytes of least hash are its anchor. Equal windows have equal
anchors at equal places, so only suffixes at anchors that occur twice are candidates (the
anchors are about 1 in 26 bytes).

1. Prefix polynomial hashes (modulo 2^64) give every gram's hash; a sliding minimum gives the
   anchors and, for each, the run of windows it stands for. Anchor hashes are counted over
   all documents; those met more than once are noted in a Bloom filter of fixed size.
2. Candidate anchors are grouped by their gram and the hash of all bytes of their windows:
   of equal ones all but the earliest are removed whole, whatever their number.
3. Only the earliest ones remain, where one gram has several surroundings (the edges of
   repeats). Their suffixes are sorted by mergesort; two suffixes are compared by their
   longest common extension, found by binary search over prefix hashes, so a comparison takes
   a logarithmic number of steps. Intervals of long common prefixes with equal bytes to the
   left are equal windows. Equal hashes are checked on the bytes. Grams with very many
   surroundings are sorted in blocks, whose distinct windows meet by their digests.
4. The removed intervals of a document are united and cut out.

Rules: text is taken as UTF-8 bytes; NULL is empty. Matches never cross documents and are
judged on the input. Documents are ordered by id, those without one last; rows of equal id by
a hash of the text; rows of equal id and text are the same document and get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.bloom import in_bloom, make_bloom
from tarmac.llm.common import map_slices, mix, partitions, save, slices
from tarmac.llm.prefix_hash import PrefixHashes, common_extension, span_hashes

WIDTH = 100
GRAM = 50
#: Bytes hashed at a time; longer texts are taken in overlapping parts.
PART = 1 << 18
#: Suffixes of one gram that are sorted together.
BLOCK = 4000
BLOOM_BITS = 25


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in each window (the first of equals). Values are cut to their
    high bits, the low ones hold the place in a block of ``width``; a window is the end of
    one block and the beginning of the next, so running minima within blocks give it."""
    n = len(values) - width + 1
    low = np.uint64(max(width - 1, 1).bit_length())
    blocks = -(-len(values) // width)
    table = np.full(blocks * width, ~np.uint64(0))
    table[:len(values)] = values >> low << low
    table = table.reshape(blocks, width)
    table |= np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(table, axis=1).ravel()[width - 1:width - 1 + n]
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
    right = ahead >> low < behind >> low
    start = np.arange(n) // width * width
    place = np.where(right, ahead, behind) & ((np.uint64(1) << low) - np.uint64(1))
    return start + place.astype(np.int64) + np.where(right, width, 0)


class Anchors:
    """Anchors of one part of a batch: for each its place, first window, windows and document."""

    def __init__(self, data: bytes, bounds: np.ndarray, width: int):
        self.data = np.frombuffer(data, np.uint8)
        self.bounds, self.width = bounds, width
        self.at = self.first = self.count = self.doc = np.zeros(0, np.int64)
        self.gram = np.zeros(0, np.uint64)
        if len(self.data) < width:
            return
        grams = mix(span_hashes(self.data, GRAM))
        owner = sliding_least(grams, width - GRAM + 1)
        # an anchor's run of windows ends where the owner changes or its document ends
        cuts = [np.flatnonzero(owner[1:] != owner[:-1]) + 1, bounds[:-1], bounds[1:] - width + 1]
        first = np.unique(np.concatenate(cuts))
        first = first[(first >= 0) & (first < len(owner))]
        count = np.diff(np.append(first, len(owner)))
        doc = np.searchsorted(bounds, first, "right") - 1
        inside = first + width <= bounds[doc + 1]
        self.first, self.count, self.doc = first[inside], count[inside], doc[inside]
        self.at = owner[self.first]
        self.gram = grams[self.at]

    @cached_property
    def hashes(self) -> PrefixHashes:
        return PrefixHashes(self.data)

    def surroundings(self, keep: np.ndarray) -> np.ndarray:
        """Hash of all bytes of the kept anchors' windows and of their place around them."""
        if not len(keep):
            return np.zeros(0, np.uint64)
        at, first, count = self.at[keep], self.first[keep], self.count[keep]
        whole = self.hashes.spans(first, first + count - 1 + self.width)
        return mix(whole * np.uint64(0x9E3779B97F4A7C15) + ((at - first) << 32 | count).astype(np.uint64))


def parts(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Anchors]]:
    """(d, t, offset of each text part in its document, rows, anchors) of bounded parts of a batch."""
    for part in slices(batch, "text", PART):
        d, t = (np.asarray(part.column(c)).astype(np.int64) for c in ("d", "t"))
        texts, rows, offsets = [], [], []

        def flush():
            row = np.array(rows, np.int64)
            found = Anchors(b"".join(texts), np.cumsum([0, *map(len, texts)]), width)
            return d[row], t[row], np.array(offsets, np.int64), row, found

        for r, text in enumerate(part.column("text").to_pylist()):
            raw = text.encode()
            if len(raw) <= 2 * PART:
                texts.append(raw)
                rows.append(r)
                offsets.append(0)
                continue
            for a in range(0, len(raw) - width + 1, PART):  # windows [a, a + PART)
                if texts:
                    yield flush()
                texts, rows, offsets = [raw[a:a + PART + width - 1]], [r], [a]
            yield flush()
            texts, rows, offsets = [], [], []
        if texts:
            yield flush()


def record_ids(gram: np.ndarray, d: np.ndarray, t: np.ndarray, x: np.ndarray) -> np.ndarray:
    return mix(gram ^ mix(d.view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) ^ mix(t.view(np.uint64)) + x.astype(np.uint64))


def merge_sort(h: PrefixHashes, data: np.ndarray, starts: np.ndarray, limit: int) -> np.ndarray:
    """Order of the suffixes data[start:], compared over ``limit`` bytes; bottom-up merges,
    all pairs of runs at once. An element's place is its place in its run plus its rank in
    the other run, found by binary search."""
    n = len(starts)
    order = np.arange(n)

    def before(a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        x, y = starts[a], starts[b]
        ext = common_extension(h, x, h, y, limit)
        end = ext >= limit
        cx, cy = data[np.minimum(x + ext, len(data) - 1)], data[np.minimum(y + ext, len(data) - 1)]
        return np.where(end, or_equal, cx < cy)

    run = 1
    while run < n:
        place = np.arange(n)
        mine = place // run
        left = mine % 2 == 0
        other = np.where(left, (mine + 1) * run, (mine - 1) * run)
        low = np.minimum(other, n)
        high = np.minimum(other + run, n)
        while (low < high).any():
            i = np.flatnonzero(low < high)
            mid = (low[i] + high[i]) >> 1
            # elements of the other run before this one; equal ones only from the left run
            less = before(order[mid], order[i], ~left[i])
            low[i] = np.where(less, mid + 1, low[i])
            high[i] = np.where(less, high[i], mid)
        rank = low - np.minimum(other, n)
        target = np.where(left, place, place - run) + rank
        merged = np.empty(n, np.int64)
        merged[target] = order
        order = merged
        run *= 2
    return order


def equal_windows(contexts: list[bytes], left: np.ndarray, count: np.ndarray, key: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, window number, earliest?) of all windows of anchors' surroundings.

    ``left`` is the anchor's place in its context, ``count`` the number of windows; ``key``
    (document, text, place: most significant first) orders the contexts. Only suffixes at
    the anchors are sorted; a window is a piece to the left and a prefix of that suffix.
    """
    m = len(contexts)
    span = width - GRAM + width
    table = np.zeros((m, span + 1), np.uint8)
    for i, (c, a) in enumerate(zip(contexts, left.tolist(), strict=True)):
        table[i, width - GRAM - a:width - GRAM - a + len(c)] = np.frombuffer(c, np.uint8)
    flat = table.ravel()
    h = PrefixHashes(flat)
    anchor = np.arange(m) * (span + 1) + width - GRAM
    order = merge_sort(h, flat, anchor, width)
    common = np.zeros(m, np.int64)
    common[1:] = common_extension(h, anchor[order[:-1]], h, anchor[order[1:]], width)
    seq = np.empty(m, np.int64)
    seq[np.lexsort(key[::-1])] = np.arange(m)
    ctx, number, early = [], [], []
    for l in range(width - GRAM + 1):  # windows that begin l bytes before the anchor
        interval = np.cumsum(common < width - l)
        has = (l <= left[order]) & (left[order] - l < count[order])
        own = order[has]
        if not len(own):
            continue
        before = h.spans(anchor[own] - l, anchor[own])
        # the place among equal documents: the same l, so the anchors' order is the windows'
        sort = np.lexsort((seq[own], before, interval[has]))
        own, group, before = own[sort], interval[has][sort], before[sort]
        same = np.zeros(len(own), bool)
        same[1:] = (group[1:] == group[:-1]) & (before[1:] == before[:-1])
        i = np.flatnonzero(same)
        if len(i):  # collisions: the bytes decide
            cols = slice(width - GRAM - l, width - GRAM - l + width)
            same[i] = (table[own[i], cols] == table[own[i - 1], cols]).all(axis=1)
        ctx.append(own)
        number.append(left[own] - l)
        early.append(~same)
    return np.concatenate(ctx), np.concatenate(number), np.concatenate(early)


class Dedup:
    def __init__(self, docs: DataFrame, width: int):
        self.docs, self.width, self.spark = docs, width, docs.sparkSession

    def grams(self) -> DataFrame:
        """Anchor hashes met more than once."""
        width = self.width

        def run(batches):
            for batch in batches:
                for *_, a in parts(batch, width):
                    own, n = np.unique(a.gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n.astype(np.int32))], names=["gram", "c"])

        return self.docs.mapInArrow(run, "gram long, c int").groupBy("gram").agg(F.sum("c").alias("c")).where("c > 1")

    def records(self) -> DataFrame:
        """Anchors whose gram is met more than once (or nearly so: Bloom filter)."""
        width = self.width
        bloom = make_bloom(self.grams(), "gram", BLOOM_BITS)

        def run(batches):
            for batch in batches:
                for d, t, offset, _, a in parts(batch, width):
                    gram = a.gram
                    keep = np.flatnonzero(in_bloom(bloom.value, gram))
                    doc = a.doc[keep]
                    x = a.at[keep] - a.bounds[doc] + offset[doc]
                    got = (gram[keep].view(np.int64), a.surroundings(keep).view(np.int64), d[doc], t[doc], x, a.at[keep] - a.first[keep], a.count[keep], record_ids(gram[keep], d[doc], t[doc], x).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(got, [pa.int64()] * 4 + [pa.int64(), pa.int32(), pa.int32(), pa.int64()], strict=True)], names=["gram", "sig", "d", "t", "x", "l", "c", "rid"])

        return save(self.docs.mapInArrow(run, "gram long, sig long, d long, t long, x long, l int, c int, rid long"), "anchors")

    def contexts(self, wanted: DataFrame) -> DataFrame:
        """The bytes around the wanted anchors (gram, sig, d, t, x, l, c, rid, salt)."""
        width = self.width
        bloom = make_bloom(wanted, "rid", BLOOM_BITS)

        def run(batches):
            for batch in batches:
                for d, t, offset, _, a in parts(batch, width):
                    doc = a.doc
                    x = a.at - a.bounds[doc] + offset[doc]
                    rid = record_ids(a.gram, d[doc], t[doc], x)
                    keep = np.flatnonzero(in_bloom(bloom.value, rid))
                    data = a.data.tobytes()
                    got = [data[f:f + n - 1 + width] for f, n in zip(a.first[keep].tolist(), a.count[keep].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(rid[keep].view(np.int64)), pa.array((a.first - a.bounds[doc] + offset[doc])[keep]), pa.array(got, pa.binary())], names=["rid", "f", "bytes"])

        found = self.docs.mapInArrow(run, "rid long, f long, bytes binary")
        return found.join(wanted, "rid").where("f = x - l").dropDuplicates(["rid", "f"])

    def edges(self, contexts: DataFrame) -> DataFrame:
        """(d, t, a, b): removed windows of contexts as runs; (digest) rows of blocks that must meet others."""
        width = self.width

        def work(rows: list[dict]) -> pa.RecordBatch:
            col = lambda c: np.array([r[c] for r in rows], np.int64)
            d, t, f, count = col("d"), col("t"), col("f"), col("c")
            texts = [r["bytes"] for r in rows]
            ctx, number, early = equal_windows(texts, col("l"), count, [d, t, col("x")], width)
            out: dict[str, list] = {k: [] for k in ("d", "t", "a", "b", "digest")}

            def add(i, a, b, digest=None):
                for k, v in zip(out, (int(d[i]), int(t[i]), a, b, digest), strict=True):
                    out[k].append(v)

            gone = np.flatnonzero(~early)
            gone = gone[np.lexsort((number[gone], ctx[gone]))]
            c, w = ctx[gone], number[gone]
            new = np.ones(len(gone), bool)
            new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1] + 1)
            s = np.flatnonzero(new)
            for i, j in zip(s, np.append(s[1:], len(gone)) - 1, strict=True) if len(gone) else ():
                add(c[i], int(f[c[i]] + w[i]), int(f[c[j]] + w[j] + width))
            many = np.array([r["salts"] > 1 for r in rows])
            for i, w in zip(ctx[early].tolist(), number[early].tolist(), strict=True):
                if many[i]:
                    a = int(f[i]) + w
                    add(i, a, a + width, hashlib.blake2b(texts[i][w:w + width], digest_size=16).digest())
            return pa.RecordBatch.from_arrays([pa.array(out[k], pa.binary() if k == "digest" else pa.int64()) for k in out], names=list(out))

        def run(batches):
            held: list[dict] = []
            for batch in batches:
                for r in batch.to_pylist():
                    if len(held) >= 5 * BLOCK and (r["gram"], r["salt"]) != (held[-1]["gram"], held[-1]["salt"]):
                        yield work(held)
                        held = []
                    held.append(r)
            if held:
                yield work(held)

        n = partitions(self.spark)
        dealt = contexts.repartition(n, "gram", "salt").sortWithinPartitions("gram", "salt")
        return save(dealt.mapInArrow(run, "d long, t long, a long, b long, digest binary"), "edges")

    def intervals(self) -> DataFrame:
        """(d, t, spans): removed intervals per document."""
        records = self.records()
        leaders = save(records.groupBy("gram", "sig").agg(F.min(F.struct("d", "t", "x", "l", "c", "rid")).alias("f"), F.count("*").alias("n")), "leaders")
        lead = F.col("f.rid")
        copies = records.join(leaders.where("n > 1").select("gram", "sig", lead.alias("lead")), ["gram", "sig"]).where("rid <> lead")
        whole = copies.select("d", "t", (F.col("x") - F.col("l")).alias("a"), (F.col("x") - F.col("l") + F.col("c") - 1 + self.width).alias("b"))
        several = leaders.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1")
        salts = F.ceil(F.col("k") / BLOCK).cast("int")
        wanted = save(
            leaders.join(several, "gram").select("gram", "f.*", salts.alias("salts")).withColumn("salt", F.pmod(F.col("rid"), F.col("salts").cast("long")).cast("int")),
            "wanted",
        )
        edges = self.edges(self.contexts(wanted))
        single = edges.where("digest is null").select("d", "t", "a", "b")
        meet = edges.where("digest is not null")
        least = meet.groupBy("digest").agg(F.min(F.struct("d", "t", "a")).alias("m"), F.count("*").alias("n")).where("n > 1")
        later = meet.join(least, "digest").where(F.struct("d", "t", "a") != F.col("m")).select("d", "t", "a", "b")
        every = whole.union(single).union(later)
        return every.groupBy("d", "t").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))


def united(spans) -> list[tuple[int, int]]:
    """Maximal runs of sorted intervals [a, b)."""
    out: list[list[int]] = []
    for s in spans or ():
        if out and s["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return [(a, b) for a, b in out]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("doc_id"), text.alias("text"), F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(text).alias("t"))


def suffix_dedup(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for every row; ``kept`` is
    the remaining bytes."""
    if width < 2 * GRAM:
        raise ValueError(f"width must be {2 * GRAM} or more")
    base = keyed(docs, id_col, text_col)
    cuts = Dedup(base.select("text", "d", "t"), width).intervals()
    joined = base.join(cuts, ["d", "t"], "left").select("doc_id", "text", "spans")
    kind = base.schema["doc_id"].dataType.simpleString()

    def task():
        def each(part: pa.RecordBatch) -> dict:
            raws, kept, runs = [t.encode() for t in part.column("text").to_pylist()], [], []
            for raw, spans in zip(raws, part.column("spans").to_pylist(), strict=True):
                cut = united(spans)
                edges = [0, *[e for ab in cut for e in ab], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                runs.append(len(cut))
            out = {
                "doc_id": part.column("doc_id"),
                "n_bytes": pa.array(map(len, raws), pa.int64()),
                "n_removed": pa.array([len(r) - len(k) for r, k in zip(raws, kept, strict=True)], pa.int64()),
                "n_spans": pa.array(runs, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            }
            return out | {"kept": pa.array(kept, pa.binary())} if texts else out

        return each

    return map_slices(joined, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if texts else ""), task)
