"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text (over code points, modulo two primes) gives the hash of any span
in constant time. A fingerprint keeps of it

* the length and the hash of the whole text: equal texts, and only these, have equal ones;
* the prefix hashes at ``GRID`` even places (multiples of a power of two, so that the places
  of a longer text are among those of a shorter one). Two fingerprints' longest common
  prefix is found by binary search over them;
* the ``SKETCH`` least mixed hashes of its spans of ``SPAN`` characters, which estimate the
  share of spans that two texts have in common, wherever they stand.

The likeness of two fingerprints is the larger of common prefix / longer length and the
estimated share of common spans (Dice); 1 only for equal fingerprints.

``neighbours`` walks the documents in ascending id order without a global sort: approximate
quantiles of the id cut it into buckets, each bucket is sorted in one task and read as a
stream that holds one document at a time, and the first document of each bucket is also sent
to the bucket before (the very first to the last). The text is moved once.

Rules: NULL is the empty text; two empty texts are equal. Ids are numbers; documents of equal
id are ordered by text, those without an id come last. Every row gives a row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import id_and_text, mix, partitions, slices
from tarmac.llm.prefix_hash import PrefixHashes

GRID = 32
SPAN = 16
SKETCH = 128


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def stride(n: int) -> int:
    """The least power of two with at most GRID multiples up to n."""
    s = 1
    while n // s > GRID:
        s *= 2
    return s


class Fingerprint:
    """Length, whole hash, prefix hashes on the grid, least span hashes."""

    __slots__ = ("n", "whole", "grid", "sketch")

    def __init__(self, n: int, whole: int, grid: np.ndarray, sketch: np.ndarray):
        self.n, self.whole, self.grid, self.sketch = n, whole, grid, sketch

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        h = PrefixHashes(code_points(text))
        s = stride(h.n)
        ends = np.arange(1, h.n // s + 1) * s
        grid = h.prefix[0][ends].astype(np.uint32)  # equal prefixes: no shift to undo
        last = max(h.n - SPAN, 0)
        starts = np.arange(last + 1 if h.n else 0)
        spans = mix(h.part(0, starts, np.minimum(starts + SPAN, h.n))) >> np.uint64(32)
        if len(spans) > 8 * SKETCH:  # the least few decide; repeated spans are rare among them
            least = np.unique(np.partition(spans, 4 * SKETCH)[:4 * SKETCH])
            spans = least if len(least) >= SKETCH else spans
        return cls(h.n, h.whole(), grid, np.unique(spans)[:SKETCH].astype(np.uint32))

    def __str__(self) -> str:
        head = struct.pack("<QQBB", self.n, self.whole, len(self.grid), len(self.sketch))
        return base64.b64encode(head + self.grid.tobytes() + self.sketch.tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        n, whole, g, k = struct.unpack_from("<QQBB", raw)
        rest = np.frombuffer(raw[18:], np.uint32)
        return cls(n, whole, rest[:g], rest[g:g + k])

    def common_prefix(self, other: Fingerprint) -> int:
        """A lower bound within one stride of the longest common prefix, by binary search."""
        s = max(stride(self.n), stride(other.n))
        a, b = self.grid[s // stride(self.n) - 1::s // stride(self.n)], other.grid[s // stride(other.n) - 1::s // stride(other.n)]
        low, high = 0, min(len(a), len(b))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if a[mid - 1] == b[mid - 1] else (low, mid - 1)
        return low * s

    def likeness(self, other: Fingerprint) -> float:
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        longer = max(self.n, other.n)
        union = np.union1d(self.sketch, other.sketch)[:SKETCH]
        both = np.isin(union, self.sketch, assume_unique=True) & np.isin(union, other.sketch, assume_unique=True)
        jaccard = both.sum() / len(union) if len(union) else 0.0
        return float(min(max(self.common_prefix(other) / longer, 2 * jaccard / (1 + jaccard)), 1 - 1 / (longer + 1)))


def neighbours(docs: DataFrame, schema: str, each: Callable[[tuple, tuple], tuple]) -> DataFrame:
    """``each((doc_id, text), next (doc_id, text))`` for every row of ``docs`` (doc_id,
    text), in ascending id order; the last row's next is the first."""
    spark = docs.sparkSession
    n = partitions(spark)
    at = [i / (4 * n) for i in range(1, 4 * n)]
    cuts = docs.agg(F.percentile_approx("doc_id", at, 100_000).alias("q")).first()["q"] or []
    cuts = np.array(sorted(set(cuts)), np.int64)
    table = spark.sparkContext.broadcast(cuts)  # 4 values a partition

    # a column with NULLs would reach Python as floats: ids come without them, beside a flag
    key = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)), F.col("doc_id").isNull()

    def bucket_of(ids: pd.Series, none: pd.Series) -> np.ndarray:
        b = np.searchsorted(table.value, ids.to_numpy(), side="right")
        return np.where(none, len(table.value) + 1, b)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series, none: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(ids, none)).astype("int32")

    firsts = docs.select("doc_id", bucket(*key).alias("b")).groupBy("b").agg(F.min("doc_id").alias("m")).orderBy("b").collect()
    before = {r["b"]: (firsts[i - 1]["b"], r["m"]) for i, r in enumerate(firsts)}  # one entry a bucket
    sent = spark.sparkContext.broadcast(before)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, none: pd.Series) -> pd.Series:
        """The row's bucket; for a bucket's first id also the bucket before."""
        out = []
        for i, gone, b in zip(ids, none, bucket_of(ids, none), strict=True):
            to, least = sent.value[int(b)]
            first = gone if least is None else not gone and i == least
            out.append([int(b), int(to)] if first else [int(b)])
        return pd.Series(out)

    dealt = (
        docs.select("*", places(*key).alias("__to"))
        .select("doc_id", "text", F.posexplode("__to").alias("tail", "bucket"))
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_last(), "text")
    )
    out_schema = spark.createDataFrame([], schema).schema

    def walk(batches: Iterator[pa.RecordBatch]):
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(out_schema)
        held, closed, out = None, None, []
        for batch in batches:
            for part in slices(batch):
                for i, text, tail, b in zip(*[part.column(c).to_pylist() for c in ("doc_id", "text", "tail", "bucket")], strict=True):
                    if tail and closed == b:
                        continue  # only the least row of the next bucket is needed
                    if held is not None:
                        out.append(each(held, (i, text)))
                    held = None if tail else (i, text)
                    closed = b if tail else closed
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), want, strict=True)], schema=want)
                    out = []

    return dealt.mapInArrow(walk, out_schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its text with the last half replaced by the
    beginning of the next document, and the likeness of its fingerprint to that and to the
    next document's: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    held: dict[str, Fingerprint] = {}

    def finger(text: str) -> Fingerprint:
        found = held.get(text)  # the next document's is asked for again
        if found is None:
            held.clear()
            found = held[text] = Fingerprint.of(text)
        return found

    def each(this: tuple, following: tuple) -> tuple:
        text, n = this[1], len(this[1])
        edited = text[:n - n // 2] + following[1][:n // 2]
        own, changed = finger(text), Fingerprint.of(edited)
        after = finger(following[1])
        return this[0], n, hashlib.sha256(edited.encode()).hexdigest(), str(own), str(changed), own.likeness(changed), own.likeness(after)

    base = id_and_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    return neighbours(base, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", each)
