"""Deterministic hash buckets over key columns.

A row's bucket depends only on its key values, never on partitioning or task order, so
train/test splits and folds are reproducible across cluster layouts (``randomSplit``
is not: the same seed gives different rows for 1, 4 or 8 input partitions).

The default hash is 8 hex digits of ``md5(concat_ws('|', keys...))`` read as an
integer. ``window`` picks which 8-digit slice is used, so the split (window 0) and the
folds (window 1) are independent of each other. The same expression is plain SQL in
other engines, which gives the split an exact oracle. ``method='xxhash64'`` is the
fast alternative (Spark's built-in 64-bit hash, several times cheaper per row than md5
plus hex parsing) when reproducing the split outside Spark does not matter; its
windows are different seeds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(keys: list[str] | tuple[str, ...], window: int = 0, method: str = "md5") -> Column:
    """Integer in [0, 2^32) from the md5 of the key columns joined by '|'
    (or, with ``method='xxhash64'``, from Spark's xxhash64 of the keys)."""
    if not keys:
        raise ValueError("at least one key column is required")
    if method == "xxhash64":
        h = F.xxhash64(F.lit(window), *[F.col(k) for k in keys])
        return F.pmod(h, F.lit(1 << 32))
    if method != "md5":
        raise ValueError("method must be 'md5' or 'xxhash64'")
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    start = 1 + 8 * window
    if start + 8 > 33:
        raise ValueError("window must be in 0..3")
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def key_bucket(keys: list[str] | tuple[str, ...], modulus: int, window: int = 0,
               method: str = "md5") -> Column:
    """``key_hash(keys, window) % modulus`` as an int."""
    return (key_hash(keys, window, method) % F.lit(modulus)).cast("int")
