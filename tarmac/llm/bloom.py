"""Bloom filters of a fixed size, built in tasks and broadcast."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import mix

#: An array of 2 ** bits bits in 64-bit words.
Bloom = np.ndarray


def empty_bloom(bits: int = 23) -> Bloom:
    return np.zeros(1 << (bits - 6), np.uint64)


def _places(values: np.ndarray, words: int) -> list[np.ndarray]:
    m = mix(values)
    return [(m >> np.uint64(shift)) & np.uint64(64 * words - 1) for shift in (0, 32)]


def in_bloom(bloom: Bloom, values: np.ndarray) -> np.ndarray:
    """Whether each 64-bit value may have been added."""
    out = np.ones(len(values), bool)
    for at in _places(values, len(bloom)):
        out &= (bloom[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def make_bloom(values: DataFrame, column: str, bits: int = 23):
    """Broadcast Bloom filter of a long column: 2 ** bits bits, whatever the input."""

    def places(batches):
        for b in batches:
            at = np.concatenate(_places(np.asarray(b.column(0)).astype(np.int64).view(np.uint64), 1 << (bits - 6)))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            own, inverse = np.unique(word, return_inverse=True)
            mask = np.zeros(len(own), np.uint64)
            np.bitwise_or.at(mask, inverse, bit)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(mask.view(np.int64))], names=["w", "b"])

    words = values.select(column).mapInArrow(places, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bloom = empty_bloom(bits)  # at most 2 ** (bits - 6) words were collected
    if words.num_rows:
        bloom[np.asarray(words.column("w"))] = np.asarray(words.column("b")).astype(np.int64).view(np.uint64)
    return values.sparkSession.sparkContext.broadcast(bloom)


def sized_bloom(values: DataFrame, column: str, most_bits: int = 28):
    """``make_bloom`` with about 16 bits for each of the (saved) values, at most 2 ** ``most_bits``:
    beyond that more values pass by error, which every caller allows for."""
    return make_bloom(values, column, min(max(int(16 * values.count()).bit_length(), 16), most_bits))
