"""A logistic scorer over hashed features: FTRL-proximal on a bounded sample, sparse weights.

Feature extraction and scoring run over whole texts in the tasks that hold them. Fitting
takes at most ``max_rows`` rows (the least by a hash of the id, so the choice is the same on
every run and spread over the corpus) and runs in one task; the weights that L1 leaves are
a few thousand (index, weight) pairs, at most ``2 ** bits``, and are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import save, slices

#: texts -> (row of each feature, hashed feature); features may repeat.
Features = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class Ftrl:
    """Per-coordinate FTRL-proximal for binary features and labels in [0, 1].

    Each coordinate's learning rate falls with its own gradients, alpha / (beta + sqrt(n));
    weights whose accumulated gradient stays within ``l1`` are exactly 0. The bias is a
    coordinate of its own without L1.
    """

    def __init__(self, bits: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 1e-3):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, features: np.ndarray, label: float) -> None:
        at = np.append(features, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(rows: DataFrame, features: Features, bits: int = 20, max_rows: int = 20_000, epochs: int = 4, min_docs: int = 5, **ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (indices, values, bias) from the sample ``rows`` (doc_id, text, label).

    Rows without a label are left out; of more than ``max_rows`` those of least id hash are taken. No
    rows: no weights. Equal hashes are ordered by a hash of the text. Coordinates met in fewer than
    ``min_docs`` of the rows are left out. Texts are cut into features where they are; the
    one task that learns gets the numbers of the common features alone, at most 2 ** bits a row.
    """
    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                row, f = features(part.column("text").to_pylist())
                f = (f >> np.uint64(64 - bits)).astype(np.int32)
                own = [np.unique(x) for x in np.split(f, np.searchsorted(row, np.arange(1, part.num_rows)))]
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("t"), part.column("label"), _lists(own)], names=["h", "t", "label", "f"])

    labelled = rows.where("label is not null").select(F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), F.col("label").cast("double").alias("label"), "text")
    sample = save(labelled.mapInArrow(cut, "h long, t long, label double, f array<int>"), "fit_rows")
    counts = sample.select(F.explode("f").alias("at")).groupBy("at").count().where(F.col("count") >= min_docs).select("at").toArrow()  # at most 2 ** bits
    mask = np.zeros(1 << bits, bool)
    mask[np.asarray(counts.column("at")).astype(np.int64)] = True
    common = rows.sparkSession.sparkContext.broadcast(np.packbits(mask))

    def keep_common(batches):
        known = np.unpackbits(common.value).astype(bool)
        for batch in batches:
            own = [np.asarray(x.values) for x in batch.column("f")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists([x[known[x]] for x in own])], names=batch.schema.names)

    def train(table: pa.Table) -> pa.Table:
        from tarmac.llm.hashed_linear import Ftrl

        # the order of arrival is not fixed: learn in the order of the hashes
        table = table.sort_by([("h", "ascending"), ("t", "ascending")])
        model = Ftrl(bits, **ftrl)
        docs, labels = [np.asarray(x.values) for x in table.column("f")], table.column("label").to_pylist()
        rng = np.random.default_rng(7)
        for _ in range(epochs):
            for i in rng.permutation(len(docs)):
                model.learn(docs[i], labels[i])
        at = np.flatnonzero(model.n)
        w = model.weights(at)
        return pa.table({"at": pa.array(at[w != 0], pa.int64()), "w": pa.array(w[w != 0], pa.float64())})

    kept = sample.mapInArrow(keep_common, sample.schema).orderBy("h", "t").limit(max_rows).withColumn("model", F.lit(0))
    got = kept.groupBy("model").applyInArrow(train, "at long, w double").collect()  # at most 2^bits + 1 pairs
    at, w = np.array([r["at"] for r in got], np.int64), np.array([r["w"] for r in got], np.float64)
    inner = at < 1 << bits
    return at[inner], w[inner], float(w[~inner].sum())


def _lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in rows])), pa.int32()), pa.array(np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)))


class Scorer:
    """Scores texts with sparse weights; repeated features of a text count once."""

    def __init__(self, weights: tuple[np.ndarray, np.ndarray, float], features: Features, bits: int = 20):
        at, w, self.bias = weights
        self.dense = np.zeros(1 << bits)
        self.dense[at] = w
        self.features, self.bits = features, bits

    def __call__(self, texts: list) -> np.ndarray:
        row, f = self.features(texts)
        f = (f >> np.uint64(64 - self.bits)).astype(np.int64)
        used = self.dense[f] != 0
        pairs = np.unique(row[used].astype(np.int64) << self.bits | f[used])
        total = np.bincount(pairs >> self.bits, self.dense[pairs & ((1 << self.bits) - 1)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -35, 35)))
