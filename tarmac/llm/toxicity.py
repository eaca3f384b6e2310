"""Toxicity scores: FTRL-proximal logistic regression over word n-grams and skip-grams.

Features are single words, neighbouring pairs and pairs with one word between, hashed into
``2 ** bits`` coordinates. The fit takes a bounded sample of the labelled rows
(``max_rows``); L1 leaves compact weights that are broadcast, and every whole text is scored
in the task that holds it.

Rules: words are folded and split as for decontamination. The score uses the text only. A
NULL or empty text has the bias as its score. Repeated rows are scored each. A NULL id or
label is never learnt from; a document with several labels takes the highest. Without
labelled rows every score is 0.5. Only the id, text and label columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import WordHashes, free_name, id_and_text, map_slices, mix, slices
from tarmac.llm.decontaminate import words_of
from tarmac.llm.hashed_linear import Scorer, fit

HELD_OUT = 2
THRESHOLD = 0.3
_HASHES = WordHashes()


def gram_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature) of words, neighbouring pairs and pairs with one word between."""
    lists = [words_of(t) for t in texts]
    lens = np.array([len(x) for x in lists], np.int64)
    row = np.repeat(np.arange(len(lists)), lens)
    h = _HASHES.of([w for x in lists for w in x])
    rows, out = [row], [mix(h)]
    for gap, salt in ((1, 0x5851F42D4C957F2D), (2, 0x14057B7EF767814F)):
        same = row[:-gap] == row[gap:]
        rows.append(row[:-gap][same])
        out.append(mix(h[:-gap][same] * np.uint64(salt) + h[gap:][same]))
    order = np.argsort(np.concatenate(rows), kind="stable")
    return np.concatenate(rows)[order], np.concatenate(out)[order]


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """Sparse weights learnt from the labelled rows that are not held out."""
    base = id_and_text(docs, id_col, text_col).where("doc_id is not null")
    marks = labels.groupBy(labels[id_col].alias("doc_id")).agg(F.max(labels[label_col]).alias("label"))
    marks = marks.where(~held_out(F.col("doc_id"))).where("label is not null")
    # Choose the sample among the labels first: only its texts are moved.
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return fit(base.join(F.broadcast(chosen), "doc_id"), gram_features, max_rows=max_rows)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    weights = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, max_rows, id_col, text_col, label_col))

    def task():
        scorer = Scorer(weights.value, gram_features)

        def each(part: pa.RecordBatch) -> dict:
            score = scorer(part.column("text").to_pylist())
            return {"doc_id": part.column("doc_id"), "held_out": part.column("held"), "score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))}

        return each

    base = id_and_text(docs, id_col, text_col).withColumn("held", held_out(F.col("doc_id")))
    return map_slices(base, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int", task)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, all columns unchanged."""
    weights = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, max_rows, id_col, text_col))
    text = free_name(docs, "__scored_text")
    base = docs.select(*[docs[c] for c in docs.columns], F.coalesce(docs[text_col], F.lit("")).alias(text))

    def run(batches):
        scorer = Scorer(weights.value, gram_features)
        for batch in batches:
            for part in slices(batch, text):
                keep = scorer(part.column(text).to_pylist()) < threshold
                yield pa.RecordBatch.from_arrays(part.columns[:-1], names=part.schema.names[:-1]).filter(pa.array(keep))

    return base.mapInArrow(run, docs.schema)
