"""A training-corpus pipeline: five stages over ``documents``, each written as Parquet and
read again as the next one's input.

1. toxicity: documents that the classifier rejects go.
2. line dedup: later copies of repeated line runs are cut from the texts (rows stay).
3. n-gram Jaccard join: of each group of near duplicates the document of least id stays.
4. benchmark decontamination: contaminated documents go.
5. BPE encoding and decoding: the final digest of every remaining document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.bpe_chunks import encode_decode
from tarmac.llm.common import prepare, save
from tarmac.llm.decontaminate import contamination
from tarmac.llm.line_dedup import without_repeated_lines
from tarmac.llm.ngram_join import one_of_each
from tarmac.llm.queries import table, tokenizer_path
from tarmac.llm.toxicity import without_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars, where the column exists, follows the new text."""
    prepare(spark)
    out = without_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(F.char_length("text"), F.lit(0))).cast(kind))
    return out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return encode_decode(docs, tokenizer_path("word_bpe_49k.json"), texts=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("bpe", bpe_stage),
]

#: SQL cannot express the toxicity stage; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
