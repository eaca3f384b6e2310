"""Shared pieces of the text operators: column selection, bounded batches, word ids."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tarmac
from tarmac.session import ensure_checkpoint_dir, scratch_path

#: Bytes of text handled at a time inside a task.
SLICE_BYTES = 1 << 20


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (NULL becomes empty); every other column is pruned, so
    the names of other columns never matter."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``max_bytes`` of text each (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = np.cumsum(sizes) // max_bytes
    start = 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1), len(sizes)]:
        if end > start:
            yield batch.slice(start, end - start)
            start = end


def map_slices(df: DataFrame, schema: str | list[str], task: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """Run ``task()`` once per Spark task; the function it returns turns each slice into
    a dict of output columns. Rows stay where they are: no shuffle."""
    fields = schema.split(", ") if isinstance(schema, str) else schema
    names = [f.split()[0] for f in fields]

    def run(batches):
        each = task()
        for batch in batches:
            for part in slices(batch):
                gc.disable()  # millions of small objects without cycles: collecting only costs time
                try:
                    out = each(part)
                finally:
                    gc.enable()
                yield pa.RecordBatch.from_arrays([out[n] if isinstance(out[n], pa.Array) else pa.array(out[n]) for n in names], names=names)

    spark_schema = df.sparkSession.createDataFrame([], ", ".join(fields)).schema
    return df.mapInArrow(_cast(run, spark_schema), spark_schema)


def _cast(run, spark_schema):
    """Arrow types as Spark expects them (plain string and binary, not the view or large kinds)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    want = to_arrow_schema(spark_schema)

    def wrapped(batches):
        for b in run(batches):
            yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(b.columns, want, strict=True)], schema=want)

    return wrapped


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prepare(spark: SparkSession) -> None:
    """Have a checkpoint folder, and this package on the executors: Spark ships it as a zip,
    so tasks can import it wherever the session was started."""
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if _SHIPPED.get("app") != sc.applicationId:
        root = Path(tarmac.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="tarmac-code-")) / "tarmac-code.zip"  # the driver's own; Spark serves it
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"tarmac/{f.relative_to(root)}")
        sc.addPyFile(str(target))
        _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, computed once per distinct word; cleared when it has
    ``limit`` entries (it is only a cache)."""

    limit = 1 << 18

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lower_words(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space (space and 0x09-0x0D), as UTF-8."""
    return text.encode().lower().split()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit value over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
