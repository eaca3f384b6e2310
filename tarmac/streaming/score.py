"""Score a file stream with a fitted model.

Scoring is stateless (one row in, one row out), so it needs no watermark or state
store. The sink is a Parquet file sink whose checkpoint belongs to it (``<sink>/_checkpoint``
unless given), so a second run goes on where the first ended, after a failure too;
``availableNow`` processes what is in the source directory and stops. A sink with files but
without its checkpoint is refused: the file sink would take new batches for old ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarmac.session import scratch_path


def file_stream_path(path: str) -> str:
    """A file source needs a directory or a glob; turn one file into a glob matching
    exactly that file (its last character becomes a one-letter class)."""
    if path.endswith("/") or not path:
        return path
    return path[:-1] + f"[{path[-1]}]"


def _has_files(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def scoring_stream(spark: SparkSession, model, source_dir: str, schema: T.StructType,
                   feature_cols: list[str] | None = None, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None,
                   prepare: Callable[[DataFrame], DataFrame] | None = None,
                   handle_invalid: str = "error") -> DataFrame:
    """The streaming DataFrame: read with the batch schema, prepare (the same fitted
    cleaning/encoding as in batch), assemble, predict. ``model`` is a regressor, or a whole
    fitted pipeline (then its own cleaning, encoding and scaling apply, and ``feature_cols``
    is not used). NULL features are treated as in batch: they fail unless
    ``handle_invalid`` says ``keep`` or ``skip``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    if prepare is not None:
        stream = prepare(stream)
    if hasattr(model, "prepare"):
        return model.transform(stream).drop("features", "scaled")
    assembled = VectorAssembler(inputCols=feature_cols, outputCol=model.getFeaturesCol(),
                                handleInvalid=handle_invalid).transform(stream)
    return model.transform(assembled).drop(model.getFeaturesCol())


def stream_score(spark: SparkSession, model, source_dir: str, schema: T.StructType,
                 feature_cols: list[str] | None = None, sink_dir: str | None = None,
                 timeout_s: int | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 checkpoint_dir: str | None = None, handle_invalid: str = "error") -> DataFrame:
    """Run the scoring stream over everything available and return the sink as a table.

    Call it again with the same ``sink_dir`` to score what has arrived since. There is no
    time limit unless ``timeout_s`` is given.
    """
    sink_dir = sink_dir or scratch_path(spark, "stream-sink")
    ckpt = checkpoint_dir or f"{sink_dir.rstrip('/')}/_checkpoint"
    if _has_files(spark, sink_dir) and not _has_files(spark, ckpt):
        raise ValueError(f"{sink_dir} has files but {ckpt} has no checkpoint of theirs")
    query = (scoring_stream(spark, model, source_dir, schema, feature_cols, prepare=prepare,
                            handle_invalid=handle_invalid)
             .writeStream.format("parquet")
             .option("path", sink_dir)
             .option("checkpointLocation", ckpt)
             .trigger(availableNow=True)
             .outputMode("append")
             .start())
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError("scoring stream did not finish")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(sink_dir)
