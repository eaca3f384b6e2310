"""Readers: CSV with an explicit schema, Parquet, a directory of CSVs with differing
headers, and convert-once CSV -> Parquet."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.nulls import nan_to_null
from tarmac.session import scratch_path

# The flight table's columns and types (29 columns, all nullable).
FLIGHT_INT = ["Year", "Month", "DayofMonth", "DayOfWeek", "FlightNum", "Cancelled", "Diverted"]
FLIGHT_DOUBLE = [
    "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime", "ActualElapsedTime", "CRSElapsedTime",
    "AirTime", "ArrDelay", "DepDelay", "Distance", "TaxiIn", "TaxiOut", "CarrierDelay",
    "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]
FLIGHT_STRING = ["UniqueCarrier", "TailNum", "Origin", "Dest", "CancellationCode"]
# columns that identify one flight: the hash key for split and folds
FLIGHT_KEYS = ["Year", "Month", "DayofMonth", "UniqueCarrier", "FlightNum", "Origin"]


def flight_schema() -> T.StructType:
    fields = [T.StructField(c, T.IntegerType(), True) for c in FLIGHT_INT]
    fields += [T.StructField(c, T.DoubleType(), True) for c in FLIGHT_DOUBLE]
    fields += [T.StructField(c, T.StringType(), True) for c in FLIGHT_STRING]
    return T.StructType(fields)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    null_value: str = "NA",
    infer: bool = False,
    overrides: dict[str, T.DataType] | None = None,
    max_partition_bytes: int | None = None,
) -> DataFrame:
    """CSV with a header row.

    An explicit ``schema`` is the normal path (no inference pass over the data).
    ``infer=True`` runs Spark's inference pass; ``overrides`` then replace the inferred
    type of chosen columns *in the read schema* (so '007' read as text stays '007').
    ``null_value`` ('NA' in the flight files)
    becomes NULL; without it such a column would be read as text.
    ``max_partition_bytes`` sets the split size (block size) of the scan.
    """
    if max_partition_bytes:  # in a session of its own: the caller's scans keep their split size
        spark = _session_like(spark)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(max_partition_bytes)))
    reader = spark.read.option("header", True).option("nullValue", null_value)
    reader = reader.option("mode", "PERMISSIVE")
    if schema is None and infer:
        inferred = reader.option("inferSchema", True).csv(path).schema
        if overrides:
            inferred = T.StructType([
                T.StructField(f.name, overrides.get(f.name, f.dataType), True) for f in inferred.fields
            ])
        schema = inferred
    if schema is not None:
        # a header that names other columns, or in another order, fails instead of swapping values
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    if overrides and not infer:
        df = df.select(*[
            df[c].cast(overrides[c]).alias(c) if c in overrides else df[c] for c in df.columns
        ])
    return nan_to_null(df)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def list_files(spark: SparkSession, directory: str, suffix: str = ".csv",
               recursive: bool = False) -> list[str]:
    """Files inside ``directory`` (and below, if ``recursive``) ending with ``suffix``."""
    fs, p, _ = _hadoop_fs(spark, directory)
    out = []
    it = fs.listFiles(p, recursive)
    while it.hasNext():
        path = it.next().getPath()
        if path.getName().endswith(suffix):
            out.append(path.toString())
    return sorted(out)


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """First line of a text file, split on commas (only one line is read)."""
    fs, p, jvm = _hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return _header_columns(line)


def _header_columns(line: str) -> tuple[str, ...]:
    return tuple(h.strip().strip('"') for h in line.lstrip("\ufeff").rstrip("\r\n").split(","))


def read_headers(spark: SparkSession, paths: list[str], threads: int = 32) -> list[tuple[str, ...]]:
    """Header line of every file, in ``paths`` order.

    Only metadata reaches the driver: one line per file. On object stores each open
    is a round trip, so the opens run ``threads`` at a time rather than one after
    another.
    """
    if len(paths) <= 1:
        return [read_header(spark, f) for f in paths]
    with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
        return list(pool.map(lambda f: read_header(spark, f), paths))


def header_lines(spark: SparkSession, directory: str, suffix: str = ".csv", recursive: bool = False) -> DataFrame:
    """(path, header): the first line of every file under ``directory`` whose name ends in ``suffix``.

    Each file is one partition of a text scan, and its task stops after the first line, so the
    files are opened by the tasks and not read through. Spark lists many sub-folders in a job. Files without a line
    have no row.
    """
    own = _session_like(spark)      # the split size below holds for this scan only
    one_file = str(1 << 60)
    own.conf.set("spark.sql.files.maxPartitionBytes", one_file)
    own.conf.set("spark.sql.files.openCostInBytes", one_file)
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(directory)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
    if not recursive:
        fs, p, _ = _hadoop_fs(spark, directory)
        root = fs.makeQualified(p).toUri().getPath().rstrip("/")
        inner = F.regexp_replace("path", "^[^:/]+:(//[^/]*)?", "")
        lines = lines.where(F.size(F.split(inner, "/")) == root.count("/") + 2)

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    return lines.mapInArrow(first, "path string, header string")


def _session_like(spark: SparkSession) -> SparkSession:
    """A session of its own with the same SQL settings, to change some of them for one scan."""
    own = spark.newSession()
    for k, v in dict(spark.conf.getAll).items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def read_csv_directory(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | None = None,
    suffix: str = ".csv",
    null_value: str = "NA",
    recursive: bool = False,
) -> DataFrame:
    """All files ending in ``suffix`` in one table; columns matched *by name*.

    Spark matches CSV columns by position across the files of one read, so files
    are grouped by header: one scan per distinct header, then ``unionByName`` with
    missing columns as NULL. Tasks read the header lines (``header_lines``, written once), the
    distinct ones reach the driver. Each header's scan is one of the whole folder, cut to its files by
    their paths before it starts; with a single header, which is usual, not even the paths are needed.
    """
    headers = scratch_path(spark, "headers")
    header_lines(spark, directory, suffix, recursive).write.parquet(headers)
    found = spark.read.schema("path string, header string").parquet(headers)
    # one row per distinct header, in the order of their first files
    kinds = found.groupBy("header").agg(F.min("path").alias("first")).orderBy("first").collect()
    if not kinds:
        raise FileNotFoundError(f"no '{suffix}' files with a header in {directory}")
    whole = recursive and len(kinds) == 1
    frames = []
    for kind in kinds:
        header = _header_columns(kind["header"])
        if schema is not None:
            by_name = {f.name: f for f in schema.fields}
            part_schema = T.StructType([
                by_name.get(h, T.StructField(h, T.StringType(), True)) for h in header
            ])
        else:
            part_schema = T.StructType([T.StructField(h, T.StringType(), True) for h in header])
        part = spark.read.option("header", True).option("nullValue", null_value).option("mode", "PERMISSIVE") \
            .option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").schema(part_schema).csv(directory)
        if not whole:  # the planner of a scan needs its files; a filter on the path picks them from the listing
            paths = [r["path"] for r in found.where(F.col("header") == kind["header"]).select("path").toLocalIterator()]
            part = part.where(F.col("_metadata.file_path").isin(paths))
        frames.append(nan_to_null(part))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if schema is not None:
        names = [f.name for f in schema.fields if f.name in out.columns]
        extra = [c for c in out.columns if c not in names]
        out = out.select(*names, *extra)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def source_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of the files that ``path`` (a file, a directory or a pattern) names."""
    fs, p, _ = _hadoop_fs(spark, path)
    out = []
    for st in fs.globStatus(p) or []:
        for f in fs.listStatus(st.getPath()) if st.isDirectory() else [st]:
            if not f.isDirectory() and not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(out)


def _manifest(spark: SparkSession, target: str) -> list[dict]:
    """The finished batches of a conversion, in order."""
    folder = f"{target}/_manifest"
    if not path_exists(spark, folder):
        return []
    fs, p, jvm = _hadoop_fs(spark, folder)
    names = sorted(st.getPath().getName() for st in fs.listStatus(p))
    out = []
    for name in names:
        if name.endswith(".json") and name[0] not in "._":
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))
            try:
                out.append(json.loads(bytes(stream.readAllBytes())))
            finally:
                stream.close()
    return out


def _commit(spark: SparkSession, target: str, number: int, entry: dict) -> None:
    """Record a finished batch: written aside, then put in place by one rename."""
    fs, _, jvm = _hadoop_fs(spark, target)
    name = f"{target}/_manifest/{number:06d}.json"
    aside, final = jvm.org.apache.hadoop.fs.Path(f"{target}/_manifest/_{number:06d}"), jvm.org.apache.hadoop.fs.Path(name)
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(entry).encode()))
    finally:
        stream.close()
    if not fs.rename(aside, final):
        raise RuntimeError(f"{name} was written by another conversion")


def convert_once(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType | None = None,
    null_value: str = "NA",
) -> DataFrame:
    """CSV -> Parquet, every source file once; returns the Parquet.

    The target holds a folder per conversion and a manifest of the finished ones with their source
    files (path, bytes, time). Source files that no finished conversion lists are converted and
    added, so a conversion that failed is done again and files that arrive later are appended; listed files are not read
    again, also if they have changed or gone. Without ``schema`` the first conversion's inferred
    one holds for all. A finished Parquet folder of another writer is taken as it is.
    """
    done = _manifest(spark, parquet_path)
    if not done and path_exists(spark, f"{parquet_path}/_SUCCESS"):
        return spark.read.parquet(parquet_path)
    listed = {f[0] for entry in done for f in entry["files"]}
    new = [f for f in source_files(spark, csv_path) if f[0] not in listed]
    if not new and not done:
        raise FileNotFoundError(f"no files at {csv_path}")
    if schema is None and done:
        schema = T.StructType.fromJson(json.loads(done[0]["schema"]))
    if new:
        number = len(done)
        df = read_csv(spark, [f[0] for f in new], schema=schema, null_value=null_value, infer=schema is None)
        batch = f"batch-{number:06d}"
        df.write.mode("overwrite").parquet(f"{parquet_path}/{batch}")  # over what a failed run may have left
        entry = {"batch": batch, "files": new, "schema": df.schema.json()}
        _commit(spark, parquet_path, number, entry)
        done.append(entry)
    return spark.read.schema(T.StructType.fromJson(json.loads(done[0]["schema"]))).parquet(*[f"{parquet_path}/{e['batch']}" for e in done])
