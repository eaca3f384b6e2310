"""Categorical encoding: frequency-rank index, lexicographic label codes, dictionary codes.

Label tables are computed by us in one aggregate over all columns, as
(column, value, cnt), and their *size is checked* before anything reaches the driver:

* small (<= ``max_driver_labels`` labels in total): the labels go into a built-in
  ``StringIndexerModel`` (a JVM lookup, inside whole-stage codegen's neighbourhood);
* large: codes are computed distributedly with ``cumulative_before``, checkpointed
  once, and looked up (``lookup``): columns whose dictionary is small by count and bytes
  by a broadcast join, all others together, stacked as narrow (row, column, value) rows,
  so the table itself is exchanged once however many columns are large. Values far more
  frequent than a partition's share (at most P / 4 a column) are broadcast too, so no
  join task gets a hot value.

Orders: ``frequencyDesc`` (most frequent = 0, ties by value ascending, as Spark's
StringIndexer does) and ``alphabetAsc`` (byte order of the value).
NULL handling: ``skip`` drops rows with a NULL or unseen value in any listed
column (before fitting too, so all columns are fitted on the same rows), ``keep``
gives them the index ``len(labels)``, ``error`` fails.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ordering import cumulative_before
from tarmac.session import scratch_path

FREQUENCY_DESC = "frequencyDesc"
ALPHABET_ASC = "alphabetAsc"
#: Bytes of all dictionaries together that one lookup may broadcast, and entries of one of them.
BROADCAST_BYTES = 64 << 20
BROADCAST_LABELS = 100_000


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def label_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, cnt) over non-NULL values; values compared as strings."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("p")
    return (
        df.select(pairs).select("p.column", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    )


def _order_exprs(order: str):
    if order == FREQUENCY_DESC:
        return [F.col("cnt").desc(), F.col("value").asc()]
    if order == ALPHABET_ASC:
        return [F.col("value").asc()]
    raise ValueError(f"unsupported order {order!r}")


@dataclass
class IndexModel:
    cols: list[str]
    order: str
    handle_invalid: str
    labels: dict[str, list[str]] | None = None      # small path
    codes: DataFrame | None = None                   # distributed path: (column, value, idx, cnt)
    out_type: str = "double"
    broadcast_labels: int = BROADCAST_LABELS         # larger dictionaries are joined, not broadcast

    @property
    def distributed(self) -> bool:
        return self.codes is not None

    def labels_frame(self, spark) -> DataFrame:
        """(column_name, label, idx) for every fitted label."""
        if self.codes is not None:
            return self.codes.select(F.col("column").alias("column_name"), F.col("value").alias("label"), "idx")
        rows = [(c, v, float(i)) for c in self.cols for i, v in enumerate(self.labels[c])]
        return spark.createDataFrame(rows, "column_name string, label string, idx double")

    def transform(self, df: DataFrame, suffix: str | None = None) -> DataFrame:
        """Replace each column by its index (same name unless ``suffix`` is given)."""
        if not self.cols:
            return df
        if self.handle_invalid == "skip":
            df = df.na.drop(how="any", subset=self.cols)
        if self.distributed:
            return self._transform_join(df, suffix)
        tmp = [f"__idx_{i}" for i in range(len(self.cols))]
        out = df.select(*[F.col(c).cast("string").alias(c) if c in self.cols else F.col(c) for c in df.columns])
        # One single-column model per column: the multi-column constructor pads shorter
        # label arrays with NULLs, which shifts the 'keep' index and breaks the metadata.
        for c, t in zip(self.cols, tmp):
            out = StringIndexerModel.from_labels(
                self.labels[c], inputCol=c, outputCol=t, handleInvalid=self.handle_invalid
            ).transform(out)
        proj = []
        for c in df.columns:
            if c in self.cols:
                t = tmp[self.cols.index(c)]
                if suffix:
                    proj += [F.col(c), F.col(t).cast(self.out_type).alias(c + suffix)]
                else:
                    proj.append(F.col(t).cast(self.out_type).alias(c))
            else:
                proj.append(F.col(c))
        return out.select(*proj)

    def _transform_join(self, df: DataFrame, suffix: str | None) -> DataFrame:
        """Codes looked up in the distributed dictionary (see ``lookup``)."""
        entries = self.codes.select("column", F.col("value").alias("key"), F.col("idx").alias("result"), "cnt")
        names = {c: free_name(df, f"__i_{c}") for c in self.cols}
        sizes = dictionary_sizes(entries)
        out = lookup(df, {c: F.col(c).cast("string") for c in self.cols}, entries, names, self.broadcast_labels, sizes)
        if self.handle_invalid == "skip":
            out = out.na.drop(how="any", subset=list(names.values()))
        proj = []
        for c in df.columns:
            if c in self.cols:
                code = F.col(names[c])
                if self.handle_invalid == "keep":
                    code = F.coalesce(code, F.lit(float(sizes[c].labels if c in sizes else 0)))
                elif self.handle_invalid == "error":
                    code = F.when(code.isNull(), F.raise_error(F.lit(f"unseen or NULL label in {c}"))).otherwise(code)
                code = code.cast(self.out_type)
                proj += [F.col(c), code.alias(c + suffix)] if suffix else [code.alias(c)]
            else:
                proj.append(F.col(c))
        return out.select(*proj)


class DictionarySize(NamedTuple):
    labels: int
    rows: int
    size: int     # bytes of the keys and the results


def dictionary_sizes(entries: DataFrame) -> dict[str, DictionarySize]:
    """Labels, rows and bytes of each column's dictionary: one row per column."""
    width = F.octet_length(F.col("key").cast("string")) + F.octet_length(F.col("result").cast("string"))
    sizes = entries.groupBy("column").agg(F.count(F.lit(1)).alias("labels"), F.sum("cnt").alias("n"),
                                          F.sum(width).alias("size"))
    return {r["column"]: DictionarySize(int(r["labels"]), int(r["n"] or 0), int(r["size"] or 0)) for r in sizes.collect()}


def lookup(df: DataFrame, keys: dict[str, Column], entries: DataFrame, names: dict[str, str],
           broadcast_labels: int, sizes: dict[str, DictionarySize]) -> DataFrame:
    """Add ``names[c]``: the result that ``entries`` (column, key, result, cnt) has for ``keys[c]``, else NULL.

    Dictionaries of at most ``broadcast_labels`` entries and ``BROADCAST_BYTES`` are broadcast.
    The other columns are looked up together. The rows are written once, numbered; the wanted
    keys are stacked as (row, column, key), meet the dictionary in one join, come back as
    one row of results per row number, and join the table on it. Frequent keys (at most
    P / 4 a column can hold 4 / P of the rows, P = shuffle partitions) take their result from a broadcast
    instead of that join, and NULLs are not stacked, so no key is hot. On a stream, which cannot
    be regrouped, each large column is a join of its own with salted keys.
    """
    if not keys:
        return df
    spark = df.sparkSession
    left, small, large = BROADCAST_BYTES, [], []
    for c in sorted(keys, key=lambda c: sizes[c].size if c in sizes else 0):
        if c not in sizes or (sizes[c].labels <= broadcast_labels and sizes[c].size <= left):
            left -= sizes[c].size if c in sizes else 0
            small.append(c)
        else:
            large.append(c)
    out = df
    for c in small:
        key, found = free_name(out, "__key"), free_name(out, "__found")
        own = entries.where(F.col("column") == c).select(F.col("key").alias(key), F.col("result").alias(found))
        out = out.join(F.broadcast(own), keys[c] == F.col(key), "left").withColumn(names[c], F.col(found)).drop(key, found)
    if not large:
        return out
    if df.isStreaming:
        for c in large:
            out = _salted_lookup(out, c, keys[c], entries, names[c], sizes[c])
        return out

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    row = free_name(out, "__row")
    wanted = {c: free_name(out, f"__w_{c}") for c in large}
    path = scratch_path(spark, "lookup")
    out.select("*", F.monotonically_increasing_id().alias(row), *[keys[c].alias(w) for c, w in wanted.items()]).write.parquet(path)
    table = spark.read.parquet(path)
    number = {c: i for i, c in enumerate(large)}
    pairs = F.array(*[F.struct(F.lit(i).alias("col"), F.col(wanted[c]).alias("key")) for c, i in number.items()])
    stacked = table.select(F.col(row).alias("row"), F.explode(pairs).alias("p")).select("row", "p.col", "p.key").where("key is not null")
    col = F.when(F.col("column") == large[0], 0)
    cut = F.when(F.col("column") == large[0], 4 * sizes[large[0]].rows / parts)
    for c, i in list(number.items())[1:]:
        col, cut = col.when(F.col("column") == c, i), cut.when(F.col("column") == c, 4 * sizes[c].rows / parts)
    own = entries.where(F.col("column").isin(large)).select(col.alias("col"), "key", "result", (F.col("cnt") >= F.greatest(cut, F.lit(2))).alias("hot"))
    hot = F.broadcast(own.where("hot").drop("hot"))          # at most P / 4 rows a column
    rest = stacked.join(hot.select("col", "key"), ["col", "key"], "left_anti").join(own.where("not hot").drop("hot"), ["col", "key"])
    found = stacked.join(hot, ["col", "key"]).select("row", "col", "result").unionByName(rest.select("row", "col", "result"))
    found = found.groupBy(F.col("row").alias(row)).agg(*[F.max(F.when(F.col("col") == i, F.col("result"))).alias(names[c]) for c, i in number.items()])
    return table.drop(*wanted.values()).join(found, row, "left").drop(row)


def _salted_lookup(df: DataFrame, c: str, key: Column, entries: DataFrame, name: str, size: DictionarySize) -> DataFrame:
    """One column's results by a join on (key, salt). Frequent keys (at most P / 4) and NULLs get a salt
    in [0, P) from a hash of the row, all others salt 0; the dictionary repeats a frequent
    entry once per salt. The hash is the same when a task is run again."""
    salts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    own = entries.where(F.col("column") == c)
    is_hot = F.col("cnt") >= max(4 * size.rows / salts, 2.0)
    hot = [r["key"] for r in own.where(is_hot).select("key").collect()]
    k, v, s, t = (free_name(df, n) for n in ("__key", "__value", "__salt", "__entry_salt"))
    spread = key.isNull() | (key.isin(hot) if hot else F.lit(False))
    side = own.select(F.col("key").alias(v), F.col("result").alias(name), F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias(t))
    out = df.withColumn(k, key).withColumn(s, F.when(spread, F.pmod(F.xxhash64(*[df[x] for x in df.columns]), F.lit(salts))).otherwise(0).cast("int"))
    return out.join(side, (F.col(k) == F.col(v)) & (F.col(s) == F.col(t)), "left").drop(k, v, s, t)


def fit_index(
    df: DataFrame,
    cols: list[str],
    order: str = FREQUENCY_DESC,
    handle_invalid: str = "skip",
    max_driver_labels: int = 100_000,
    method: str = "auto",
    out_type: str = "double",
    broadcast_labels: int = BROADCAST_LABELS,
) -> IndexModel:
    """Fit a multi-column index in one aggregate (see module docstring)."""
    if method not in ("auto", "driver", "distributed"):
        raise ValueError("method must be auto, driver or distributed")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    if not cols:
        return IndexModel([], order, handle_invalid, labels={}, out_type=out_type)
    src = df.na.drop(how="any", subset=cols) if handle_invalid == "skip" else df
    counts = label_counts(src, cols)
    if method != "distributed":
        # one scan; the limit bounds what reaches the driver before its size is known
        rows = counts.limit(max_driver_labels + 1).collect()
        if len(rows) <= max_driver_labels:
            if order == FREQUENCY_DESC:
                rows.sort(key=lambda r: (r["column"], -r["cnt"], r["value"].encode("utf-8")))
            else:
                rows.sort(key=lambda r: (r["column"], r["value"].encode("utf-8")))
            labels = {c: [] for c in cols}
            for r in rows:
                labels[r["column"]].append(r["value"])
            return IndexModel(cols, order, handle_invalid, labels=labels, out_type=out_type)
        if method == "driver":
            raise ValueError(f"more than max_driver_labels={max_driver_labels} labels")
    codes = cumulative_before(counts, _order_exprs(order), group="column", out="idx").select(
        "column", "value", F.col("idx").cast("double").alias("idx"), "cnt"
    ).checkpoint(eager=True)   # the dictionary is reused per column: compute it once
    return IndexModel(cols, order, handle_invalid, codes=codes, out_type=out_type, broadcast_labels=broadcast_labels)


def string_index(df: DataFrame, cols: list[str], handle_invalid: str = "skip", **kw) -> tuple[DataFrame, IndexModel]:
    """Frequency-rank index (0 = most frequent) replacing each column under its name."""
    model = fit_index(df, cols, FREQUENCY_DESC, handle_invalid, **kw)
    return model.transform(df), model


def label_encode(df: DataFrame, cols: list[str], **kw) -> tuple[DataFrame, IndexModel]:
    """Lexicographic integer codes; NULL is first turned into the label 'nan'."""
    src = df.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])
    model = fit_index(src, cols, ALPHABET_ASC, "keep", out_type="int", **kw)
    return model.transform(src), model


def dictionary_encode(df: DataFrame, cols: list[str], method: str = "auto", **kw) -> tuple[DataFrame, IndexModel]:
    """Sorted-dictionary integer codes; a missing column is a ``ValueError``.

    ``method='distributed'`` never brings the dictionary to the driver.
    """
    model = fit_index(df, cols, ALPHABET_ASC, "keep", method=method, out_type="int", **kw)
    return model.transform(df), model


def categorize(df: DataFrame, cols: list[str]) -> tuple[DataFrame, IndexModel]:
    """Dictionary-typed columns: ``{c}_code`` beside the original column."""
    model = fit_index(df, cols, ALPHABET_ASC, "keep")
    return model.transform(df, suffix="_code"), model


def decode(df: DataFrame, model: IndexModel, cols: list[str] | None = None, suffix: str = "_code") -> DataFrame:
    """Back from codes to labels with ``IndexToString`` (small label sets) or a join; the code
    of NULL and unseen values becomes NULL."""
    cols = cols or model.cols
    if model.distributed:
        entries = model.codes.select("column", F.col("idx").alias("key"), F.col("value").alias("result"), "cnt")
        keys = {c: F.col(c + suffix).cast("double") for c in cols}
        return lookup(df, keys, entries, {c: f"{c}_decoded" for c in cols}, model.broadcast_labels, dictionary_sizes(entries))
    out = df
    for c in cols:
        # the code after the last label stands for NULL and unseen values
        labels, code, known = model.labels[c], F.col(c + suffix).cast("double"), f"__known_{c}"
        out = out.withColumn(c + suffix, code).withColumn(known, F.coalesce(code, F.lit(float(len(labels)))))
        out = IndexToString(inputCol=known, outputCol=f"{c}_decoded", labels=[*labels, ""]).transform(out)
        out = out.withColumn(f"{c}_decoded", F.when(F.col(known) < len(labels), F.col(f"{c}_decoded"))).drop(known)
    return out
