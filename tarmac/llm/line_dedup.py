"""Removal of repeated runs of lines, by prefix doubling over line ids.

A document is the sequence of its non-blank lines, each a 128-bit id. A run of lines that also
starts earlier (smaller document, or the same document further up) is a later copy. Every maximal
one of ``min_words`` words or more is deleted to its end; overlapping copies unite.

Runs are found by windows. The windows of a place are the runs from there that hold ``min_words``
words, and whose lines after the first hold fewer. These are enough: if a run goes on further,
the next place starts a window in it, and where no window follows, the rest of the run is that
short. Equal windows have the same longer windows, so copies meet at each length.

Suffixes of the line sequences are named by distributed prefix doubling: the name of the first
2^(k+1) lines at a place is made from the names of 2^k lines there and 2^k lines further on,
one join a level. Suffixes with the same first L lines (an interval of longest common prefix
L or more of the suffix array) have the same names of 2^k <= L lines at both ends of the L
lines, so an interval is a group by two names; its first member stays. Only lines that occur
twice take part, as no other line can be in a repeated window, and levels are made as far as
the longest window needs.

Rules: lines end at "\\n"; a line of white space only is blank, is in no window and is deleted
only between two deleted lines of one run. A line's words are its spaces plus one, or a word for
each ``WORD_BYTES`` bytes (UTF-8) where that is more, as in text without spaces. A text with fewer than
``min_words`` words after a place has no window there. Very long texts: a task handles a slice's texts,
one document at a time, and their lines are rows. No rows, no copies: an empty table gives an empty one. NULL is the empty text. Documents are
ordered by id, those without one last; rows of equal id by a hash of the text; rows of equal id
and text are the same document and get equal results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import free_name, map_slices, save, slices

MIN_WORDS = 10
WORD_BYTES = 20


def line_rows(text: str, min_words: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The non-blank lines, and how many lines the window and the longest window from each take (0: none)."""
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    total = np.cumsum([0, *[max(x.count(b" ") + 1, len(x) // WORD_BYTES) for x in lines]])
    end = np.searchsorted(total, total[:-1] + min_words)
    last = np.maximum(end, np.searchsorted(total, total[1:] + min_words) - 1)
    return lines, *(np.where(end < len(total), x - np.arange(len(lines)), 0) for x in (end, last))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(text.alias("text"), F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(text).alias("t"))


def later_copies(docs: DataFrame, min_words: int) -> DataFrame:
    """(d, t, cuts): for each document (d, t, text) the windows (first line, lines) that are later copies, which make up the maximal runs."""
    place = ["d", "t", "i", "size", "last"]

    def run(batches):
        import xxhash

        for batch in batches:
            for part in slices(batch):
                d, t = (np.asarray(part.column(c)).astype(np.int64) for c in ("d", "t"))
                doc, at, size, last, ids = [], [], [], [], []
                for r, text in enumerate(part.column("text").to_pylist()):
                    lines, windows, longer = line_rows(text, min_words)
                    doc.append(np.full(len(lines), r))
                    at.append(np.arange(len(lines)))
                    size.append(windows)
                    last.append(longer)
                    ids += [xxhash.xxh3_128_digest(x) for x in lines]
                if not ids:
                    continue
                doc, h = np.concatenate(doc), np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
                cols = (d[doc], t[doc], np.concatenate(at), np.concatenate(size), np.concatenate(last), h[:, 0], h[:, 1])
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).astype(np.int64)) for c in cols], names=[*place, "p", "q"])

    lines = save(docs.mapInArrow(run, ", ".join(f"{c} long" for c in [*place, "p", "q"])), "lines")
    once = lines.groupBy("p", "q").agg(F.count("*").alias("c")).where("c > 1").select("p", "q")
    names = save(lines.join(once, ["p", "q"], "left_semi").dropDuplicates(["d", "t", "i"]), "names")
    longest = names.agg(F.max("last").alias("m")).first()["m"] or 0

    found, level = [], 0
    while (1 << level) <= longest:
        reach = 1 << level  # names stand for this many lines
        own = names.where("size > 0").withColumn("size", F.explode(F.sequence("size", "last")))
        own = own.where((F.col("size") >= reach) & (F.col("size") < 2 * reach))
        if level:
            far = names.select("d", "t", F.col("i").alias("j"), F.col("p").alias("p2"), F.col("q").alias("q2"))
            own = own.withColumn("j", F.col("i") + F.col("size") - reach).join(far, ["d", "t", "j"])
        else:
            own = own.withColumn("p2", F.col("p")).withColumn("q2", F.col("q"))
        found.append(own.select("d", "t", "i", "size", "p", "q", "p2", "q2"))
        level += 1
        if (1 << level) <= longest:  # double: names of 2^k lines here and 2^k lines on
            far = names.select("d", "t", (F.col("i") - reach).alias("i"), F.col("p").alias("p2"), F.col("q").alias("q2"))
            pair = names.join(far, ["d", "t", "i"])
            new = [F.xxhash64(F.lit(s), "p", "q", "p2", "q2").alias(c) for s, c in ((1, "p"), (2, "q"))]
            names = save(pair.select(*place, *new), "names")
    if not found:
        return lines.sparkSession.createDataFrame([], "d long, t long, cuts array<struct<i:bigint,size:bigint>>")
    windows = found[0]
    for f in found[1:]:
        windows = windows.union(f)
    interval = ["size", "p", "q", "p2", "q2"]
    firsts = windows.groupBy(*interval).agg(F.min(F.struct("d", "t", "i")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(firsts, interval).where(F.struct("d", "t", "i") != F.col("first"))
    return later.groupBy("d", "t").agg(F.array_sort(F.collect_list(F.struct("i", "size"))).alias("cuts"))


def cut_lines(text: str, cuts) -> tuple[str, int, int, int, int]:
    """(text without the later copies, non-blank lines, deleted, runs, longest run). A blank
    line between two deleted lines of a run goes with them."""
    lines = text.split("\n")
    solid = [k for k, x in enumerate(lines) if x.encode().strip()]
    gone = np.zeros(len(solid) + 1, np.int64)
    for c in cuts or ():
        gone[c["i"]] += 1
        gone[c["i"] + c["size"]] -= 1
    flags = np.cumsum(gone[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).reshape(-1, 2)
    if not len(edges):
        return text, len(solid), 0, 0, 0
    drop = np.zeros(len(lines), bool)
    for a, b in edges:
        drop[solid[a]:solid[b - 1] + 1] = True
    kept = "\n".join(x for x, d in zip(lines, drop, strict=True) if not d)
    sizes = edges[:, 1] - edges[:, 0]
    return kept, len(solid), int(sizes.sum()), len(edges), int(sizes.max())


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_deleted, n_runs, longest_run, kept_sha256[, kept]) for every row."""
    base = keyed(docs.select(docs[id_col], docs[text_col]), id_col, text_col)
    cuts = later_copies(base, min_words)
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    joined = rows.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))).withColumn("t", F.xxhash64("text")).join(cuts, ["d", "t"], "left")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def task():
        def each(part: pa.RecordBatch) -> dict:
            got = [cut_lines(t, c) for t, c in zip(part.column("text").to_pylist(), part.column("cuts").to_pylist(), strict=True)]
            out = {"doc_id": part.column("doc_id")}
            out |= {c: pa.array([g[k] for g in got], pa.int64()) for k, c in enumerate(("n_lines", "n_deleted", "n_runs", "longest_run"), 1)}
            out["kept_sha256"] = pa.array([hashlib.sha256(g[0].encode()).hexdigest() for g in got], pa.string())
            return out | {"kept": pa.array([g[0] for g in got], pa.string())} if texts else out

        return each

    schema = f"doc_id {kind}, n_lines bigint, n_deleted bigint, n_runs bigint, longest_run bigint, kept_sha256 string" + (", kept string" if texts else "")
    return map_slices(joined.select("doc_id", "text", "cuts"), schema, task)


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the later copies cut from the text; other columns, and rows
    whose text becomes empty, stay."""
    cuts = later_copies(keyed(docs, id_col, text_col), min_words)
    d, t = free_name(docs, "__d"), free_name(docs, "__t")
    cuts = cuts.select(F.col("d").alias(d), F.col("t").alias(t), F.col("cuts").alias(free_name(docs, "__cuts")))
    key = (F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1)) == cuts[d]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == cuts[t])
    joined = docs.join(cuts, key, "left").drop(d, t)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                new = [t if t is None else cut_lines(t, c)[0] for t, c in zip(part.column(place).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True)]
                cols = [pa.array(new, pa.string()) if k == place else c for k, c in enumerate(part.columns[:-1])]
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
