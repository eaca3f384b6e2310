"""Log-likelihood of whole documents under a gated recurrent language model.

1. Words of all documents to learn from are counted, ends of documents included. The counts
   are a distributed table; the ``KEPT_WORDS`` most frequent (a fixed bound) are broadcast.
2. The ``MODEL_WORDS`` most frequent are the model's words, all others together one more word of it.
   Every text's word numbers are saved once, for learning and for scoring. The weights are learnt
   by truncated backpropagation (``gru``) on all tokens of all documents to learn from: they are dealt
   to shards of about ``fit_tokens`` tokens and ``fit_docs`` documents, ``FIT_SHARDS`` at least, each saved as
   one row; in each round the shards of its turn learn side by side, and the weights' means (a 64th of the
   weights a task) begin the next. Every shard learns ``ROUNDS`` times, however many there are: with many, a round
   takes a part of them and there are more rounds. What the driver sees of it is one set of weights of a fixed size.
3. Each task reads its documents side by side in lanes and carries the state through whole
   texts. A word beyond the model has the probability of the model's common word for these, times
   (c + 0.1) / (R + 0.1 (U + 1)) with its own count c, where R tokens and U words are beyond it: so
   all words share one distribution, unseen words together having one part.
4. Counts of words that were not broadcast are joined by the word, every one of them.

Rules: A-Z are lower-cased, words are split at ASCII white space, every text has one end
token after its words. A NULL or empty text is the end alone. A NULL id is held out. Repeated
rows count and score each; equal texts score alike up to rounding of 32-bit floats. Words are
64-bit hashes. Very long texts are read a window at a time; a task holds about ``BATCH_TOKENS`` word
numbers, or those of one text. An empty table gives no rows; without rows to learn from every
score is 0. Only the id and the text are read, so other columns and their names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import id_and_text, save, slices
from tarmac.llm.gru import WINDOW, Gru
from tarmac.llm.words import Counter64, byte_classes, cut_words
from tarmac.session import scratch_path

#: Words end at space and 0x09-0x0D.
CLASSES = byte_classes(b"\x20\x09\x0a\x0b\x0c\x0d")
#: The end token's number among the hashes of words.
END = np.uint64(0)
MODEL_WORDS = 4095
KEPT_WORDS = 1 << 18
FIT_DOCS, FIT_TOKENS, FIT_SHARDS, ROUNDS = 1 << 14, 1 << 20, 4, 4  # documents and tokens a shard is planned for
WEIGHT_PARTS = 64
BATCH_TOKENS = 1 << 21


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, end tokens included; bounds of the texts)."""
    w = cut_words(texts, CLASSES)
    ends = np.cumsum(np.bincount(w.row, minlength=len(texts)) + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint64)
    out[np.arange(len(w.row)) + w.row] = w.hash
    return out, np.append(0, ends)


class Vocabulary:
    """The broadcast counts (hashes ascending) and the model's numbering of the most frequent words."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int, model_words: int):
        falling = np.lexsort((hashes, -counts))
        self.total, self.distinct = total, distinct
        own = falling[:model_words]
        self.beyond, self.beyond_words = total - int(counts[own].sum()), distinct - len(own)
        self.all, self.rest = total + 0.1 * (distinct + 1), self.beyond + 0.1 * (self.beyond_words + 1)
        other = int(np.searchsorted(-counts[own], -self.rest))  # the common word of all others, among the falling counts
        self.model_counts = np.insert(counts[own].astype(float), other, self.rest)
        number = np.full(len(hashes), other, np.int32)
        number[own] = np.arange(len(own)) + (np.arange(len(own)) >= other)
        order = np.argsort(hashes)
        self.hashes, self.counts, self.number, self.other = hashes[order], counts[order], number[order], other

    def look(self, tokens: np.ndarray):
        """(model number, count or -1 where it was not broadcast) of each token."""
        own, inverse = np.unique(tokens, return_inverse=True)
        if not len(self.hashes):
            return np.full(len(tokens), self.other, np.int32), np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        known = self.hashes[at] == own
        return np.where(known, self.number[at], self.other).astype(np.int32)[inverse], np.where(known, self.counts[at], -1)[inverse]

    def model(self) -> Gru:
        end = self.look(np.array([END]))[0][0]
        return Gru(self.model_counts, int(end))


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from: crc32 of the id as text is a multiple of 10, or no id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(True))


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, c): how often each token (as a hash) occurs in the column ``text``."""
    def run(batches):
        held = Counter64()
        out = lambda values, counts: pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["w", "c"])
        for batch in batches:
            for part in slices(batch):
                held.add(tokens_of(part.column("text"))[0])
                if held.full():
                    yield out(*held.take())
        yield out(*held.take())

    return texts.select("text").mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, model_words: int = MODEL_WORDS, kept_words: int = KEPT_WORDS) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # The words above the least count that leaves ``kept_words`` at most: no task sorts them.
    sizes = counts.groupBy("c").agg(F.count("*").alias("words")).orderBy(F.col("c").desc()).limit(kept_words).collect()  # each count has a word
    fit_in = np.cumsum([r["words"] for r in sizes]) <= kept_words
    least = min((r["c"] for r, ok in zip(sizes, fit_in, strict=True) if ok), default=None)
    top = counts.where(F.lit(False) if least is None else F.col("c") >= least).toArrow()  # at most ``kept_words``
    return Vocabulary(np.asarray(top.column("w")).astype(np.int64).view(np.uint64), np.asarray(top.column("c")).astype(np.int64), int(sums["n"] or 0), int(sums["v"]), model_words)


def lists_of(column) -> list[np.ndarray]:
    """The arrays in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
    return np.split(np.asarray(column.flatten()), np.cumsum(sizes)[:-1]) if len(sizes) else []


def fit(numbers: DataFrame, words, fit_docs: int, fit_tokens: int, shards: int, rounds: int, passes: int = 1) -> bytes:
    """Weights learnt from all of ``numbers`` (doc_id, ids), each row in one shard; ``rounds`` rounds, or more, until
    every shard has learnt ``passes`` times."""
    spark, model = numbers.sparkSession, words.value.model()
    count = numbers.agg(F.count("*"), F.sum(F.size("ids"))).first() if rounds else (0, 0)
    if not count[0]:
        return model.dump()
    least = shards
    shards = max(shards, -(-count[0] // fit_docs), -(-count[1] // fit_tokens))
    turns = max(1, min(rounds, shards // least))  # every shard has a turn, and as many learn side by side as asked for
    h = F.xxhash64("doc_id", "ids")
    rows = numbers.select(F.pmod(h, F.lit(shards)).cast("int").alias("shard"), h.alias("h"), "ids")

    def pack(table: pa.Table) -> pa.Table:
        lists, shard = lists_of(table.sort_by("h").column("ids")), table.column("shard")[0].as_py()
        return pa.table({"turn": pa.array([shard % turns], pa.int32()), "shard": pa.array([shard], pa.int32()), "sizes": pa.array([list(map(len, lists))], pa.list_(pa.int64())), "ids": pa.array([np.concatenate(lists).astype(np.int32).tobytes()], pa.binary())})

    packed = rows.groupBy("shard").applyInArrow(pack, "turn int, shard int, sizes array<long>, ids binary")
    path = scratch_path(spark, "lm_shards")
    packed.write.option("maxRecordsPerFile", 1).partitionBy("turn").parquet(path)  # a file each, for any task to take

    def trainer(start, turn):
        def train(batches):
            total, held, first = 0.0, 0, -1
            for batch in batches:
                for shard, sizes, ids in zip(*map(batch.column, ("shard", "sizes", "ids")), strict=True):
                    own = words.value.model()
                    own.load(start.value)
                    lists = np.split(np.frombuffer(ids.as_buffer(), np.int32), np.cumsum(sizes.as_py())[:-1])
                    # as many lanes as leave enough steps
                    width = min(max(sum(map(len, lists)) // (WINDOW * 256), 32), 128)
                    own.learn([lists[i] for i in np.random.default_rng(turn).permutation(len(lists))], width)
                    total, held, first = total + np.concatenate(own.parts(1)).astype(np.float64), held + 1, shard.as_py() if first < 0 else first
            if held:
                parts = np.array_split(total, WEIGHT_PARTS)
                yield pa.RecordBatch.from_arrays([pa.array([first] * len(parts), pa.int32()), pa.array([held] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["shard", "held", "part", "weights"])

        return train

    def mean(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("weights"))
        return pa.table({"part": table.column("part").slice(0, 1), "weights": pa.array([(total / pc.sum(table.column("held")).as_py()).astype(np.float32).tobytes()], pa.binary())})

    shards_saved = spark.read.schema(packed.schema).parquet(path)
    for turn in range(max(rounds, passes * turns)):
        start = spark.sparkContext.broadcast(model.dump())
        own = shards_saved.where(F.col("turn") == turn % turns)
        learnt = own.mapInArrow(trainer(start, turn), "shard int, held int, part int, weights binary")  # the sum of a task's shards
        got = learnt.groupBy("part").applyInArrow(mean, "part int, weights binary").collect()  # one set of weights
        if got:
            model.take([np.frombuffer(r["weights"], np.float32) for r in sorted(got, key=lambda r: r["part"])])
    return model.dump()


def lm_scores(docs: DataFrame, learn: F.Column | None = None, id_col: str = "doc_id", text_col: str = "text", model_words: int = MODEL_WORDS, kept_words: int = KEPT_WORDS, fit_docs: int = FIT_DOCS, fit_tokens: int = FIT_TOKENS, shards: int = FIT_SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``learn`` (a condition on ``doc_id``) says which rows may be learnt from; the default leaves out
    ``held_out``. Every row to learn from is learnt from ``rounds`` times. base_score is the log10 probability
    under the smoothed word counts, score that under the recurrent model.
    """
    base = id_and_text(docs, id_col, text_col)
    learn = ~held_out(F.col("doc_id")) if learn is None else F.coalesce(learn, F.lit(False))
    base = base.withColumn("held_out", ~learn)
    rows = base.where(~F.col("held_out"))
    counts = save(word_counts(rows), "lm_counts")
    vocab = vocabulary(counts, model_words, kept_words)
    sc = docs.sparkSession.sparkContext
    words = sc.broadcast(vocab)
    kind = base.schema["doc_id"].dataType.simpleString()

    def number(batches):
        vocab = words.value
        for batch in batches:
            for part in slices(batch):
                tokens, bounds = tokens_of(part.column("text"))
                n = part.num_rows
                row = np.repeat(np.arange(n), np.diff(bounds))
                ids, c = vocab.look(tokens)
                here = c >= 0
                other = here & (ids == vocab.other)
                of = np.bincount
                far = np.flatnonzero(~here)  # their counts are joined later
                order = far[np.lexsort((tokens[far], row[far]))]
                new = np.ones(len(order), bool)
                new[1:] = (tokens[order[1:]] != tokens[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                lists = np.append(0, np.cumsum(of(row[order[first]], minlength=n)))
                yield pa.RecordBatch.from_pydict({
                    "rid": part.column("rid"), "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                    "n_tokens": np.diff(bounds), "n_known": of(row[here], minlength=n),
                    "base_score": of(row[here], np.log10((c[here] + 0.1) / vocab.all), minlength=n).astype(float),
                    "score": of(row[other], np.log10((c[other] + 0.1) / vocab.rest), minlength=n).astype(float),
                    "far": pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(tokens[order[first]].view(np.int64))),
                    "times": pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(times.astype(np.int64))),
                    "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                })

    schema = f"rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, far array<long>, times array<long>, ids array<int>"
    marked = base.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text")
    numbers = save(marked.mapInArrow(number, schema), "lm_numbers")
    weights = sc.broadcast(fit(numbers.where(~F.col("held_out")).select("doc_id", "ids"), words, fit_docs, fit_tokens, shards, rounds, passes=rounds))
    exact = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base_score"]

    def run(batches):
        model = words.value.model()
        model.load(weights.value)
        for batch in batches:
            part = np.cumsum(np.asarray(batch.column("n_tokens"))) // BATCH_TOKENS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = batch.slice(a, b - a)
                total = np.asarray(own.column("score")) + model.score(lists_of(own.column("ids")))
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in exact], pa.array(total)], names=[*exact, "score"])

    scored = save(numbers.select(*exact, "score", "ids").mapInArrow(run, f"rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"), "lm_scored")
    far = numbers.select("rid", F.explode(F.arrays_zip("far", "times")).alias("x")).select("rid", F.col("x.far").alias("w"), F.col("x.times").alias("k"))
    c = F.coalesce("c", F.lit(0))
    far = far.join(counts, "w", "left").groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10((c + 0.1) / vocab.all)).alias("far_base"),
        F.sum(F.col("k") * F.log10((c + 0.1) / vocab.rest)).alias("far_score"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return scored.join(far, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("far_base")).alias("base_score"), (F.col("score") + zero("far_score")).alias("score"))
