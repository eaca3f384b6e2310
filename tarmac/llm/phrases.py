"""Collocations: frequent phrases of two to four words and how firmly they hold together.

A suffix pointer is a word's place in its piece; its key is the words from there on, at most
``MAX_WORDS``. The suffixes are put together and counted by multikey three-way quicksort:
segments are split by a pivot at the word they stand at, the middle parts go on to the next
word, and the size of a middle part is the count of the phrase so far. Parts of fewer than
``least`` suffixes are abandoned.

1. Words are counted (each task hands on sums), then neighbouring pairs of frequent words. A
   pair of fewer than ``least`` places leads no candidate, so its suffixes are abandoned before
   they move, and a suffix is cut where its next pair is that rare. Two Bloom filters, sized by
   the counted words and pairs (at most ``MAX_BLOOM_BITS``), tell which; what they let through
   by error is counted and dropped below.
2. Equal suffixes of a task are one row with their number. The rows are routed by their two
   leading words, so a shard has all suffixes of a pair, and are sorted there. Pairs that hold a
   large share of all places (at most ``4 * shards`` pairs can) are split by the third word, and
   their own counts added up.
3. Scores, containment and ranks are joins over the frequent phrases.

Words are 64-bit hashes of (lang, word); the words of frequent pairs are kept as text.

Rules: A-Z are lower-cased; pieces end at ``[.,;:!?]`` and 0x0A-0x0D, words at space and tab. A
NULL text is empty, a NULL lang is ``und``. Repeated rows count each. Whole texts are read a
slice at a time. An empty table gives no rows. Only the text and lang columns are read, so other
columns and their names do not matter. Products are decimals of 38 digits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.bloom import in_bloom, sized_bloom
from tarmac.llm.common import mix, partitions, save, slices
from tarmac.llm.words import Counter64, Words, byte_classes, counted, cut_words

MAX_WORDS = 4
LEAST = 30
TOP = 2000
#: A phrase goes if one that contains it occurs at least so often, in hundredths.
CONTAINED = 80
SCORE = 2_000_000
#: Pieces end at . , ; : ! ? and at 0x0A-0x0D, words at space and tab.
CLASSES = byte_classes(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")
MAX_BLOOM_BITS = 27
#: Suffixes that a task gathers before equal ones are put together, and rows of a shard as planned.
GATHERED = 1 << 19
SHARD_ROWS = 1 << 21
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def words_by_lang(part: pa.RecordBatch) -> tuple[Words, pa.Array, np.ndarray]:
    """The words of a slice (hashed with their lang), the slice's langs and each row's."""
    import xxhash

    langs = part.column("lang").dictionary_encode()
    seeds = np.array([xxhash.xxh3_64_intdigest(x) for x in langs.dictionary.to_pylist()], np.uint64)
    of = np.asarray(langs.indices)
    return cut_words(part.column("text"), CLASSES, seeds[of]), langs.dictionary, of


def pair_keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of each two neighbouring words of one piece."""
    at = np.flatnonzero(w.piece[:-1] == w.piece[1:]) if len(w.piece) > 1 else np.zeros(0, np.int64)
    return at, mix(w.hash[at] * _PAIR + w.hash[at + 1])


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).astype(np.uint64, copy=False).view(np.int64))


def collapsed(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows of ``words`` (suffixes by columns) as one, counts added."""
    order = np.lexsort(words.T[::-1])
    words, count = words[order], count[order]
    first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]).any(axis=1)))
    return words[first], np.add.reduceat(count, first)


def quicksort_counts(words: np.ndarray, count: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Phrases of at least ``least`` suffixes, by multikey three-way quicksort.

    ``words`` has a suffix a row (0 after its end), ``count`` how many suffixes a row stands for.
    All segments are split at once, each by the word of its middle row. Gives (first rows, counts) for
    every number of words: a row that begins with the phrase, and how many suffixes do.
    """
    depth_of = words.shape[1]
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(depth_of)]
    row = np.arange(len(words))  # rows in order, segment by segment
    start = np.zeros(min(1, len(words)), np.int64)
    depth = np.zeros(len(start), np.int64)
    while len(start):
        size = np.diff(np.append(start, len(row)))
        segment = np.repeat(np.arange(len(start)), size)
        at = depth[segment]
        value = words[row, at]
        pivot = value[start + size // 2]
        side = (value > pivot[segment]).astype(np.int64) - (value < pivot[segment]) + 1
        key = segment * 3 + side
        order = np.argsort(key, kind="stable")
        row, key = row[order], key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(count[row], first)
        of, middle = key[first] // 3, key[first] % 3 == 1
        level = depth[of]
        ended = middle & (pivot[of] == 0)  # the suffixes that end here are no phrase of their own
        whole = middle & ~ended & (total >= least)
        for d in range(depth_of):
            here = whole & (level == d)
            if here.any():
                found[d].append((row[first[here]], total[here]))
        level = level + middle
        go_on = ~ended & (total >= least) & (level < depth_of)
        width = np.diff(np.append(first, len(row)))
        row = row[np.repeat(go_on, width)]
        width, depth = width[go_on], level[go_on]
        start = np.cumsum(np.append(0, width))[:-1][:len(width)]
    empty = np.zeros(0, np.int64)
    return [(np.concatenate([x for x, _ in f]), np.concatenate([x for _, x in f])) if f else (empty, empty) for f in found]


class Miner:
    def __init__(self, docs: DataFrame, text_col: str, lang_col: str, least: int):
        self.docs = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text"), F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"))
        self.spark, self.least = docs.sparkSession, least

    def word_counts(self) -> DataFrame:
        """(lang, w, c): sums of words (no lang) and of all words of a lang (no w)."""
        def run(batches):
            held, total = Counter64(), {}

            def out(values, counts, langs=()):
                rows = [pa.array([None] * len(values) + [x for x, _ in langs], pa.string()), pa.concat_arrays([_long(values), pa.nulls(len(langs), pa.int64())]), pa.array([*counts.tolist(), *[n for _, n in langs]], pa.int64())]
                return pa.RecordBatch.from_arrays(rows, names=["lang", "w", "c"])

            for batch in batches:
                for part in slices(batch):
                    w, langs, of = words_by_lang(part)
                    held.add(w.hash)
                    for k, n in zip(*np.unique(of[w.row], return_counts=True), strict=True):
                        name = langs[int(k)].as_py()
                        total[name] = total.get(name, 0) + int(n)
                    if held.full():
                        yield out(*held.take())
            yield out(*held.take(), list(total.items()))

        return self.docs.mapInArrow(run, "lang string, w long, c long").groupBy("lang", "w").agg(F.sum("c").alias("c"))

    def pair_counts(self, frequent) -> DataFrame:
        """(p, c): sums of neighbouring pairs of frequent words."""
        def run(batches):
            held = Counter64()
            out = lambda values, counts: pa.RecordBatch.from_arrays([_long(values), pa.array(counts)], names=["p", "c"])
            for batch in batches:
                for part in slices(batch):
                    w, _, _ = words_by_lang(part)
                    known = in_bloom(frequent.value, w.hash)
                    at, key = pair_keys(w)
                    held.add(key[known[at] & known[at + 1]])
                    if held.full():
                        yield out(*held.take())
            yield out(*held.take())

        return self.docs.mapInArrow(run, "p long, c long").groupBy("p").agg(F.sum("c").alias("c")).where(F.col("c") >= self.least)

    def suffixes(self, pairs, heavy) -> DataFrame:
        """Suffixes that begin with a frequent pair, cut before a rare one, equal ones of a task as
        one (w1..w4, c, heavy), and the words in them (w1, lang, word)."""
        names = [f"w{k + 1}" for k in range(MAX_WORDS)]

        def run(batches):
            parts, held, seen = [], 0, np.zeros(0, np.uint64)

            def out():
                words, count = collapsed(np.concatenate(parts), np.ones(held, np.int64))
                key = mix(words[:, 0] * _PAIR + words[:, 1])
                hot = np.isin(key, heavy.value)
                none = pa.nulls(len(words), pa.string())
                return pa.RecordBatch.from_arrays([*[_long(words[:, k]) for k in range(MAX_WORDS)], pa.array(count), pa.array(hot), none, none], names=[*names, "c", "heavy", "lang", "word"])

            for batch in batches:
                for part in slices(batch):
                    w, langs, of = words_by_lang(part)
                    at, key = pair_keys(w)
                    leads = np.zeros(len(w.hash) + MAX_WORDS, bool)  # whether a frequent pair begins here
                    leads[at[in_bloom(pairs.value, key)]] = True
                    places = np.flatnonzero(leads)
                    if not len(places):
                        continue
                    rows = np.zeros((len(places), MAX_WORDS), np.uint64)
                    rows[:, 0] = w.hash[places]
                    on = np.ones(len(places), bool)
                    for k in range(1, MAX_WORDS):
                        on &= leads[places + k - 1]
                        rows[on, k] = w.hash[places[on] + k]
                    parts.append(rows)
                    held += len(rows)
                    used = np.union1d(places, places + 1)
                    hashes, where = np.unique(w.hash[used], return_index=True)
                    new = ~np.isin(hashes, seen)
                    if new.any():
                        seen = hashes if len(seen) > GATHERED else np.union1d(seen, hashes)  # only spares repeats
                        spots = used[where[new]]
                        n = len(spots)
                        no = pa.nulls(n, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [_long(hashes[new]), no, no, no, no, pa.nulls(n, pa.bool_()), pa.array([langs[int(of[w.row[i]])].as_py() for i in spots], pa.string()), pa.array([w.text(i).decode() for i in spots], pa.string())],
                            names=[*names, "c", "heavy", "lang", "word"])
                    if held > GATHERED:
                        yield out()
                        parts, held = [], 0
            if held:
                yield out()

        return self.docs.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", c long, heavy boolean, lang string, word string")

    def phrase_counts(self, suffixes: DataFrame) -> DataFrame:
        """(p, a): frequent phrases of two words and more, as arrays of word hashes."""
        least = self.least

        def run(batches):
            tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
            if not tables:
                return
            t = pa.concat_tables(tables)
            words = np.stack([np.asarray(t.column(f"w{k + 1}")).astype(np.int64).view(np.uint64) for k in range(MAX_WORDS)], axis=1)
            count, hot = np.asarray(t.column("c")).astype(np.int64), np.asarray(t.column("heavy")).astype(bool)

            def out(rows, depth, counts):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * depth, pa.int32()), _long(words[rows][:, :depth].ravel()))
                return pa.RecordBatch.from_arrays([lists, pa.array(counts, pa.int64())], names=["p", "a"])

            if hot.any():  # a split pair: this shard's part of its count
                order = np.flatnonzero(hot)
                order = order[np.lexsort((words[order, 1], words[order, 0]))]
                first = np.flatnonzero(np.append(True, (words[order[1:], :2] != words[order[:-1], :2]).any(axis=1)))
                yield out(order[first], 2, np.add.reduceat(count[order], first))
            for depth, (rows, counts) in enumerate(quicksort_counts(words, count, least), 1):
                if depth > 1:
                    own = np.ones(len(rows), bool) if depth > 2 else ~hot[rows]
                    yield out(rows[own], depth, counts[own])

        rows = suffixes.where("c is not null")
        shards = max(partitions(self.spark), -(-rows.count() // SHARD_ROWS))
        columns = [*[f"w{k + 1}" for k in range(MAX_WORDS)], "c", "heavy"]
        sizes = rows.repartition(shards, "w1", "w2", F.when(F.col("heavy"), F.col("w3"))).select(*columns).mapInArrow(run, "p array<long>, a long")
        return sizes.groupBy("p").agg(F.sum("a").alias("a")).where(F.col("a") >= least)

    def frequent(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(frequent phrases of any size (p, a), words (w, lang, word), words of each lang (lang, n))."""
        counts = self.word_counts().where(F.col("w").isNull() | (F.col("c") >= self.least))
        counts = save(counts, "word_counts")
        words = counts.where("w is not null")
        pairs = save(self.pair_counts(sized_bloom(words, "w", MAX_BLOOM_BITS)), "pair_counts")
        shards = partitions(self.spark)
        total = pairs.agg(F.sum("c")).first()[0] or 0
        heavy = pairs.where(F.col("c") * 4 * shards >= total).select("p").collect() if total else []  # at most 4 * shards
        heavy = np.array(sorted(np.int64(r["p"]).view(np.uint64) for r in heavy), np.uint64)
        found = save(self.suffixes(sized_bloom(pairs, "p", MAX_BLOOM_BITS), self.spark.sparkContext.broadcast(heavy)), "suffixes")
        phrases = words.select(F.array("w").alias("p"), F.col("c").alias("a")).unionByName(self.phrase_counts(found))
        names = found.where("c is null").select(F.col("w1").alias("w"), "lang", "word").dropDuplicates(["w"])
        return save(phrases, "phrases"), names, counts.where("w is null").select("lang", F.col("c").alias("n"))


def phrases(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each lang.

    a is the phrase's count; of the cuts into two parts of l and r places the one of the lowest
    score floor(SCORE * a / (l + r)) counts (ties: the shortest first part). A phrase inside a longer frequent one
    of at least ``CONTAINED`` hundredths of its count is left out. Ranked by score, a (both
    falling) and phrase.
    """
    found, names, totals = Miner(docs, text_col, lang_col, least).frequent()
    longer = found.where(F.size("p") > 1)
    cuts = longer.select("p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cuts = cuts.select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("left"), F.slice("p", F.col("k") + 1, F.size("p")).alias("right"))
    cuts = cuts.join(found.select(F.col("p").alias("left"), F.col("a").alias("l")), "left").join(found.select(F.col("p").alias("right"), F.col("a").alias("r")), "right")
    score = F.expr(f"cast(cast(a as decimal(28,0)) * {SCORE} div (cast(l as decimal(28,0)) + r) as bigint)")
    best = cuts.select("p", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("p", "a").agg(F.min("cut").alias("cut"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("p") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size("p") - n + 1), lambda i: F.slice("p", i, n))))
    parts = longer.where(F.size("p") > 2).select(F.explode(inner).alias("p"), "a").groupBy("p").agg(F.max("a").alias("outer"))
    kept = best.join(parts, "p", "left").where(F.col("outer").isNull() | (F.col("outer").cast("decimal(28,0)") * 100 < F.col("a").cast("decimal(28,0)") * CONTAINED))
    spelt = kept.select("p", "a", "cut", F.posexplode("p").alias("pos", "w")).join(names, "w")
    spelt = spelt.groupBy("p", "a", "cut").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
    rows = spelt.select("lang", F.array_join(F.transform("words", lambda x: x["word"]), " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))  # first the best of each of 64 parts of a lang, then of all
    some = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
