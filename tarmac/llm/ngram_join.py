"""N-gram Jaccard self-join with grouped prefixes, and its connected components.

A document's set holds 64-bit hashes of its distinct five-word shingles. Two sets of likeness
t or more must share a shingle among their first |x| - ceil(t |x|) + 1 in any fixed order
(prefix filter). The order here puts shared shingles late and often met ones last: they are
counted over all documents' prefixes by hash, and those met twice and those met often are
noted in two Bloom filters of fixed size, which are broadcast. What these say is the same
for all documents, so the order is one order whatever their errors. A document that shares
only passages with others so has a prefix that no other document has.

1. Equal sets make a class, and classes of equal prefix and size a group; only one posting
   list entry (token, group, size, position) is made per group and prefix shingle.
2. Group pairs come from shared tokens, filtered by size and position. Short posting lists
   give their pairs; in long ones (a token of more than ``LONG`` groups) members are compared
   with a few pivots of the list, and then those left outside the largest component, in
   blocks, with all the others. So copies are not expanded into all pairs, and no link between
   components is lost.
3. Group pairs expand to class pairs, which are verified on the whole sets.
4. Components of the verified links; every document gets the least id of its component.

Rules: A-Z are lower-cased, words are split at ASCII white space. With fewer than five words
the sequence is one shingle. A NULL, empty or blank text has no shingles and links with
nothing. Rows of an equal doc_id are one document for linking if their texts agree, and are
joined by their id if not. Rows without an id are carried through with a NULL component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.bloom import Bloom, in_bloom, sized_bloom
from tarmac.llm.common import WordHashes, free_name, id_and_text, lower_words, map_slices, mix, partitions, save
from tarmac.llm.components import components

#: Groups of a posting list that are compared pair by pair.
LONG = 32
#: Members of a longer list that are compared with all its members.
PIVOTS = 4
#: Members of a cluster of long lists that are held together and compared with all the others.
BLOCK = 512
_HASHES = WordHashes()


def shingle_set(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    h = _HASHES.of(lower_words(text))
    if not len(h):
        return h
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def shingle_sets(texts: list[str], n: int = 5) -> list[np.ndarray]:
    """The set of each text; the shingles of all texts are hashed together."""
    lists = [lower_words(t) for t in texts]
    h = _HASHES.of([w for words in lists for w in words])
    out = np.full(max(len(h) - n + 1, 0), n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(out)])
    sets, at = [], 0
    for t, words in zip(texts, lists, strict=True):
        if len(words) < n:
            sets.append(shingle_set(t, n))
        else:
            own = np.sort(out[at:at + len(words) - n + 1])
            sets.append(own[np.append(True, own[1:] != own[:-1])])
        at += len(words)
    return sets


def prefixes_of(sets: list[np.ndarray], blooms: list[Bloom], share: int) -> list[np.ndarray]:
    """The prefix of each set in the common order: by the last filter that knows a shingle
    (none first), then by hash. The filters are asked for all sets together."""
    whole = np.concatenate([np.zeros(0, np.uint64), *sets])
    mixed = mix(whole)  # no ties: mix gives different values for different hashes
    known = sum((in_bloom(b, whole).astype(np.int8) for b in blooms), np.zeros(len(whole), np.int8)) if blooms else None
    out, at = [], 0
    for s in sets:
        n = len(s)
        left = n - (share * n + 99) // 100 + 1 if n else 0
        own, parts = mixed[at:at + n], []
        for level in range(len(blooms) + 1):
            here = np.flatnonzero(known[at:at + n] == level) if blooms else np.arange(n)
            order = own[here]
            if len(here) > left:  # the least ones, before they are put in order
                least = np.argpartition(order, left - 1)[:left]
                here, order = here[least], order[least]
            parts.append(here[np.argsort(order)])
            left -= len(here)
            if not left:
                break
        out.append(s[np.concatenate(parts)] if len(parts) > 1 else s[parts[0]])
        at += n
    return out


def digests(sets: list[np.ndarray], k: int) -> pa.Array:
    """A hash of each whole set (0 of an empty one)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros(len(sets), np.uint64)
    if sizes.any():
        firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
        out[sizes > 0] = np.bitwise_xor.reduceat(mix(np.concatenate(sets) * np.uint64(k)), firsts)
    return pa.array(out.view(np.int64))


def owners(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all sets in order, and the number of the set that each is from."""
    held = np.concatenate([np.zeros(0, np.uint64), *sets])
    order = np.argsort(held)
    return held[order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]


def shared_counts(index: tuple[np.ndarray, np.ndarray], tokens: np.ndarray, n: int) -> np.ndarray:
    """How many of ``tokens`` each of the ``n`` sets of ``index`` holds."""
    held, owner = index
    both = np.zeros(n, np.int64)
    for at in range(0, len(tokens), 4096):  # so many are met at most by all sets of a block at once
        part = tokens[at:at + 4096]
        first = np.searchsorted(held, part)
        times = np.searchsorted(held, part, "right") - first
        place = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        both += np.bincount(owner[place], minlength=n)
    return both


def similar_pairs_filter(a: str, b: str, share: int) -> F.Column:
    """Size and position filters for two posting entries of one token. At the first token that
    two sets share nothing before it is shared, so what remains bounds the overlap; alike sets
    pass there, whatever their later tokens say."""
    na, nb, pa_, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    # needed overlap: 100 o >= share (na + nb - o)
    possible = F.least(na - pa_, nb - pb)
    return (100 * F.least(na, nb) >= share * F.greatest(na, nb)) & ((100 + share) * possible >= share * (na + nb))


class Join:
    """One self-join; ``share`` is the least likeness in hundredths."""

    def __init__(self, docs: DataFrame, n: int, share: int):
        self.docs, self.n, self.share = docs, n, share
        self.spark = docs.sparkSession

    def signatures(self) -> DataFrame:
        """One row per document: size, hash of the whole set, prefix and its hash."""
        n, share = self.n, self.share

        def tokens(batches):
            from tarmac.llm.common import slices

            for batch in batches:
                for part in slices(batch):
                    sets = shingle_sets(part.column("text").to_pylist(), n)
                    got = np.concatenate([np.zeros(0, np.uint64), *prefixes_of(sets, [], share)])
                    own, count = np.unique(got, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(count)], names=["token", "c"])

        counts = self.docs.mapInArrow(tokens, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
        counts = save(counts.where("c > 1"), "counts")
        twice = sized_bloom(counts, "token")
        hot = sized_bloom(counts.where(F.col("c") > LONG), "token")

        def task():
            def each(part: pa.RecordBatch) -> dict:
                sets = shingle_sets(part.column("text").to_pylist(), n)
                firsts = prefixes_of(sets, [twice.value, hot.value], share)
                return {
                    "doc_id": part.column("doc_id"),
                    "n": pa.array(map(len, sets), pa.int64()),
                    "s1": digests(sets, 0xD6E8FEB86659FD93),
                    "s2": digests(sets, 0xA0761D6478BD642F),
                    "p": digests(firsts, 0xE7037ED1A0B428DB),
                    "prefix": pa.array([s.view(np.int64) for s in firsts], pa.list_(pa.int64())),
                }

            return each

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        return save(map_slices(self.docs, f"doc_id {kind}, n bigint, s1 bigint, s2 bigint, p bigint, prefix array<bigint>", task), "signatures")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(id, set) of the wanted documents. A Bloom filter leaves out most others before
        their texts are cut up; the join makes it exact."""
        bloom, n = sized_bloom(wanted, "id"), self.n

        def some(batches):
            from tarmac.llm.common import slices

            for batch in batches:
                for part in slices(batch):
                    ids = part.column("doc_id")
                    part = part.filter(pa.array(in_bloom(bloom.value, np.asarray(ids).astype(np.int64).view(np.uint64))))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(part.column("text").to_pylist(), n)], pa.binary())], names=["id", "set"])

        kept = self.docs.where("doc_id is not null").mapInArrow(some, "id long, set binary")
        return save(kept.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("set").alias("set")), "sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The (saved) pairs (a, b) whose whole sets are alike enough."""
        sets = self.sets(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
        share = self.share

        def check(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    good = []
                    for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True):
                        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        good.append(100 * both >= share * (len(x) + len(y) - both))
                    yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

        both = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
        return save(both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), "links")

    def short_pairs(self, postings: DataFrame) -> DataFrame:
        """Pairs of the members of short lists."""
        lists = postings.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("id", "n", "pos"))).alias("l"))
        pairs = lists.select("l", F.explode("l").alias("x")).select("x", F.explode("l").alias("y")).where("x.id < y.id")
        return pairs.where(similar_pairs_filter("x", "y", self.share)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()

    def pivot_pairs(self, postings: DataFrame, seed: int) -> DataFrame:
        """Each list's members with its pivot of this round."""
        entry = F.struct(F.xxhash64("id", F.lit(seed)).alias("h"), "id", "n", "pos")
        pivots = postings.groupBy("token").agg(F.min(entry).alias("x"))
        pairs = postings.select("token", F.struct("id", "n", "pos").alias("y")).join(pivots, "token").where("x.id <> y.id")
        return pairs.where(similar_pairs_filter("x", "y", self.share)).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()

    def across(self, postings: DataFrame, links: DataFrame, members_of) -> DataFrame:
        """Verified links between members of long lists that are in different components so far.

        Lists with one pivot make a cluster. Its members outside the cluster's largest
        component are dealt to blocks of about ``BLOCK``; all members pass by each block and
        are compared with the whole block at once, over an index of its shingles. So a task
        holds one block, and only links become rows.
        """
        labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        entry = F.min(F.struct(F.xxhash64("id", F.lit(0)).alias("h"), "id"))
        clusters = postings.groupBy("token").agg(entry.alias("x")).select("token", F.col("x.id").alias("k"))
        found = members_of(postings.join(clusters, "token").select("k", "id").distinct()).distinct()
        found = found.join(labels, F.col("id") == F.col("node"), "left").select("k", "id", F.coalesce("component", "id").alias("c"))
        found = save(found, "clusters")
        sizes = found.groupBy("k", "c").agg(F.count("*").alias("n"))
        main = sizes.groupBy("k").agg(F.max(F.struct("n", "c")).alias("m"), F.sum("n").alias("total"))
        main = main.where("m.n < total").select("k", F.col("m.c").alias("main"), F.ceil((F.col("total") - F.col("m.n")) / BLOCK).cast("int").alias("blocks"))
        dealt = found.join(main, "k")
        own = dealt.where("c <> main").select("k", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int").alias("block"), F.lit(0).alias("role"), "id")
        every = dealt.select("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "id")
        sets = self.sets(dealt.select("id").distinct())
        rows = own.union(every).join(sets, "id").select("k", "block", "role", "id", "set")
        share = self.share

        def compare(batches):
            key, ids, sizes, block_sets, index = None, [], [], [], None
            for batch in batches:
                a, b = [], []
                for k, block, role, i, raw in zip(*[batch.column(c).to_pylist() for c in ("k", "block", "role", "id", "set")], strict=True):
                    if (k, block) != key:
                        key, ids, sizes, block_sets, index = (k, block), [], [], [], None
                    tokens = np.frombuffer(raw, np.uint64)
                    if not role:
                        ids.append(i)
                        sizes.append(len(tokens))
                        block_sets.append(tokens)
                        continue
                    if index is None:
                        index, block_sets, sizes = owners(block_sets), [], np.array(sizes, np.int64)
                    both = shared_counts(index, tokens, len(ids))
                    for x in np.flatnonzero(100 * both >= share * (sizes + len(tokens) - both)).tolist():
                        if ids[x] != i:
                            a.append(min(ids[x], i))
                            b.append(max(ids[x], i))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        n = partitions(self.spark)
        rows = rows.repartition(n, "k", "block").sortWithinPartitions("k", "block", "role")
        return save(rows.mapInArrow(compare, "a long, b long"), "links")

    def links(self, postings: DataFrame, expand, members_of) -> DataFrame:
        """Verified class links that connect what the posting lists let meet."""
        counts = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
        shared = save(postings.join(counts, "token"), "postings")
        long = shared.where(F.col("c") > LONG)
        pairs = self.short_pairs(shared.where(F.col("c") <= LONG))
        for seed in range(PIVOTS):
            pairs = pairs.union(self.pivot_pairs(long, seed))
        tested = save(expand(pairs.distinct()), "tested")
        links = self.verified(tested)
        if long.isEmpty():
            return links
        return links.union(self.across(long, links, members_of))

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id)."""
        signed = self.signatures()
        full = signed.where("n > 0 and doc_id is not null")
        classes = save(full.groupBy("n", "p", "s1", "s2").agg(F.min(F.col("doc_id").cast("long")).alias("id")), "classes")
        groups = save(classes.groupBy("n", "p").agg(F.min("id").alias("g"), F.count("*").alias("k")), "groups")
        members = classes.join(groups, ["n", "p"]).select("g", "id", "n", "k")

        def expand(pairs: DataFrame) -> DataFrame:
            """Group pairs as class pairs (most groups have one class)."""
            m = members.select("g", "id")
            return pairs.join(m.select(F.col("g").alias("a"), F.col("id").alias("ca")), "a").join(m.select(F.col("g").alias("b"), F.col("id").alias("cb")), "b").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))

        def members_of(found: DataFrame) -> DataFrame:
            """The classes of the groups ``id`` of (k, id)."""
            return found.withColumnRenamed("id", "g").join(members.select("g", "id"), "g").select("k", "id")

        lead = full.withColumn("id", F.col("doc_id").cast("long")).join(groups.select(F.col("g").alias("id")), "id", "left_semi")
        postings = lead.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
        links = self.links(postings, expand, members_of)
        inner = save(members.where("k > 1").select(F.col("g").alias("token"), "id", "n", F.lit(0).alias("pos")), "inner")
        if not inner.isEmpty():
            links = links.union(self.links(inner, lambda p: p, lambda m: m))
        labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        of_class = classes.join(labels, F.col("id") == F.col("node"), "left").select("n", "p", "s1", "s2", F.coalesce("component", "id").alias("component_id"))
        kind = self.docs.schema["doc_id"].dataType
        out = signed.select("doc_id", "n", "p", "s1", "s2").join(of_class, ["n", "p", "s1", "s2"], "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).cast(kind).alias("component_id"))


def shared_ids(base: DataFrame) -> DataFrame:
    """Ids that stand for more than one text."""
    t = F.xxhash64("text")
    return base.where("doc_id is not null").groupBy("doc_id").agg((F.min(t) != F.max(t)).alias("more")).where("more").select("doc_id")


def near_duplicates(docs: DataFrame, n: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; ids are integers."""
    base = id_and_text(docs, id_col, text_col)
    if shared_ids(base).isEmpty():
        return Join(base, n, share).run()
    # every (id, text) is joined on its own; then components that share an id are one
    kind = base.schema["doc_id"].dataType
    own = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    found = save(Join(base.select(own.alias("doc_id"), "text"), n, share).run().distinct().withColumnRenamed("doc_id", "own"), "own_components")
    ids = save(base.select(own.alias("own"), F.col("doc_id").cast("long").alias("id")), "own_ids")
    joined = ids.where("own is not null").distinct().join(found, "own")
    least = joined.groupBy("component_id").agg(F.min("id").alias("least"))
    nodes = components(joined.join(least, "component_id").select(F.col("id").alias("u"), F.col("least").alias("v")))
    placed = joined.join(nodes, F.col("id") == F.col("node"), "left").select("own", "n_shingles", F.coalesce("component", "id").cast(kind).alias("component_id"))
    none = found.where("own is null").select("n_shingles")
    with_id = ids.where("own is not null").join(placed, "own").select(F.col("id").cast(kind).alias("doc_id"), "n_shingles", "component_id")
    if none.isEmpty():
        return with_id
    lost = Join(base.where("doc_id is null"), n, share).signatures().select(F.col("doc_id").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast(kind).alias("component_id"))
    return with_id.unionByName(lost)


def one_of_each(docs: DataFrame, n: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that lead their component (or have no id): one document of each
    group, all columns unchanged. Of rows that share the leading id one stays (the least by a hash of the
    text)."""
    found = near_duplicates(docs, n, share, id_col, text_col)
    name = free_name(docs, "__later")
    later = found.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(later, docs[id_col] == later[name], "left_anti")
    again = docs.where(docs[id_col].isNotNull()).groupBy(docs[id_col].alias(name)).count().where("count > 1").select(name)
    if again.isEmpty():
        return kept
    twice = kept.join(again, kept[id_col] == again[name], "left_semi")
    first = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), F.xxhash64(*docs.columns)))
    one = twice.withColumn(name, first).where(F.col(name) == 1).drop(name)
    return kept.join(again, kept[id_col] == again[name], "left_anti").unionByName(one)


