"""Balanced shards by label propagation under capacity quotas.

Documents with equal texts are linked, and ``links`` may link others, with weights. Equal
texts are one class: a node whose weight is its number of members, so the links of a group are
never listed. Every document starts in a shard given by a hash of its id. Then:

* Large classes (more than a ``LARGE``-th of a shard; so at most about ``LARGE`` of them for a
  shard) are placed first, on the driver and by size: where the least room is left that holds
  all of the class. Only a class that no shard has room for is split, into the largest rooms.
* Rounds settle the small classes (``settle``): a join gives each class its neighbours' shards (where its members
  started and where linked classes have settled); of those with room for all of it, it wishes
  for the one that holds most. Each shard takes the classes that wish for it, whole, up to its room; the
  refused wish again in the next round, by the rooms and neighbours of then. The rounds end when one
  settles less than a ``LEAST``-th of the linked documents.
* The classes left are put in a line that fills the rooms left, the largest first. Only a class
  at the end of a room is split, so fewer are split than there are shards.
* With links between classes, rounds move whole classes (``improve``): each may move to the shard that most of
  its neighbours' weight is in. Moves from a to b are taken together with those from b to a, so that
  full shards swap, and what one direction has more must fit in the room left. Only half of the classes, by a hash, may move in
  a round, so linked ones don't pass each other. The rounds end when two in a row do not lower the weight of the links cut.
* Documents without links stay where they start while there is room, and the rest fill up the
  shards, so that counts are exactly even.

Ranks within a shard use buckets: counts per (shard, bucket) give offsets, and rows are
numbered within a bucket, so no task holds a whole shard. The documents of a class are numbered
only if it is split. Every round's labels are written to the shared folder. The driver gets sums per shard and per pair of shards.

Law ``rows``: the shards' numbers of rows differ by one at most. A document's size is the
UTF-8 bytes of its text (NULL: none) plus 16. NULL counts as the empty text. Rows are placed
each, also repeated ones and those without an id. Only the id and text columns are read. Of the links, those
with an id that no document has, and those within a class, have no effect; an id of several texts links all of them.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import id_and_text, partitions, save

#: Groups above this part of a shard are placed one by one.
LARGE = 8
#: A round that settles fewer linked documents than this part of them is the last one.
LEAST = 1000
CLASS = ["g1", "g2"]


def _pick(shard: Column, values: list[int]) -> Column:
    """The entry of a short list that belongs to the shard."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), shard + 1)


def _hole(at: Column, ends: list[int]) -> Column:
    """The number of the room, of rooms that end at ``ends``, that holds this place of a line."""
    hole = F.lit(0)
    for e in ends:
        hole = hole + F.when(at >= e, 1).otherwise(0)
    return hole


def _numbered(rows: DataFrame, shard: str, bucket: str, order: list, out: str, weight: str | None = None) -> DataFrame:
    """Gapless numbers from 0 within each shard, in the order of buckets; a row takes ``weight`` of them."""
    n = F.col(weight) if weight else F.lit(1)
    counts = rows.groupBy(shard, bucket).agg(F.sum(n).alias("__n"))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, bucket, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy(shard, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("__k", F.sum(n).over(within) - n)
        .join(offsets, [shard, bucket])
        .withColumn(out, (F.col("__off") + F.col("__k")).cast("long"))
        .drop("__k", "__off")
    )


def pack(sizes: list[int], room: list[int]) -> list[list[tuple[int, int]]]:
    """For each group, largest first, its pieces (shard, members); ``room`` is used up."""
    out = []
    for left in sizes:
        pieces = []
        while left:
            fits = [s for s, r in enumerate(room) if r >= left]
            s = min(fits, key=lambda s: room[s]) if fits else max(range(len(room)), key=lambda s: room[s])
            pieces.append((s, min(left, room[s])))
            room[s] -= pieces[-1][1]
            left -= pieces[-1][1]
        out.append(pieces)
    return out


def settle(free: DataFrame, votes: DataFrame, links: DataFrame | None, settled: DataFrame, room: list[int], total: int) -> tuple[DataFrame, DataFrame]:
    """Rounds of wishes under quotas. ``free`` (g1, g2, members) are to be placed, ``votes`` (g1, g2, init, n) tell where
    members started, ``settled`` (g1, g2, at) are placed. Returns what is settled after the rounds, and what is not; ``room`` is used up."""
    buckets = partitions(free.sparkSession)
    while max(room) > 0:
        pulls = votes.select(*CLASS, F.col("init").alias("wish"), "n")
        if links is not None:
            near = settled.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("at").alias("wish"))
            pulls = pulls.union(links.join(near, ["h1", "h2"]).select(*CLASS, "wish", "weight"))
        pulls = pulls.join(free, CLASS).where(F.col("members") <= _pick(F.col("wish"), room))
        pulls = pulls.groupBy(*CLASS, "members", "wish").agg(F.sum("n").alias("n"))
        best = F.max(F.struct("n", F.xxhash64("g1", "g2", "wish").alias("h"), "wish"))["wish"]
        wishes = pulls.groupBy(*CLASS, "members").agg(best.alias("wish")).withColumn("bucket", F.pmod(F.xxhash64("g1", "g2"), F.lit(buckets)).cast("int"))
        wishes = save(_numbered(wishes, "wish", "bucket", CLASS, "start", "members"), "wishes")
        taken = save(wishes.where(F.col("start") + F.col("members") <= _pick(F.col("wish"), room)).select(*CLASS, "members", F.col("wish").alias("at")), "taken")
        moved = 0
        for r in taken.groupBy("at").agg(F.sum("members").alias("n")).collect():  # a row a shard
            room[r["at"]] -= r["n"]
            moved += r["n"]
        if moved:
            settled = settled.union(taken.select(*CLASS, "at"))
            free = save(free.join(taken.select(*CLASS), CLASS, "left_anti"), "free")
        if moved * LEAST <= total:
            break
    return settled, free


def cut_weight(links: DataFrame, labels: DataFrame) -> int:
    """The weight of the links (each given in both directions) whose classes are in different shards."""
    a = labels.select(*CLASS, "at")
    b = labels.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("at").alias("to"))
    r = links.join(a, CLASS).join(b, ["h1", "h2"]).where("at != to").agg(F.sum("weight").alias("w")).first()
    return int(r["w"] or 0) // 2


def improve(labels: DataFrame, links: DataFrame, room: list[int]) -> DataFrame:
    """Rounds of moves and swaps of whole classes. ``labels`` (g1, g2, members, at); ``room`` follows the moves."""
    buckets, shards = partitions(labels.sparkSession), len(room)
    best, turn, idle = cut_weight(links, labels), 0, 0
    while best and idle < 2:
        near = labels.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("at").alias("to"))
        pulls = links.join(near, ["h1", "h2"]).groupBy(*CLASS, "to").agg(F.sum("weight").alias("w")).join(labels, CLASS)
        home = F.coalesce(F.max(F.when(F.col("to") == F.col("at"), F.col("w"))), F.lit(0))
        other = F.max(F.when(F.col("to") != F.col("at"), F.struct("w", F.xxhash64("g1", "g2", "to").alias("h"), "to")))
        wishes = pulls.groupBy(*CLASS, "members", "at").agg(home.alias("own"), other.alias("o"))
        wishes = wishes.where((F.col("o.w") > F.col("own")) & (F.pmod(F.xxhash64("g1", "g2", F.lit(turn)), F.lit(2)) == 0))
        wishes = wishes.select(*CLASS, "members", "at", F.col("o.to").alias("to"), (F.col("o.w") - F.col("own")).alias("gain"), (F.col("at") * shards + F.col("o.to")).alias("way"))
        wishes = wishes.withColumn("bucket", F.pmod(F.xxhash64("g1", "g2"), F.lit(buckets)).cast("int"))
        wishes = save(_numbered(wishes, "way", "bucket", [F.col("gain").desc(), *CLASS], "start", "members"), "moves")
        flow = {(r["at"], r["to"]): r["n"] for r in wishes.groupBy("at", "to").agg(F.sum("members").alias("n")).collect()}  # shards squared
        spare, most = list(room), {}
        for (a, b), n in sorted(flow.items()):
            back = flow.get((b, a), 0)
            extra = min(max(n - back, 0), max(spare[b], 0))  # beyond the swap, as much as there is room
            spare[b] -= extra
            most[a, b] = min(n, back) + extra
        limits = labels.sparkSession.createDataFrame([(a * shards + b, n) for (a, b), n in most.items()] or [(-1, 0)], "way int, most long")
        moves = save(wishes.join(F.broadcast(limits), "way").where("start + members <= most").select(*CLASS, "at", "to", "members", "way"), "quota")
        went = {(r["at"], r["to"]): r["n"] for r in moves.groupBy("at", "to").agg(F.sum("members").alias("n")).collect()}
        after, ways = list(room), []
        for a, b in sorted({tuple(sorted(k)) for k in went}):  # a pair of shards at a time, so that no room is passed
            more = went.get((a, b), 0) - went.get((b, a), 0)
            if after[b] >= more and after[a] >= -more:
                after[b] -= more
                after[a] += more
                ways += [(a * shards + b,), (b * shards + a,)]
        turn += 1
        if not ways:
            idle += 1
            continue
        moves = moves.join(F.broadcast(labels.sparkSession.createDataFrame(ways, "way int")), "way").select(*CLASS, "to")
        moved = save(labels.join(moves, CLASS, "left").select(*CLASS, "members", F.coalesce("to", "at").alias("at")), "labels")
        cut = cut_weight(links, moved)
        if cut < best:
            labels, best, idle = moved, cut, 0
            room[:] = after
        else:
            idle += 1
    return labels


def place_groups(groups: DataFrame, votes: DataFrame, links: DataFrame | None, room: list[int]) -> tuple[DataFrame, DataFrame]:
    """Classes (g1, g2, members) as (g1, g2, at, cut): the shard, or for a split class its
    number; and (cut, upto, to): of a split class, the members before ``upto`` are in ``to``.
    ``room`` is used up."""
    spark = groups.sparkSession
    buckets = partitions(spark)
    shards, even = len(room), min(room)
    large = groups.where(F.col("members") * LARGE > even).where("members > 1").select("g1", "g2", "members").collect()  # so many that they fill shards
    large.sort(key=lambda r: (-r["members"], r["g1"], r["g2"]))
    pieces = dict(zip([(r["g1"], r["g2"]) for r in large], pack([r["members"] for r in large], room), strict=True))

    small = groups.where((F.col("members") * LARGE <= even) | (F.col("members") == 1))
    total = small.agg(F.sum("members").alias("n")).first()["n"] or 0
    whole = [(g1, g2, parts[0][0]) for (g1, g2), parts in pieces.items() if len(parts) == 1]
    settled, free = settle(small, votes, links, spark.createDataFrame(whole, "g1 long, g2 long, at int"), room, total)
    refused = free.agg(F.sum("members").alias("n")).first()["n"] or 0
    order = sorted(range(shards), key=lambda s: (-room[s], s))
    ends = list(accumulate(room[s] for s in order))
    free = free.withColumn("line", F.lit(0)).withColumn("bucket", F.pmod(F.xxhash64("g1", "g2"), F.lit(buckets)).cast("int"))
    line = _numbered(free, "line", "bucket", CLASS, "start", "members")
    line = line.withColumn("hole", _hole(F.col("start"), ends)).withColumn("last", _hole(F.col("start") + F.col("members") - 1, ends))
    line = save(line.select("g1", "g2", "members", "start", "hole", "last"), "line")
    for r in line.where("hole < last").collect():  # fewer than shards
        edges = [r["start"], *[e for e in ends[r["hole"]:r["last"]]], r["start"] + r["members"]]
        pieces[r["g1"], r["g2"]] = [(order[r["hole"] + k], b - a) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
    for s, end in zip(order, ends, strict=True):
        room[s] = min(room[s], max(0, end - refused))

    split, cuts = [], []
    for (g1, g2), parts in pieces.items():
        if len(parts) > 1:
            cuts.append((g1, g2, None, len(split)))
            split.append((len(split), list(accumulate(n for _, n in parts)), [s for s, _ in parts]))
    placed = settled.union(line.where("hole = last").select("g1", "g2", _pick(F.col("hole"), order).alias("at")))
    if links is not None:
        placed = improve(save(placed.join(groups, CLASS).select(*CLASS, "members", "at"), "labels"), links, room).select(*CLASS, "at")
    placed = placed.withColumn("cut", F.lit(None).cast("int")).union(spark.createDataFrame(cuts, "g1 long, g2 long, at int, cut int"))
    return placed, spark.createDataFrame(split, "cut int, upto array<long>, to array<int>")


def class_links(links: DataFrame, base: DataFrame) -> DataFrame:
    """Links of documents (u, v, weight) as links of classes (g1, g2, h1, h2, weight), both ways, summed."""
    ids = base.where("doc_id is not null").select("doc_id", *CLASS).distinct()
    ends = links.join(ids.toDF("u", "g1", "g2"), "u").join(ids.toDF("v", "h1", "h2"), "v").where("g1 != h1 or g2 != h2")
    ends = ends.select(*CLASS, "h1", "h2", "weight")
    both = ends.union(ends.select("h1", "h2", *CLASS, "weight"))
    return both.groupBy(*CLASS, "h1", "h2").agg(F.sum("weight").alias("weight"))


def shard_rows(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", links: DataFrame | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row; law ``rows``.

    ``links`` (u, v, weight): further links between documents, by id, with whole positive weights (each link once, in any direction).
    """
    buckets = partitions(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    base = save(
        texts.select(
            "doc_id",
            (F.octet_length("text") + 16).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.xxhash64("text").alias("g1"),
            F.xxhash64(F.lit(1), "text").alias("g2"),
        ).withColumn("init", F.pmod(F.xxhash64("doc_id", "g2"), F.lit(shards)).cast("int")),
        "rows",
    )
    total = base.count()
    room = [total // shards + (s < total % shards) for s in range(shards)]
    votes = base.groupBy("g1", "g2", "init").agg(F.count("*").alias("n"))
    members = votes.groupBy("g1", "g2").agg(F.sum("n").alias("members"))
    if links is None:
        groups = save(members.where("members > 1"), "groups")
    else:
        wanted = links.select("u", "v", F.coalesce(F.col("weight").cast("long"), F.lit(0)).alias("weight")).where("weight > 0")
        links = save(class_links(wanted, base), "links")
        linked = links.select(*CLASS).distinct().withColumn("linked", F.lit(True))
        groups = save(members.join(linked, CLASS, "left").where("members > 1 or linked").drop("linked"), "groups")
    votes = save(votes.join(groups.select(*CLASS), CLASS, "left_semi"), "votes")
    placed, pieces = place_groups(groups, votes, links, room)
    by_id = F.pmod(F.xxhash64("doc_id", "g2"), F.lit(buckets)).cast("int")
    rows = base.join(placed, ["g1", "g2"], "left").select("doc_id", "size", "text_crc32", "init", "at", "cut", by_id.alias("bucket"))
    rows = save(rows, "placed")
    out = ["doc_id", "size", "text_crc32", "shard"]
    whole = rows.where("at is not null").withColumn("shard", F.col("at")).select(*out)
    parts = _numbered(rows.where("cut is not null"), "cut", "bucket", ["doc_id", "text_crc32"], "rank").join(F.broadcast(pieces), "cut")
    parts = parts.withColumn("shard", F.expr("element_at(to, size(filter(upto, x -> x <= rank)) + 1)")).select(*out)

    # Rows without links fill the rooms that are left.
    single = rows.where("at is null and cut is null")
    load = [0] * shards
    for r in single.groupBy("init").agg(F.count("*").alias("n")).collect():  # a row a shard
        load[r["init"]] = r["n"]
    over = [max(0, n - q) for n, q in zip(load, room, strict=True)]
    ends = list(accumulate(max(0, q - n) for n, q in zip(load, room, strict=True)))
    over_before = [0, *accumulate(over)][:-1]
    single = _numbered(single, "init", "bucket", ["doc_id", "text_crc32"], "rank")
    beyond = F.col("rank") - _pick(F.col("init"), room)
    single = single.withColumn("shard", F.when(beyond < 0, F.col("init")).otherwise(_hole(beyond + _pick(F.col("init"), over_before), ends)).cast("int"))
    ranked = whole.union(parts).union(single.select(*out))
    ranked = save(ranked.select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("part")), "shards")
    final = _numbered(ranked, "shard", "part", ["doc_id", "text_crc32"], "slot")
    return final.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
