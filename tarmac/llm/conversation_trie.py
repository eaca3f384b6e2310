"""The trie of conversation prefixes, by range shards of padded turn-id matrices.

A turn is the 128-bit digest of its role and text; a conversation is the sequence of its
turns. A node is a distinct prefix of some conversation, the empty one included.

1. Conversations are put in the order of (turn sequence, id) by a range partitioning, so
   the members of a node stand together, and a very common conversation is split by id.
2. Each shard numbers its turns and lays its conversations out as a matrix padded with -1,
   ``WIDTH`` turns at a time (only longer conversations take part further on). A lexsort
   orders the rows; masks of where a column differs from the row above are OR-accumulated
   along the row and mark where nodes start; reduceat gives members, least ids, children
   and the sums of subtrees, a depth at a time.
3. Only nodes on the path of a shard's first or last conversation can go on in other shards.
   They are handed out as partial sums and recombined: their number is at most twice the
   shards times the length of those conversations, whatever the input. All other nodes
   are finished in their shard. The ids that end at a shared node are hashed as a stream of
   bounded pieces, in order.

Rules: turns are ordered by their number (NULL first), equal numbers by the digest; repeated
rows are repeated turns. A NULL role or text is empty. Rows without a conversation id belong
to no conversation. An empty table has no nodes. Only the named columns are read, so the names
of others do not matter. Texts stay where they are: 16 bytes and the length of a turn are what
moves, whatever the texts' size; the turns of one conversation are held in one row (24 bytes each).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import partitions, save

#: Columns of a padded matrix.
WIDTH = 32
#: Turns that a shard is planned for, and ids in one piece of a stream to hash.
SHARD_TURNS = 1 << 20
PIECE_IDS = 2000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: kind 0: a finished node; 1: a partial sum of a shared node; 2: a piece of the ids that end there.
PART = f"kind int, node binary, parent binary, {NODE}, last_bytes long, ids binary"


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<turn, m, size>>): hex digest and UTF-8 bytes of each turn, in order."""
    role, text = F.coalesce(turns[role_col], F.lit("")), F.coalesce(turns[text_col], F.lit(""))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    one = F.struct(turns[turn_col].alias("turn"), digest.alias("m"), F.octet_length(text).cast("long").alias("size"))
    return turns.where(turns[conv_col].isNotNull()).groupBy(turns[conv_col].alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def with_shared_heads(each: DataFrame, group: int = 5, modulus: int = 9) -> DataFrame:
    """Every conversation c begins with the first h turns of conversation c - c % group (h: crc32 of
    c's decimal digits, modulo ``modulus``), then its own turns after its first h."""
    heads = each.select(F.col("conv_id").alias("head_of"), F.slice("turns", 1, modulus - 1).alias("head"))
    own = each.withColumn("head_of", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % modulus).cast("int"))
    joined = own.join(heads, "head_of", "left")
    head = F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(turns, 1, 0)"))
    return joined.select("conv_id", F.concat(head, F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


class Shard:
    """The nodes of one shard's conversations, by depth."""

    def __init__(self, conv: np.ndarray, paths: list[bytes], sizes: np.ndarray):
        self.conv = conv
        self.lengths = np.array([len(p) // 16 for p in paths], np.int64)
        halves = np.frombuffer(b"".join(paths), ">u8").astype(np.uint64).reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
        self.turn = np.empty(len(order), np.int64)  # the number of each turn, in the order of the digests
        self.turn[order] = np.cumsum(new) - 1
        self.size_of = np.zeros(int(new.sum()), np.int64)
        self.size_of[self.turn] = sizes
        self.offset = np.cumsum(np.append(0, self.lengths))[:-1]
        self.first, self.last = min(paths), max(paths)
        self.levels = [self._level(np.zeros(len(conv), np.int64), np.zeros(1, np.int64), np.full(1, -1), np.zeros(1, np.int64), conv, np.sort(conv[self.lengths == 0]), np.zeros(int((self.lengths == 0).sum()), np.int64))]
        self._split()

    @staticmethod
    def _level(number, firsts, parent, size, conv, ends, ends_of) -> dict:
        return {
            "n": np.bincount(number, minlength=len(firsts)), "conv": np.minimum.reduceat(conv, firsts), "parent": parent,
            "size": size, "ends": ends, "end_at": np.searchsorted(ends_of, np.arange(len(firsts) + 1)),
        }

    def _split(self) -> None:
        """Nodes of every depth, from padded matrices of WIDTH turns."""
        base, rows = 0, np.flatnonzero(self.lengths > 0)
        top = np.zeros(len(rows), np.int64)
        while len(rows):
            left = self.lengths[rows] - base
            width = int(min(WIDTH, left.max()))
            matrix = np.full((len(rows), width), -1, np.int64)
            filled = np.arange(width) < left[:, None]
            matrix[filled] = self.turn[((self.offset[rows] + base)[:, None] + np.arange(width))[filled]]
            order = np.lexsort((self.conv[rows], *matrix.T[::-1], top))
            rows, top, matrix, left = rows[order], top[order], matrix[order], left[order]
            change = np.ones((len(rows), width + 1), bool)
            change[1:, 0] = top[1:] != top[:-1]
            change[1:, 1:] = matrix[1:] != matrix[:-1]
            starts = np.logical_or.accumulate(change, axis=1)
            number = top
            for j in range(width):
                here = np.flatnonzero(matrix[:, j] >= 0)
                new = starts[here, j + 1]
                firsts = np.flatnonzero(new)
                below = np.cumsum(new) - 1
                leads = here[firsts]
                ends = left[here] == j + 1
                self.levels.append(self._level(below, firsts, number[leads], self.size_of[matrix[leads, j]], self.conv[rows[here]], self.conv[rows[here[ends]]], below[ends]))
                number = number.copy()
                number[here] = below
            deeper = left > width
            rows, top, base = rows[deeper], number[deeper], base + width

    def nodes(self):
        """The parts of this shard as arrays (columns of PART), a depth at a time, deepest first."""
        reach = len(self.first) // 16, len(self.last) // 16
        leaves = saved = children = None  # of the depth below, by parent
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            k = len(level["n"])
            open_ = np.zeros(k, bool)
            if depth <= reach[0]:
                open_[0] = True
            if depth <= reach[1]:
                open_[-1] = True
            kids = np.zeros(k, np.int64) if children is None else children
            own_leaf = (kids == 0) & (level["end_at"][1:] > level["end_at"][:-1])  # a childless node always has ends
            total_leaves = np.where(open_, 0, own_leaf) + (0 if leaves is None else leaves)
            total_saved = np.where(open_, 0, (level["n"] - 1) * level["size"]) + (0 if saved is None else saved)
            closed_kids = kids if children is None else closed
            yield depth, level, open_, np.where(open_, closed_kids, kids), total_leaves, total_saved
            if depth:
                up = level["parent"]
                firsts = np.flatnonzero(np.append(True, up[1:] != up[:-1]))
                width = len(self.levels[depth - 1]["n"])

                def gathered(x, firsts=firsts, up=up, width=width):
                    out = np.zeros(width, np.int64)
                    out[up[firsts]] = np.add.reduceat(x.astype(np.int64), firsts)
                    return out

                children, closed = gathered(np.ones(k, np.int64)), gathered(~open_)
                leaves, saved = gathered(total_leaves), gathered(total_saved)


def _keys(path: bytes) -> list[bytes]:
    """Digest of every prefix of a path, the empty one first."""
    h, out = hashlib.md5(b"", usedforsecurity=False), []
    out.append(h.digest())
    for at in range(0, len(path), 16):
        h.update(path[at:at + 16])
        out.append(h.copy().digest())
    return out


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _shards(batches):
    """Parts of the nodes of one range shard."""
    tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.concat_tables(tables).combine_chunks()
    sizes = table.column("sizes").combine_chunks().flatten() if table.num_rows else None
    shard = Shard(np.asarray(table.column("conv_id")).astype(np.int64), [p or b"" for p in table.column("path").to_pylist()], np.asarray(sizes).astype(np.int64))
    first, last = _keys(shard.first), _keys(shard.last)
    names = [f.split()[0] for f in PART.split(", ")]
    kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.int64(), pa.binary()]

    def rows(n: int, **cols) -> pa.RecordBatch:
        arrays = [cols[c] if isinstance(cols.get(c), pa.Array) else pa.array(cols.get(c, [None] * n), t) for c, t in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for depth, level, open_, kids, leaves, saved in shard.nodes():
        k = len(open_)
        key = lambda i, d=depth, k=k: first[d] if i == 0 and d < len(first) else last[d]
        above = None
        if depth:
            parent = level["parent"]
            width = len(shard.levels[depth - 1]["n"])
            above = np.zeros(width, bool)
            above[0] |= depth - 1 < len(first)
            above[-1] |= depth - 1 < len(last)
        done = np.flatnonzero(~open_)
        for at in range(0, len(done), 4096):
            part = done[at:at + 4096]
            open_parent = above[parent[part]]
            ends = [hashlib.sha256(_joined(level["ends"][level["end_at"][i]:level["end_at"][i + 1]])).hexdigest() for i in part.tolist()]
            up = [(first[depth - 1] if p == 0 and depth - 1 < len(first) else last[depth - 1]) if o else None for p, o in zip(parent[part].tolist(), open_parent.tolist(), strict=True)]
            yield rows(
                len(part), kind=[0] * len(part), parent=up, conv_id=pa.array(level["conv"][part]), depth=[depth] * len(part),
                parent_conv_id=pa.array(shard.levels[depth - 1]["conv"][parent[part]], mask=open_parent), n_convs=pa.array(level["n"][part].astype(np.int64)),
                n_children=pa.array(kids[part]), n_leaves=pa.array(leaves[part].astype(np.int64)), saved_tokens=pa.array(saved[part]), ends_sha256=ends,
            )
        for i in np.flatnonzero(open_).tolist():
            up = None if not depth else first[depth - 1] if parent[i] == 0 and depth - 1 < len(first) else last[depth - 1]
            yield rows(1, kind=[1], node=[key(i)], parent=[up], conv_id=[int(level["conv"][i])], depth=[depth], n_convs=[int(level["n"][i])], n_children=[int(kids[i])], n_leaves=[int(leaves[i])], saved_tokens=[int(saved[i])], last_bytes=[int(level["size"][i])])
            ids = level["ends"][level["end_at"][i]:level["end_at"][i + 1]]
            for at in range(0, len(ids), PIECE_IDS):
                piece = ids[at:at + PIECE_IDS]
                yield rows(1, kind=[2], node=[key(i)], conv_id=[int(piece[0])], ids=[_joined(piece)])


def _stream_hash(batches):
    """SHA-256 of the pieces of each node, in order; a piece is held at a time."""
    key, h = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    out.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256(ids)
            else:
                h.update(b"," + ids)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["node", "hash"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()], pa.string())], names=["node", "hash"])


def _recombined(batches):
    """Shared nodes (one row each): parents' ids, and sums over the shared nodes below them."""
    tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not tables:
        return
    t = pa.concat_tables(tables)
    keys, ups = t.column("node").to_pylist(), t.column("parent").to_pylist()
    depth, conv, n, kids, leaves, saved, size = (np.asarray(t.column(c)).astype(np.int64) for c in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "last_bytes"))
    place = {k: i for i, k in enumerate(keys)}
    up = np.array([place[u] if u is not None else -1 for u in ups], np.int64)
    inner = up >= 0
    kids = kids + np.bincount(up[inner], minlength=len(keys))
    below_leaves, below_saved = (kids == 0).astype(np.int64), (n - 1) * size
    order = np.argsort(-depth, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        if depth[part[0]]:
            np.add.at(below_leaves, up[part], below_leaves[part])
            np.add.at(below_saved, up[part], below_saved[part])
    cols = {
        "node": pa.array(keys, pa.binary()), "conv_id": conv, "depth": depth, "parent_conv_id": pa.array(conv[np.maximum(up, 0)], mask=~inner),
        "n_convs": n, "n_children": kids, "n_leaves": leaves + below_leaves, "saved_tokens": saved + below_saved,
    }
    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols.values()], names=list(cols))


def prefix_trie(each: DataFrame) -> DataFrame:
    """One row per node of the trie of ``each`` (conv_id, turns as made by ``conversations``):
    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless nodes
    in the subtree), saved_tokens (over the subtree, (members - 1) times bytes of the last
    text), ends_sha256 (of the ids of the members that end there)."""
    spark = each.sparkSession
    rows = save(each.select(F.col("conv_id").cast("long").alias("conv_id"), F.unhex(F.array_join(F.transform("turns", lambda t: t["m"]), "")).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "sequences")
    turns = rows.agg(F.sum(F.size("sizes"))).first()[0] or 0
    shards = max(partitions(spark), -(-turns // SHARD_TURNS))
    parts = save(rows.repartitionByRange(shards, "path", "conv_id").mapInArrow(_shards, PART), "trie_parts")

    shared = parts.where("kind = 1").groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.first("last_bytes").alias("last_bytes"))
    whole = shared.repartition(1).mapInArrow(_recombined, "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    whole = save(whole, "trie_shared")
    pieces = parts.where("kind = 2").select("node", "conv_id", "ids").repartition(partitions(spark), "node").sortWithinPartitions("node", "conv_id")
    hashes = pieces.mapInArrow(_stream_hash, "node binary, hash string")
    columns = [f.split()[0] for f in NODE.split(", ")]
    shared_rows = whole.join(hashes, "node", "left").withColumn("ends_sha256", F.coalesce("hash", F.sha2(F.lit("").cast("binary"), 256))).select(*columns)
    done = parts.where("kind = 0")
    inner = done.where("parent is null").select(*columns)
    up = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("up"))
    edge = done.where("parent is not null").join(up, "parent").withColumn("parent_conv_id", F.col("up")).select(*columns)
    return inner.unionByName(edge).unionByName(shared_rows)
