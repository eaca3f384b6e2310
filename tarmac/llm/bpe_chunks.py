"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last ``WINDOW`` bytes cuts each text where the hash has its low
bits clear. The cuts follow the content, so copies and shared passages give the same
chunks wherever they stand, and a task encodes a chunk once. A chunk may begin or end
inside a word; its inner part, between its first and last white space, is encoded with
the chunk, and each join is repaired: the text on both sides of the cut is re-encoded from
white space to white space, taking in further chunks until both ends agree with what stands
beside them. White space ends a pre-token of the tokenizer, so the ids are exactly those of
the whole text. New chunks are encoded by their distinct white-space pieces, each once.

All caches are bounded in bytes (pieces in two generations, so frequent ones stay), live in the Python worker and serve its later tasks too; rows never
move between tasks.

Rules: NULL is the empty text and has no ids. Repeated rows give repeated results; a NULL
id is carried through.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm.common import id_and_text, map_slices

WINDOW = 8
#: White space that always ends a pre-token: space and 0x09-0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


#: Pre-tokens of lower-case ASCII text without apostrophes.
_ASCII = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")


_ENCODERS: dict = {}


def worker_encoder(tokenizer_json: str, mean_bytes: int) -> ChunkEncoder:
    """One encoder per Python worker: its caches serve all the tasks the worker runs."""
    key = (hash(tokenizer_json), mean_bytes)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ChunkEncoder(tokenizer_json, mean_bytes)
    return _ENCODERS[key]


def cut_points(data: np.ndarray, mean_bytes: int) -> np.ndarray:
    """Ends of the content-defined chunks of UTF-8 ``data`` (its length is the last)."""
    n = len(data)
    if n <= WINDOW:
        return np.array([n], np.int64)
    h = np.zeros(n - WINDOW + 1, np.uint32)
    for i in range(WINDOW):  # the hash of the window ending at each byte
        h = h * np.uint32(0x01000193) + data[i:n - WINDOW + 1 + i]
    ends = np.flatnonzero((h >> np.uint32(12)) % np.uint32(mean_bytes) == 0) + WINDOW
    ends = ends[ends < n]
    ends = ends[(data[ends] & 0xC0) != 0x80]  # never inside a character
    return np.append(ends, n)


class ChunkEncoder:
    """Encodes texts with one tokenizer, remembering chunks and white-space pieces.

    An encoded piece is (number of ids, ids as decimal text, decoded text).
    """

    def __init__(self, tokenizer_json: str, mean_bytes: int = 1024, max_chunk_bytes: int = 16 << 20, max_piece_bytes: int = 40 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.separator = max(((i, t.content) for i, t in added.items()), default=None)
        self.special = re.compile(b"|".join(re.escape(t.content.encode()) for t in added.values()) or b"(?!)")
        self._check_spaces()
        self.lower = self._lowers()
        self.mean_bytes, self.max_chunk_bytes = mean_bytes, max_chunk_bytes
        self.chunks: dict[bytes, tuple] = {}
        self.chunk_bytes = 0
        self.max_piece_bytes, self.piece_bytes = max_piece_bytes, 0
        self.pieces: dict[bytes, tuple[int, str, str]] = {}
        self.units: dict[bytes, tuple[int, str, str]] = {}
        self.older: tuple[dict, dict] = {}, {}  # pieces and units of the generation before
        self.met, self.made = 0, 0

    def _check_spaces(self) -> None:
        """White space must end a pre-token and have no ids of its own, and decoding must put one space between
        words: joins are repaired from white space to white space. Other tokenizers are refused."""
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        decode = lambda x: self.tokenizer.decode(x, skip_special_tokens=False)
        words = ["ab", "Zq", "7", "don't", "é", ".", "日本"]
        for space in map(chr, np.flatnonzero(_SPACE)):
            for a, b in zip(words, words[1:] + words[:1], strict=True):
                parts = ids(a), ids(b)
                whole = ids(f"{space}{a}{space}{space}{b}{space}")
                if whole != parts[0] + parts[1] or decode(whole) != " ".join(decode(x) for x in parts if x):
                    raise ValueError(f"white space {space!r} does not part the words of this tokenizer: chunks can't be joined exactly")

    def _lowers(self) -> bool:
        """Whether the tokenizer lower-cases A-Z and ends pre-tokens between ASCII letters,
        digits and other signs (then ASCII pieces may be taken apart there)."""
        same = self.tokenizer.encode("AbC,x1", add_special_tokens=False).ids
        return same == [i for u in ("abc", ",", "x", "1") for i in self.tokenizer.encode(u, add_special_tokens=False).ids]

    def _encoded(self, texts: list[bytes], ids: list[list[int]]) -> None:
        """Note the ids of units and their decoding, all in one call."""
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        self.units.update(zip(texts, [(len(x), " ".join(map(str, x)), d) for x, d in zip(ids, decoded, strict=True)], strict=True))

    def _recalled(self, wanted: set[bytes], known: dict, older: dict) -> set[bytes]:
        """What is in neither generation; what the older has goes on in the newer."""
        new = wanted.difference(known)  # looks each one up; the keys of a large dict are not walked
        back = {p for p in new if p in older} if older else set()
        for p in back:
            known[p] = older[p]
        self.piece_bytes += 400 * len(new) + 8 * sum(map(len, new))  # about what a piece takes with its ids and text
        return new - back if back else new

    def _encode_units(self, units: set[bytes]) -> None:
        """Encode short texts; many are encoded in one call, parted by a special token."""
        many, alone = [], []
        for u in self._recalled(units, self.units, self.older[1]):
            (alone if self.separator is None or self.special.search(u) else many).append(u)
        self._encoded(alone, [self.tokenizer.encode(u.decode(), add_special_tokens=False).ids for u in alone])
        groups = [many[i:i + 256] for i in range(0, len(many), 256)]
        for i in range(0, len(groups), 64):
            texts = [self.separator[1].encode().join(g).decode() for g in groups[i:i + 64]]
            for g, e in zip(groups[i:i + 64], self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids, at, lists = e.ids, 0, []
                for _ in g[:-1]:
                    end = ids.index(self.separator[0], at)
                    lists.append(ids[at:end])
                    at = end + 1
                self._encoded(g, [*lists, ids[at:]])

    def _need(self, wanted: set[bytes]) -> None:
        """Have the encodings of texts between white spaces, by their pre-tokens where these are plain."""
        new = self._recalled(wanted, self.pieces, self.older[0])
        if self.lower:  # letters alone are one unit
            plain = {p: (p if p.islower() else p.lower(),) if p.isalpha() else _ASCII.findall(p.lower()) if p.isascii() and b"'" not in p and b"<|" not in p else (p,) for p in new}
        else:
            plain = {p: (p,) for p in new}
        self._encode_units(set().union(*plain.values()))
        units, pieces = self.units, self.pieces
        for p, us in plain.items():
            pieces[p] = units[us[0]] if len(us) == 1 else self._joined([units[u] for u in us])

    @staticmethod
    def _joined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
        if not parts:
            return 0, "", ""
        n, ids, decoded = zip(*parts, strict=True)
        if not all(n):  # a text without ids leaves no space
            ids, decoded = [x for x in ids if x], [x for c, x in zip(n, decoded, strict=True) if c]
        return sum(n), " ".join(ids), " ".join(decoded)

    @staticmethod
    def _split(chunk: bytes) -> tuple[bytes, list[bytes], bytes, bool]:
        """(before the first white space, whole pieces, after the last white space, has any)."""
        words = chunk.split()
        ends = _SPACE[chunk[0]], _SPACE[chunk[-1]]
        if len(words) == 1 and not any(ends):
            return chunk, [], b"", False
        head = b"" if ends[0] or not words else words.pop(0)
        tail = b"" if ends[1] or not words else words.pop()
        return head, words, tail, True

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids as text, decoded text) of each text."""
        raw = [t.encode() for t in texts]
        data = b"".join(raw)
        bounds = np.cumsum([0, *map(len, raw)])
        whole = np.frombuffer(data, np.uint8)
        lists, new = [], set()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            cuts = cut_points(whole[a:b], self.mean_bytes) + a if b > a else []
            own, at = [], int(a)
            for c in map(int, cuts):
                own.append(data[at:c])
                at = c
            lists.append(own)
            self.met += len(own)
        if self.chunk_bytes > self.max_chunk_bytes:
            self.chunks, self.chunk_bytes = {}, 0
        if self.piece_bytes > self.max_piece_bytes:
            self.older = self.pieces, self.units
            self.pieces, self.units, self.piece_bytes = {}, {}, 0
        new = {c for own in lists for c in own if c not in self.chunks}
        self.made += len(new)
        split = {c: self._split(c) for c in new}
        pieces = self.pieces
        self._need(set().union(*[words for _, words, _, _ in split.values()]))
        for c, (head, words, tail, spaced) in split.items():
            self.chunks[c] = (head, self._joined(list(map(pieces.__getitem__, words))), tail, spaced)
            self.chunk_bytes += 3 * len(c)
        # Repair the joins: what lies between two white spaces around a cut is one piece.
        plans, joins = [], set()
        for own in lists:
            plan, open_ = [], []
            for c in own:
                head, inner, tail, spaced = self.chunks[c]
                open_.append(head)
                if spaced:  # agreement is reached at white space; else the piece goes on
                    plan += [b"".join(open_), inner]
                    open_ = [tail]
            plan.append(b"".join(open_))
            joins.update(p for p in plan if isinstance(p, bytes) and p)
            plans.append(plan)
        self._need(joins)
        return [self._joined([pieces[p] if isinstance(p, bytes) else p for p in plan if p]) for plan in plans]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", mean_bytes: int = 1024, texts: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row.

    ``ids`` are decimal ids joined by one space, ``decoded`` their decoding; ``texts=False``
    leaves both out. The tokenizer file is read on the driver and broadcast (a fixed file of
    a few MB).
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        table = docs.sparkSession.sparkContext.broadcast(f.read())

    def task():
        enc = worker_encoder(table.value, mean_bytes)

        def each(part: pa.RecordBatch) -> dict:
            got = enc.encode(part.column("text").to_pylist())
            out = {
                "doc_id": part.column("doc_id"),
                "n_tokens": pa.array([g[0] for g in got], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(g[2].encode()).hexdigest() for g in got], pa.string()),
            }
            if texts:
                out |= {"ids": pa.array([g[1] for g in got], pa.string()), "decoded": pa.array([g[2] for g in got], pa.string())}
            return out

        return each

    base = id_and_text(docs, id_col, text_col)
    schema = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_slices(base, schema + (", ids string, decoded string" if texts else ""), task)
