"""Steps that handle a slice of documents at once, against the same per document."""

from __future__ import annotations

import numpy as np

from tarmac.llm import bpe_chunks, ngram_join
from tarmac.llm.common import mix


def test_prefixes_and_digests_of_many_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64)) for n in (0, 1, 2, 7, 300, 0, 41)]
    blooms = [rng.integers(0, 1 << 63, 64).astype(np.uint64) for _ in range(2)]
    for filters in ([], blooms[:1], blooms):
        for s, got in zip(sets, ngram_join.prefixes_of(sets, filters, 80), strict=True):
            known = sum((ngram_join.in_bloom(b, s).astype(int) for b in filters), np.zeros(len(s), int))
            size = len(s) - (80 * len(s) + 99) // 100 + 1 if len(s) else 0
            assert got.tolist() == s[np.lexsort((mix(s), known))][:size].tolist()
    k = 0xD6E8FEB86659FD93
    assert ngram_join.digests(sets, k).to_pylist() == [int(np.bitwise_xor.reduce(mix(s * np.uint64(k))).view(np.int64)) if len(s) else 0 for s in sets]
    assert ngram_join.digests([], k).to_pylist() == [] and ngram_join.prefixes_of([], [], 80) == []


def test_shared_counts_of_a_block():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 1, 40, 3000, 9000)]
    for block in (sets, sets[:1], []):
        for tokens in (*sets, np.arange(9000, dtype=np.uint64)):
            got = ngram_join.shared_counts(ngram_join.owners(block), tokens, len(block))
            assert got.tolist() == [len(np.intersect1d(s, tokens)) for s in block]


def test_known_pieces_are_looked_up_not_walked():
    class Walked(dict):
        def keys(self):
            raise AssertionError("all known pieces are walked")

    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        enc = bpe_chunks.ChunkEncoder(f.read())
    enc.pieces, enc.units, enc.older = Walked(), Walked(), (Walked(), Walked())
    for text in ("It's a Test, <|endoftext|> 12 don't", "A test again 日本 x1"):
        ids = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.encode([text]) == [(len(ids), " ".join(map(str, ids)), enc.tokenizer.decode(ids, skip_special_tokens=False))]
