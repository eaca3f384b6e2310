"""Phrase mining against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import phrases as ph
from tarmac.llm.words import LONG_WORD, byte_classes, cut_words
from tests.llm.brute import ASCII_LOWER


def plain(rows, least, top):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in cand.items():
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= 80 * a for b in longer):
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return out


@pytest.fixture(scope="module")
def rows(ready):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(40)] + ["Ünï", "日本", "x" * (LONG_WORD + 3)]
    out = []
    for i in range(300):
        words = [rng.choice(vocab[:rng.choice((4, 12, len(vocab)))]) for _ in range(rng.randrange(60))]
        for k in range(0, len(words), 7):
            words[k] = rng.choice(["New York City hall", "of the", "of the same", "hot", "a.b", "c,", "\t", "\n", "d!"])
        out.append((i, " ".join(words), rng.choice(["en", "de", None, "und", ""])))
    out += [(400, "hot pair " * 400, "en"), (401, None, "en"), (402, "", None), (403, " \t. ,\n", "zz"), out[0], (None, "hot pair of", None)]
    return out


@pytest.mark.parametrize(("least", "top", "shards"), [(3, 2000, 5), (2, 7, 1), (30, 2000, 3)])
def test_phrases(ready, rows, least, top, shards, monkeypatch):
    monkeypatch.setattr(ph, "partitions", lambda spark: shards)
    df = ready.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, score int, w string").repartition(4)
    got = ph.phrases(df, least, top).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == plain(rows, least, top)


def test_nothing(ready):
    assert ph.phrases(ready.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert ph.phrases(ready.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")).count() == 0


@pytest.mark.parametrize("least", [1, 2, 9])
def test_quicksort_counts(least):
    rng = np.random.default_rng(least)
    words = rng.integers(1, 5, (500, 4)).astype(np.uint64)
    words[rng.random(500) < 0.3, 3] = 0
    words[:90, 2:] = 0
    count = rng.integers(1, 4, 500)
    want = [Counter() for _ in range(4)]
    for w, c in zip(words.tolist(), count.tolist(), strict=True):
        for d in range(1, 5):
            if w[d - 1]:
                want[d - 1][tuple(w[:d])] += c
    for d, (rows, sizes) in enumerate(ph.quicksort_counts(words, count, least), 1):
        assert {tuple(words[r, :d].tolist()): int(n) for r, n in zip(rows, sizes, strict=True)} == {w: n for w, n in want[d - 1].items() if n >= least}


def test_words_of_slices():
    texts = ["", "A bc", "  ", "d.e\tf\n", "é" * 300 + " z", "bc", "x"]
    w = cut_words(pa.array(texts), byte_classes(b" \t", b".\n"))
    assert [(int(r), w.text(i).decode()) for i, r in enumerate(w.row)] == [(1, "a"), (1, "bc"), (3, "d"), (3, "e"), (3, "f"), (4, "é" * 300), (4, "z"), (5, "bc"), (6, "x")]
    assert w.hash[1] == w.hash[7] and len(set(w.hash.tolist())) == 8
    assert (w.piece[2] != w.piece[3]) and (w.piece[3] == w.piece[4]) and w.piece[6] != w.piece[7]
    assert len(cut_words(pa.array([], pa.string()), byte_classes(b" ")).row) == 0


def test_saved_suffixes_hold_nothing_derived(ready, rows):
    """A suffix is its words and its number: where it goes follows from them and is not written."""
    docs = ready.createDataFrame(rows, "doc_id long, text string, lang string")
    miner = ph.Miner(docs, "text", "lang", 3)
    none = ready.sparkContext.broadcast(np.zeros(0, np.uint64))
    assert miner.suffixes(none, none).columns == ["w1", "w2", "w3", "w4", "c", "heavy", "lang", "word"]
