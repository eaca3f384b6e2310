"""Language-model scores: exact counts, a proper distribution, gradients, and held-out gain."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from tarmac.llm import lm_scoring as lm
from tarmac.llm.gru import Gru
from tarmac.llm.queries import table
from tests.conftest import SF_ORACLE
from tests.llm.brute import ASCII_LOWER, WORD


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER)) + [""]


def plain(rows):
    """(id, text) -> contract's exact columns."""
    out = lambda d: d is None or zlib.crc32(str(d).encode()) % 10 == 0
    c = Counter(w for d, t in rows if not out(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    for d, t in rows:
        w = words(t)
        yield d, out(d), len(w), sum(c[x] > 0 for x in w), n, sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)


@pytest.mark.parametrize(("model_words", "kept"), [(50, 80), (10, 10), (4095, 1 << 18)])
def test_exact_columns(awkward, model_words, kept):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    got = lm.lm_scores(awkward, model_words=model_words, kept_words=kept, fit_docs=40, fit_tokens=500, rounds=1).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    assert len(got) == len(rows)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(plain(rows), key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and np.isfinite(a[6]) and a[6] < 0


def test_untrained_model_is_the_word_counts(clean):
    """Without rounds the model starts at the counts, so both scores agree: one distribution over all words."""
    for r in lm.lm_scores(clean, model_words=30, kept_words=60, rounds=0).collect():
        assert r["score"] == pytest.approx(r["base_score"], rel=1e-4, abs=1e-3)


def test_nothing(nothing, ready):
    assert lm.lm_scores(nothing).count() == 0
    held = next(d for d in range(99) if zlib.crc32(str(d).encode()) % 10 == 0)
    one = lm.lm_scores(ready.createDataFrame([(held, "never learnt")], "doc_id long, text string")).first()
    assert one["train_tokens"] == 0 and one["n_known"] == 0 and one["base_score"] == pytest.approx(0) and one["score"] == pytest.approx(0, abs=1e-6)


def test_held_out_gain(ready):
    """On the given documents the model beats the word counts on nearly every held-out document."""
    got = lm.lm_scores(table(ready, SF_ORACLE, "documents"), rounds=2).where("held_out and n_tokens > 50").collect()
    assert sum(r["score"] for r in got) > 0.97 * sum(r["base_score"] for r in got)
    assert sum(r["score"] > r["base_score"] for r in got) >= 0.9 * len(got)


def test_every_training_row_is_learnt_from(ready):
    """All tokens of all rows reach the training, however small the shards are planned; few shards learn in every round."""
    sizes = [40 + d % 7 for d in range(120)]
    numbers = ready.createDataFrame([(d, [k % 5 for k in range(n)]) for d, n in enumerate(sizes)], "doc_id long, ids array<int>")
    for (fit_docs, fit_tokens, shards, rounds), passes in (((10, 100, 2, 3), 1), ((500, 10_000, 2, 3), 3), ((500, 10_000, 2, 0), 0)):
        seen = ready.sparkContext.accumulator(0)

        class Held:
            class value:  # stands for the vocabulary
                @staticmethod
                def model():
                    model = Gru(np.array([9.0, 8, 7, 6, 5]), 0, hidden=2, classes=2)
                    model.learn = lambda texts, width: seen.add(sum(map(len, texts)))
                    return model

        lm.fit(numbers, Held, fit_docs, fit_tokens, shards, rounds)
        assert seen.value == passes * sum(sizes)


def test_many_shards_learn_as_often_as_few(ready, monkeypatch):
    """The rows to learn from are learnt from in as many passes as there are rounds, whether they fill two shards or fifty."""
    docs = ready.createDataFrame([(d, "word " * (40 + d % 7)) for d in range(120)], "doc_id long, text string")
    tokens = sum(41 + d % 7 for d in range(120) if zlib.crc32(str(d).encode()) % 10)
    fit = lm.fit
    for fit_docs, fit_tokens in ((10, 100), (20, 10_000), (500, 10_000)):
        seen = ready.sparkContext.accumulator(0)

        class Held:
            class value:  # stands for the vocabulary
                @staticmethod
                def model(seen=seen):
                    model = Gru(np.array([9.0, 8, 7]), 0, hidden=2, classes=2)
                    model.learn = lambda texts, width: seen.add(sum(map(len, texts)))
                    return model

        def counted(numbers, words, *a, held=Held, **k):
            fit(numbers, held, *a, **k)
            return words.value.model().dump()

        monkeypatch.setattr(lm, "fit", counted)
        assert lm.lm_scores(docs, fit_docs=fit_docs, fit_tokens=fit_tokens, shards=2, rounds=3).count() == 120
        assert seen.value == 3 * tokens


def test_weights_in_pieces():
    a, b = (Gru(np.array([9.0, 8, 7, 6, 5]), 0, hidden=3, classes=2, seed=s) for s in (1, 2))
    b.take(a.parts(7))
    for x, y in ((a.p, b.p), (a.squares, b.squares)):
        assert all(np.array_equal(x[k], y[k]) for k in x)


@pytest.fixture
def small():
    counts = np.array([9, 7, 5, 4, 3, 2, 2, 1, 1, 1], float)
    model = Gru(counts, 0, hidden=5, classes=3)
    rng = np.random.default_rng(4)
    for name in model.p:
        model.p[name] = (model.p[name] + rng.normal(0, 0.3, model.p[name].shape)).astype(np.float64)
    return model, [rng.integers(0, 10, n) for n in (70, 3, 1, 0, 41, 2)]


def test_probabilities_sum_to_one(small):
    model, texts = small
    prefix = texts[4][:6]
    total = sum(10 ** (model.score([np.append(prefix, w)])[0] - model.score([prefix])[0]) for w in range(10))
    assert total == pytest.approx(1, abs=1e-5)


def test_lanes_and_windows_do_not_matter(small):
    """State is carried over windows, and texts beside or before a text do not change its score."""
    model, texts = small
    alone = np.array([model.score([t])[0] for t in texts])
    for width in (1, 2, 64):
        np.testing.assert_allclose(model.score(texts, width), alone, rtol=1e-5)
    assert alone[3] == 0


def test_long_text_is_read_in_few_passes(small, monkeypatch):
    """Where few lanes are left, a pass over the classes takes more steps of them."""
    model, texts = small
    texts = [*texts, np.arange(2000) % 10]
    alone = [model.score([t])[0] for t in texts]
    passes, plain = [], model.log_probs
    monkeypatch.setattr(model, "log_probs", lambda h, word: passes.append(len(word)) or plain(h, word))
    np.testing.assert_allclose(model.score(texts, 16), alone, rtol=1e-5)
    assert sum(passes) == sum(map(len, texts)) and len(passes) <= 8


@pytest.mark.parametrize("factor", [1, 40, 4000])
def test_large_weights(small, factor):
    """Logits and gates beyond the range of the exponential: probabilities as by plain sums."""
    model, texts = small
    model.p = {name: v * factor for name, v in model.p.items()}
    k, p, begin = model.hidden, model.p, 0

    def log_softmax(x):
        return x - x.max() - np.log(np.exp(x - x.max()).sum())

    for text in texts[:3]:
        h, before, total = np.zeros(k), begin, 0.0
        for word in text:
            given, a = p["x"][before] + p["b"], h @ p["u"]
            z, r = np.split(0.5 * np.tanh(0.5 * (given + a)[:2 * k]) + 0.5, 2)
            new = np.tanh(given[2 * k:] + r * a[2 * k:])
            h, before, own = new + z * (h - new), word, model.of_class[word]
            lo, hi = model.bounds[own], model.bounds[own + 1]
            total += log_softmax(h @ p["wc"] + p["bc"])[own] + log_softmax(p["wo"][lo:hi] @ h + p["bo"][lo:hi])[word - lo]
        assert model.score([text])[0] == pytest.approx(total / np.log(10), rel=1e-4)


def test_gradient(small, monkeypatch):
    """Backpropagation against finite differences, over a window of two lanes with a new text in it."""
    model, _ = small
    before, word = np.array([[0, 0], [3, 2], [0, 5]]), np.array([[3, 2], [4, 5], [1, -1]])
    keep = np.array([[0, 0], [1, 1], [0, 1]], np.float64)
    h = np.zeros((2, 5))
    found = {}
    monkeypatch.setattr(model, "_step", lambda name, g, rate, at=slice(None): found.setdefault(name, []).append((at, g)))
    model._window(before, word, keep, h, 0.0)

    def loss():
        s = model.states(before, keep, h).astype(np.float64)
        return -model.log_probs(s[word >= 0], word[word >= 0]).sum() / 2

    for name in model.p:
        full = np.zeros_like(model.p[name])
        for at, g in found[name]:
            full[at] += g
        for place in list(np.ndindex(full.shape))[::7]:
            old, eps = model.p[name][place], 1e-3
            model.p[name][place] = old + eps
            up = loss()
            model.p[name][place] = old - eps
            down = loss()
            model.p[name][place] = old
            assert full[place] == pytest.approx((up - down) / (2 * eps), abs=2e-4), (name, place)
