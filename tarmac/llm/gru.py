"""A small gated recurrent language model in numpy.

The next word's probability is that of its class times that of the word in its class, both
from the state. Words are numbered by falling count, and classes are runs of equal shares of the
square roots of the counts, so a step costs about the square root of the vocabulary. Before training the
output weights are 0 and the biases the logarithms of the counts: the model begins as the unigram model.

Texts are dealt to lanes that are read side by side; a lane goes on with its next text
where one ends, and the state starts anew there. Within a text it is carried from window to
window, however long the text is.
"""

from __future__ import annotations

import heapq
import io

import numpy as np

WINDOW = 32


def _sigmoid(x: np.ndarray) -> None:
    """In place; by the exponential, which numpy takes several times faster than the hyperbolic tangent."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.divide(1, x, out=x)


def _tanh(x: np.ndarray) -> None:
    """In place."""
    x *= 2
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1


def _small(weights: np.ndarray) -> bool:
    """Whether no state (all its values within -1 to 1, then a 1) makes a logit that needs a shift before
    the exponential."""
    return bool(np.abs(weights).sum(axis=1).max() < 64)


def _exp(x: np.ndarray, small: bool) -> np.ndarray:
    """Exponential of each column in place, up to a common factor of the column; its sums."""
    if not small:
        x -= x.max(axis=0)
    np.exp(x, out=x)
    return np.ones(len(x), x.dtype) @ x


def _softmax(x: np.ndarray, small: bool) -> np.ndarray:
    """Softmax of each column, in place."""
    x /= _exp(x, small)
    return x


def _log_prob(x: np.ndarray, at: np.ndarray, small: bool) -> np.ndarray:
    """Logarithm of the softmax of each column at one place; ``x`` is overwritten."""
    if not small:
        x -= x.max(axis=0)
    own = x[at, np.arange(len(at))].astype(np.float64)
    return own - np.log(_exp(x, True))


class Lanes:
    """Texts (arrays of word numbers, in order) dealt to ``width`` lanes, the longest lane first.

    ``at(a, b)`` gives steps a to b of all lanes that reach that far: word before, word, text, and 0
    where a text begins.
    """

    def __init__(self, texts: list[np.ndarray], width: int, begin: int):
        width = max(1, min(width, len(texts)))
        heap = [(0, k) for k in range(width)]
        own: list[list[int]] = [[] for _ in range(width)]
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
            n, k = heapq.heappop(heap)
            own[k].append(i)
            heapq.heappush(heap, (n + len(texts[i]), k))
        lanes = sorted((x for x in own if x), key=lambda x: -sum(len(texts[i]) for i in x))
        order = [i for x in lanes for i in x]
        sizes = np.array([len(texts[i]) for i in order], np.int64)
        self.lengths = np.array([sum(len(texts[i]) for i in x) for x in lanes], np.int64)
        self.word = np.concatenate([*[texts[i] for i in order], np.full(1, -1)]).astype(np.int32)  # lane by lane
        self.text = np.append(np.repeat(order, sizes), -1).astype(np.int32)
        first = np.cumsum(sizes)[sizes > 0] - sizes[sizes > 0]
        self.before = np.append(np.int32(begin), self.word[:-1])
        self.before[first] = begin
        self.keep = np.ones(len(self.word), np.float32)
        self.keep[first] = 0
        self.first = np.cumsum(self.lengths) - self.lengths
        self.steps = int(self.lengths.max(initial=0))

    def at(self, a: int, b: int):
        live = int((self.lengths > a).sum())
        step = np.arange(a, b)[:, None]
        place = np.where(step < self.lengths[:live], self.first[:live] + step, len(self.word) - 1)
        return self.before[place], self.word[place], self.text[place], self.keep[place]


class Gru:
    """``counts``: how often each word of the model occurs, falling; ``begin``: the word that stands
    before a text."""

    def __init__(self, counts: np.ndarray, begin: int, hidden: int = 16, classes: int = 64, seed: int = 11):
        self.counts, self.begin, self.hidden = np.maximum(np.asarray(counts, np.float64), 1e-9), begin, hidden
        mass = np.cumsum(np.sqrt(self.counts))
        share = np.minimum(((mass - np.sqrt(self.counts)) / mass[-1] * classes).astype(np.int64), classes - 1)
        _, self.of_class = np.unique(share, return_inverse=True)
        self.of_class = self.of_class.astype(np.min_scalar_type(classes))
        n = int(self.of_class[-1]) + 1
        self.bounds = np.searchsorted(self.of_class, np.arange(n + 1))
        in_class = np.add.reduceat(self.counts, self.bounds[:-1])
        rng, k, h = np.random.default_rng(seed), len(self.counts), hidden
        self.p = {
            "x": rng.normal(0, 0.1, (k, 3 * h)), "u": rng.normal(0, h ** -0.5, (h, 3 * h)), "b": np.repeat([1.0, 0, 0], h),
            "wc": np.zeros((h, n)), "bc": np.log(in_class / in_class.sum()),
            "wo": np.zeros((k, h)), "bo": np.log(self.counts / in_class[self.of_class]),
        }
        self.p = {name: v.astype(np.float32) for name, v in self.p.items()}
        self.squares = {name: np.full_like(v, 1e-3) for name, v in self.p.items()}

    # --- weights as bytes, and in pieces

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p, **{f"squares_{k}": v for k, v in self.squares.items()})
        return out.getvalue()

    def load(self, dump: bytes) -> None:
        got = np.load(io.BytesIO(dump))
        for name in self.p:
            self.p[name], self.squares[name] = got[name], got[f"squares_{name}"]

    def parts(self, n: int) -> list[np.ndarray]:
        """All weights as ``n`` pieces of one vector."""
        return np.array_split(np.concatenate([v.ravel() for v in (*self.p.values(), *self.squares.values())]), n)

    def take(self, parts: list[np.ndarray]) -> None:
        """Take the weights from the pieces."""
        whole, at = np.concatenate(parts), 0
        for held in (self.p, self.squares):
            for name, v in held.items():
                held[name] = whole[at:at + v.size].reshape(v.shape).copy()
                at += v.size

    # --- reading

    @np.errstate(over="ignore")  # of a gate that is shut
    def states(self, before: np.ndarray, keep: np.ndarray, h: np.ndarray, record: list | None = None) -> np.ndarray:
        """State after each step (steps, lanes, hidden); ``record`` gets what training needs.

        Inside, lanes are the last axis, so that every gate of a step lies in one stretch."""
        k, u = self.hidden, np.ascontiguousarray(self.p["u"].T)
        steps, lanes = before.shape
        given = np.empty((steps, 3 * k, lanes), u.dtype)
        np.add(self.p["x"][before].transpose(0, 2, 1), self.p["b"][:, None], out=given)
        out, old, inner = np.empty((steps, k, lanes), u.dtype), [], []
        going_on = keep.all(axis=1)
        h = np.ascontiguousarray(h.T)
        for t in range(steps):
            if not going_on[t]:
                h = h * keep[t]
            a = u @ h
            gates, new, state = given[t, :2 * k], given[t, 2 * k:], out[t]
            gates += a[:2 * k]
            _sigmoid(gates)
            new += gates[k:] * a[2 * k:]
            _tanh(new)
            if record is not None:
                old.append(h)
                inner.append(a[2 * k:])
            np.subtract(h, new, out=state)
            state *= gates[:k]
            state += new
            h = state
        if record is not None:
            record += [np.stack(old), given[:, :k], given[:, k:2 * k], np.stack(inner), given[:, 2 * k:]]
        return out.transpose(0, 2, 1)

    def _by_class(self, word: np.ndarray):
        """Rows in the order of their words' classes, and (class, from, to) of each run."""
        own = self.of_class[word]
        order = np.argsort(own, kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(own, minlength=len(self.bounds) - 1))).tolist()
        return own, order, [(c, cuts[c], cuts[c + 1]) for c in range(len(self.bounds) - 1) if cuts[c] < cuts[c + 1]]

    def _output(self, name: str) -> np.ndarray:
        """Output weights of the classes (``c``) or words (``o``), a row each, the bias at its end."""
        weights = self.p[f"w{name}"]
        return np.column_stack([weights.T if name == "c" else weights, self.p[f"b{name}"]])

    def log_probs(self, h: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each word after each state."""
        own, order, runs = self._by_class(word)
        h, word = np.column_stack([h, np.ones(len(h), h.dtype)])[order], word[order]
        of_classes, of_words = self._output("c"), self._output("o")
        part, small = _log_prob(of_classes @ h.T, own[order], _small(of_classes)), _small(of_words)
        for c, i, j in runs:
            a, b = self.bounds[c], self.bounds[c + 1]
            if b - a > 1:
                part[i:j] += _log_prob(of_words[a:b] @ h[i:j].T, word[i:j] - a, small)
        out = np.empty(len(word))
        out[order] = part
        return out

    def score(self, texts: list[np.ndarray], width: int = 512) -> np.ndarray:
        """log10 probability of each text (an empty one has 0)."""
        lanes = Lanes(texts, width, self.begin)
        out = np.zeros(len(texts))
        h = np.zeros((len(lanes.lengths), self.hidden), np.float32)
        a = 0
        while a < lanes.steps:  # the fewer lanes are left, the more steps at a time
            live = int((lanes.lengths > a).sum())
            b = min(a + WINDOW * width // live, lanes.steps)
            before, word, text, keep = lanes.at(a, b)
            a, states = b, self.states(before, keep, h[:live])
            h = states[-1]
            real = word >= 0
            out += np.bincount(text[real], self.log_probs(states[real], word[real]), minlength=len(texts))
        return out / np.log(10)

    # --- training

    def _step(self, name: str, gradient: np.ndarray, rate: float, at=slice(None)) -> None:
        square = self.squares[name][at] + gradient * gradient
        self.squares[name][at] = square
        self.p[name][at] -= rate * gradient / np.sqrt(square)

    def learn(self, texts: list[np.ndarray], width: int = 32, rate: float = 0.08) -> None:
        """One pass of truncated backpropagation through time, a window at a time."""
        lanes = Lanes(texts, width, self.begin)
        h = np.zeros((len(lanes.lengths), self.hidden), np.float32)
        for a in range(0, lanes.steps, WINDOW):
            before, word, _, keep = lanes.at(a, min(a + WINDOW, lanes.steps))
            h = self._window(before, word, keep, h[:before.shape[1]], rate)

    def _window(self, before, word, keep, h, rate) -> np.ndarray:
        k, p, record = self.hidden, self.p, []
        states = self.states(before, keep, h, record)
        real = word >= 0
        own, order, runs = self._by_class(word[real])
        rows, target, own = states[real][order], word[real][order], own[order]
        rows = np.column_stack([rows, np.ones(len(rows), rows.dtype)])
        of_classes, of_words = self._output("c"), self._output("o")
        d_class = _softmax(of_classes @ rows.T, _small(of_classes))
        d_class[own, np.arange(len(own))] -= 1
        d_rows = d_class.T @ of_classes
        d_words, small = np.zeros_like(of_words), _small(of_words)
        for c, i, j in runs:
            lo, hi = self.bounds[c], self.bounds[c + 1]
            if hi - lo > 1:
                d = _softmax(of_words[lo:hi] @ rows[i:j].T, small)
                d[target[i:j] - lo, np.arange(j - i)] -= 1
                d_rows[i:j] += d.T @ of_words[lo:hi]
                np.matmul(d, rows[i:j], out=d_words[lo:hi])
        scale = np.float32(1 / before.shape[1])
        d_classes = d_class @ rows * scale
        d_words *= scale
        d_real = np.empty((len(rows), k), rows.dtype)
        d_real[order] = d_rows[:, :k] * scale
        old, z, r, inner, new = record
        d_states = np.zeros_like(states, order="C")
        d_states[real] = d_real
        # what a state's gradient becomes at each gate, for all steps at once
        d_states = np.ascontiguousarray(d_states.transpose(0, 2, 1))
        to_new = (1 - z) * (1 - new * new)
        to_z, to_r = (old - new) * z * (1 - z), to_new * inner * r * (1 - r)
        to_inner = to_new * r
        d_a = np.empty((len(before), 3 * k, before.shape[1]), rows.dtype)
        d_h, u = np.zeros_like(d_states[0]), np.ascontiguousarray(p["u"])
        for t in range(len(before) - 1, -1, -1):
            d, own_a = d_states[t], d_a[t]
            d += d_h
            np.multiply(d, to_z[t], out=own_a[:k])
            np.multiply(d, to_r[t], out=own_a[k:2 * k])
            np.multiply(d, to_inner[t], out=own_a[2 * k:])
            d_h = u @ own_a
            d_h += d * z[t]
            d_h *= keep[t]
        d_u = np.matmul(old, d_a.transpose(0, 2, 1)).sum(axis=0)
        np.multiply(d_states, to_new, out=d_a[:, 2 * k:])
        flat = d_a.transpose(0, 2, 1).reshape(-1, 3 * k)
        words = before.ravel()
        by_word = np.argsort(words.astype(np.min_scalar_type(len(self.counts))), kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(words[by_word]) != 0))
        self._step("x", np.add.reduceat(flat[by_word], first), rate, words[by_word][first])
        self._step("u", d_u, rate)
        self._step("b", flat.sum(axis=0), rate)
        self._step("wc", d_classes[:, :k].T, rate)
        self._step("bc", d_classes[:, k], rate)
        self._step("wo", d_words[:, :k], rate)
        self._step("bo", d_words[:, k], rate)
        return states[-1]
