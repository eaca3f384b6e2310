"""Quality scores from weak labels: expectation-maximisation over heuristic labellers.

Each labeller looks at simple measures of a text and votes good (1), bad (0) or abstains
(-1). All documents' votes are counted by pattern (at most 3 ** labellers patterns), and EM
on that histogram estimates how often each labeller is right for good and for bad texts and
the share of good ones. Every pattern so gets a posterior. The posteriors of a bounded sample
of documents (``max_rows``) train a hashed linear scorer, which then scores every whole text;
it can judge where the labellers abstain.

Rules: a NULL or empty text gets only abstentions and posterior and score 0 (it is of no use
for training). Ids are carried through; repeated rows count each. Only the id and text
columns are read; human labels are not used.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import WordHashes, id_and_text, map_slices, mix
from tarmac.llm.hashed_linear import Scorer, fit

THRESHOLD = 0.5
_KIND = bytes(0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x41 if 0x41 <= c <= 0x5A else 0x30 if 0x30 <= c <= 0x39 else 0x20 if c in (0x20, 9, 10, 11, 12, 13) else c for c in range(256))
_HASHES = WordHashes()


_DROP = b".,;:!?"


def word_ids(raw: bytes) -> np.ndarray:
    """Hashes of the words without case and common stops."""
    return _HASHES.of(raw.lower().translate(None, _DROP).split())


def measures(raw: bytes, ids: np.ndarray) -> dict[str, float]:
    """Shares and means that the labellers vote on."""
    n = max(len(ids), 1)
    kind = raw.translate(_KIND)
    upper, lower, digits = kind.count(b"A"), kind.count(b"a"), kind.count(b"0")
    letters = max(upper + lower, 1)
    solid = max(len(raw) - kind.count(b" "), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    stops = sum(raw.count(m) for m in (b". ", b".\n")) + raw.endswith(b".")
    return {
        "words": len(ids),
        "upper": upper / letters,
        "symbols": (solid - upper - lower - digits) / solid,
        "odd": sum(raw.count(m) for m in (b"|", b"#", b"$", b"%", b"&", b"*")) / n,
        "repeats": int((ids[1:] == ids[:-1]).sum()) / n,
        "distinct": len(np.unique(ids)) / n,
        "stops": stops / n,
        "lines": len(lines) and len(set(lines)) / len(lines),
        "shouts": raw.count(b"!!") / n,
    }


#: name -> (votes bad if, votes good if); neither: abstains.
LABELLERS = {
    "case": (lambda m: m["upper"] > 0.4, lambda m: m["upper"] < 0.12),
    "symbols": (lambda m: m["symbols"] > 0.2, lambda m: m["symbols"] < 0.06),
    "marks": (lambda m: m["odd"] > 0.2, lambda m: m["odd"] == 0),
    "repeats": (lambda m: m["repeats"] > 0.2, lambda m: m["repeats"] < 0.04),
    "variety": (lambda m: m["words"] > 40 and m["distinct"] < 0.25, lambda m: m["words"] > 40 and m["distinct"] > 0.4),
    "sentences": (lambda m: m["words"] > 20 and m["stops"] < 0.01, lambda m: 0.03 < m["stops"] < 0.4),
    "length": (lambda m: m["words"] < 8, lambda m: 60 < m["words"] < 10_000),
    "shouts": (lambda m: m["shouts"] > 0.1, lambda m: False),
    "lines": (lambda m: 0 < m["lines"] < 0.7, lambda m: False),
}


def look(text: str) -> tuple[bytes, np.ndarray]:
    """A text's bytes and word ids, which votes and features share."""
    raw = text.encode()
    return raw, word_ids(raw)


def votes(seen: tuple[bytes, np.ndarray]) -> str:
    """One sign per labeller: '1' good, '0' bad, '-' abstains."""
    if not seen[0]:
        return "-" * len(LABELLERS)
    m = measures(*seen)
    return "".join("0" if bad(m) else "1" if good(m) else "-" for bad, good in LABELLERS.values())


def expectation_maximisation(patterns: dict[str, int], rounds: int = 100, tolerance: float = 1e-9) -> tuple[dict[str, float], np.ndarray, float]:
    """(posterior of good per pattern, accuracies [labeller, class], share of good texts).

    Labellers are taken as independent given the class. Starts from the majority of votes;
    counts are smoothed by one vote each way, so that no estimate reaches 0 or 1.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.full((len(LABELLERS), 2), 0.5), 0.5
    v = np.array([[{"1": 1, "0": 0, "-": -1}[c] for c in p] for p in names])
    n = np.array([patterns[p] for p in names], float)
    good, bad = v == 1, v == 0
    post = (good.sum(1) + 0.7) / (good.sum(1) + bad.sum(1) * 2 + 1)  # a bad mark tells more than a good one
    accuracy, prior = np.full((v.shape[1], 2), 0.7), 0.5
    for _ in range(rounds):
        # M step: how often each labeller is right on good (1) and bad (0) texts.
        accuracy = np.stack([
            ((n * (1 - post)) @ bad + 1) / ((n * (1 - post)) @ (good | bad) + 2),
            ((n * post) @ good + 1) / ((n * post) @ (good | bad) + 2),
        ], axis=1)
        prior = float(np.clip((n @ post + 1) / (n.sum() + 2), 1e-6, 1 - 1e-6))
        # E step
        one = np.log(prior) + good @ np.log(accuracy[:, 1]) + bad @ np.log(1 - accuracy[:, 1])
        zero = np.log(1 - prior) + bad @ np.log(accuracy[:, 0]) + good @ np.log(1 - accuracy[:, 0])
        new = 1 / (1 + np.exp(np.clip(zero - one, -500, 500)))
        done = np.abs(new - post).max() < tolerance
        post = new
        if done:
            break
    return dict(zip(names, post.tolist(), strict=True)), accuracy, prior


def shape_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return seen_features([look(t) for t in texts])


def seen_features(seen: list[tuple[bytes, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature): words without case, and shares of word shapes in steps of two.

    A shape is a word with runs of letters (upper and lower), digits and other signs
    shortened, so "Thnd***" and "iner***" have the shapes "Aa*" and "a*"."""
    rows, out = [], []
    for r, (raw, ids) in enumerate(seen):
        kinds = raw.translate(_KIND).split()
        shapes: dict[bytes, int] = {}
        for w, c in Counter(kinds).items():
            s = _shape(w)
            shapes[s] = shapes.get(s, 0) + c
        n, distinct = max(len(kinds), 1), np.unique(ids)
        marks = [b"\0shape %s %d" % (s, int(np.log2(c / n))) for s, c in shapes.items()]
        repeats = int((ids[1:] == ids[:-1]).sum())
        marks += [b"\0repeats %d" % int(10 * repeats / n), b"\0distinct %d" % int(10 * len(distinct) / n), b"\0words %d" % int(np.log2(n))]
        h = np.concatenate([_HASHES.of(marks), distinct])
        rows.append(np.full(len(h), r))
        out.append(mix(h))
    return (np.concatenate(rows), np.concatenate(out)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


@lru_cache(1 << 16)
def _shape(word: bytes) -> bytes:
    return bytes(x for i, x in enumerate(word) if not i or x != word[i - 1])[:6]


def quality(docs: DataFrame, threshold: float = THRESHOLD, max_rows: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, votes, posterior, score, predicted) for every row; votes name the labellers
    in the order of ``LABELLERS``, score is the trained scorer's."""
    base = id_and_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def vote_task():
        def each(part: pa.RecordBatch) -> dict:
            return {"doc_id": part.column("doc_id"), "votes": pa.array([votes(look(t)) for t in part.column("text").to_pylist()], pa.string())}

        return each

    voted = map_slices(base, f"doc_id {kind}, votes string", vote_task)
    histogram = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # 3^labellers at most
    histogram.pop("-" * len(LABELLERS), None)
    posterior, _, _ = expectation_maximisation(histogram)
    table = docs.sparkSession.sparkContext.broadcast(posterior)

    # The sample is chosen by the hash of the id alone; only its texts are moved.
    chosen = base.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def label_task():
        def each(part: pa.RecordBatch) -> dict:
            texts = part.column("text").to_pylist()
            return {"doc_id": part.column("doc_id"), "text": part.column("text"), "label": pa.array([table.value.get(votes(look(t))) for t in texts], pa.float64())}

        return each

    sample = map_slices(base.join(F.broadcast(chosen), "doc_id"), f"doc_id {kind}, text string, label double", label_task)
    weights = docs.sparkSession.sparkContext.broadcast(fit(sample, shape_features, max_rows=max_rows, l1=2.0, alpha=0.3))

    def task():
        scorer = Scorer(weights.value, seen_features)

        def each(part: pa.RecordBatch) -> dict:
            texts = part.column("text").to_pylist()
            seen = [look(t) for t in texts]
            own = [votes(x) for x in seen]
            score = np.where(np.array([bool(t) for t in texts]), scorer(seen), 0.0)
            return {
                "doc_id": part.column("doc_id"),
                "votes": pa.array(own, pa.string()),
                "posterior": pa.array([table.value.get(v, 0.0) for v in own], pa.float64()),
                "score": pa.array(score),
                "predicted": pa.array((score >= threshold).astype(np.int32)),
            }

        return each

    return map_slices(base, f"doc_id {kind}, votes string, posterior double, score double, predicted int", task)
