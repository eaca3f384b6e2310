"""The pipeline's stages on the smallest tables, each against a plain version on its own input."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from tarmac.llm.common import save
from tarmac.llm.queries import registry, table, tokenizer_path
from tarmac.llm.toxicity import toxicity
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages(ready):
    docs = table(ready, SF_SMALL, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = save(stage(ready, docs, SF_SMALL), name)
        seen.append((name, docs, out))
        docs = out
    for _, _, out in seen[:-1]:
        assert out.columns == columns
    of = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    _, before, after = seen[0]
    bad = {r["doc_id"] for r in toxicity(before, table(ready, SF_SMALL, "labels")).where("predicted = 1").collect()}
    assert of(after) == {d: t for d, t in of(before).items() if d not in bad}

    _, before, after = seen[1]
    want, got = brute.line_dedup(sorted(of(before).items())), of(after)
    assert {d: [x for x in t.split("\n") if x.strip()] for d, t in got.items()} == {d: w[0] for d, w in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    _, before, after = seen[2]
    assert set(of(after)) == {c for _, c in brute.components(of(before)).values()}

    _, before, after = seen[3]
    items = {r["item_id"]: r["text"] for r in table(ready, SF_SMALL, "benchmark").collect()}
    assert set(of(after)) == {d for d, v in brute.contamination(of(before), items).items() if not v[3]}

    _, before, after = seen[4]
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {d: hashlib.sha256(" ".join(map(str, t.encode(x, add_special_tokens=False).ids)).encode()).hexdigest() for d, x in of(before).items()}
    assert {r["doc_id"]: r["ids_sha256"] for r in after.collect()} == want


def test_registered_names():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {*registry(), "pipeline"} <= names and len(registry()) == 13
