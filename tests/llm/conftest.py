from __future__ import annotations

import random

import pytest

from tarmac.llm.common import prepare

WORDS = "the of and to a in is it you that he was for on are with as his they be at one have this from or had by hot but some what there we can out other were all your when up use word how said an each she which do their time if will way about many then them would write like so these her long make thing see him two has look more day could go come did my sound no most number who over know water than call first people may down side been now find".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="session")
def ready(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def awkward(ready):
    """Documents with copies, near copies, shared passages, nulls, ties, odd texts, and
    extra columns whose names the operators use themselves."""
    rng = random.Random(3)
    shared = sentence(rng, 60)
    texts = [sentence(rng, rng.randrange(5, 150)) for _ in range(40)]
    base = sentence(rng, 200).split()
    for _ in range(45):  # a group of near copies larger than a posting list is compared pair by pair
        near = list(base)
        for _ in range(2):
            near[rng.randrange(200)] = "edit" + str(rng.randrange(10**6))
        texts.append(" ".join(near))
    texts += [sentence(rng, 8) + "\n" + shared + "\n\n" + shared + "\n" + sentence(rng, 20) for _ in range(5)]
    texts += [texts[0]] * 40 + ["", None, " \n\t ", "ÉÀ ñandú ß ﬁ ́x 日本語テキスト", "a" * 300, "ab" * 5000, "x", "don't <|endoftext|> STOP!!", "é" * 120 + " " + "é" * 120]
    texts += ["\U0001F600 " * 30, sentence(rng, 20_000)]
    rows = [(i * 3, t, "a", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[3], rows[45], (3, "another text under a taken id", "a", 1, 2), (None, texts[1], None, None, None), (None, None, "b", 0, 0)]
    return ready.createDataFrame(rows, "doc_id long, text string, score string, bucket int, d int").repartition(5, "score", "doc_id")


@pytest.fixture(scope="session")
def clean(awkward):
    """The awkward documents whose id is set and unique."""
    one = awkward.where("doc_id is not null").groupBy("doc_id").count().where("count = 1")
    return awkward.join(one.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")


@pytest.fixture(scope="session")
def texts(clean):
    return {r["doc_id"]: r["text"] for r in clean.collect()}


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
