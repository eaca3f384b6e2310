"""Operators against brute force, on awkward documents; every operator on an empty table."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarmac.llm.bpe_chunks import ChunkEncoder, encode_decode
from tarmac.llm.decontaminate import contamination
from tarmac.llm.fingerprints import Fingerprint, fingerprints
from tarmac.llm.line_dedup import line_dedup, without_repeated_lines
from tarmac.llm.ngram_join import near_duplicates, one_of_each
from tarmac.llm.prefix_hash import PrefixHashes, common_extension
from tarmac.llm.quality import expectation_maximisation, quality
from tarmac.llm.queries import table, tokenizer_path
from tarmac.llm import sharding
from tarmac.llm.sharding import shard_rows
from tarmac.llm.suffix_dedup import merge_sort, suffix_dedup
from tarmac.llm.token_counts import PieceTable, long_count, piece_scores, token_counts, trie_counts
from tarmac.llm.toxicity import toxicity, without_toxic
from tests.conftest import SF_ORACLE
from tests.llm import brute
from pyspark.sql import functions as F
from tests.llm.conftest import sentence

tokenizers = pytest.importorskip("tokenizers")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def scores():
    return piece_scores(tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def bpe_path():
    return tokenizer_path("word_bpe_49k.json")


# --- token counts

def test_token_counts_match_the_unigram_library(awkward, scores):
    vocab = [("<unk>", 0.0), *[(f"<0x{i:02X}>", 0.0) for i in range(256)], *scores.items()]
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(vocab, 0, True))
    rows = token_counts(awkward, scores).collect()
    want = Counter((r["doc_id"], sum(len(library.encode("▁" + w, add_special_tokens=False).ids) for w in (r["text"] or "").split())) for r in awkward.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want


def test_trie_shares_prefixes(scores):
    table = PieceTable(scores)
    words = ["▁" + w for w in ("inter", "internal", "international", "internationals", "x", "日本")]
    counts, nodes = trie_counts(words, table)
    assert nodes < sum(map(len, words))
    assert counts == {w: long_count(w, scores, table.longest, table.unknown) for w in words}


# --- fingerprints

def test_fingerprints(awkward, clean, texts):
    rows = {r["doc_id"]: r for r in fingerprints(clean).collect()}
    order = sorted(texts)
    for i, d in enumerate(order):
        t, n = texts[d] or "", len(texts[d] or "")
        edited = t[:n - n // 2] + (texts[order[(i + 1) % len(order)]] or "")[:n // 2]
        assert (rows[d]["n_chars"], rows[d]["edited_sha256"]) == (n, sha(edited))
        assert rows[d]["fingerprint"] == str(Fingerprint.of(t)) and rows[d]["edited_fingerprint"] == str(Fingerprint.of(edited))
        assert 0 <= rows[d]["near_next"] <= 1 and (rows[d]["near_edited"] == 1) == (edited == t)
    by_text = defaultdict(set)
    for d, t in texts.items():
        by_text[t or ""].add(rows[d]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values()) and len({min(f) for f in by_text.values()}) == len(by_text)
    assert fingerprints(awkward).count() == awkward.count()


def test_fingerprints_do_not_depend_on_partitions(ready, clean):
    before = ready.conf.get("spark.sql.shuffle.partitions")
    a = {tuple(r) for r in fingerprints(clean).collect()}
    ready.conf.set("spark.sql.shuffle.partitions", "2")
    b = {tuple(r) for r in fingerprints(clean.coalesce(1)).collect()}
    ready.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


def test_likeness_and_extensions():
    rng = random.Random(1)
    a, b = sentence(rng, 300), sentence(rng, 300)
    half = a[:len(a) // 2] + b[:len(a) - len(a) // 2]
    fa, fb, fh = map(Fingerprint.of, (a, b, half))
    assert fa.likeness(fa) == 1 and 0.4 < fa.likeness(fh) < 0.8 and fa.likeness(fb) < 0.1
    assert str(Fingerprint.parse(str(fa))) == str(fa)
    moved = Fingerprint.of("shifted " + a)
    assert fa.likeness(moved) > 0.8
    x, y = PrefixHashes(np.frombuffer(a.encode(), np.uint8)), PrefixHashes(np.frombuffer(half.encode(), np.uint8))
    got = common_extension(x, np.array([0, 5, 10**9 % 7]), y, np.array([0, 5, 3]))
    for k, (i, j) in enumerate([(0, 0), (5, 5), (10**9 % 7, 3)]):
        n = 0
        while i + n < len(a) and j + n < len(half) and a[i + n] == half[j + n]:
            n += 1
        assert got[k] == n


# --- BPE

def test_encode_decode_matches_the_library(awkward, bpe_path):
    t = tokenizers.Tokenizer.from_file(bpe_path)
    want = Counter()
    for r in awkward.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in encode_decode(awkward, bpe_path, texts=False).collect()) == want


def test_tokenizers_that_join_spaces_to_words_are_refused():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError, match="does not part the words"):
        ChunkEncoder(f.read())


@pytest.mark.parametrize("mean", [2, 16, 1024])
def test_chunk_joins_are_repaired(bpe_path, mean):
    t = tokenizers.Tokenizer.from_file(bpe_path)
    enc = ChunkEncoder(open(bpe_path, encoding="utf-8").read(), mean)
    rng = random.Random(mean)
    alphabet = "ab AB'sé́ \n\t1.,!|<>日本 　ß"
    cases = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(200)] + [sentence(rng, 200)] * 3
    got = enc.encode(cases)
    for c, (n, ids, decoded) in zip(cases, got, strict=True):
        want = t.encode(c, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), t.decode(want, skip_special_tokens=False))
    assert enc.made < enc.met  # copies share chunks


# --- toxicity and quality

@pytest.fixture(scope="module")
def marked(ready):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = sentence(rng, rng.randrange(20, 60)).split()
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vile", "rotten"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (10**9, 1)]
    return ready.createDataFrame(docs, "doc_id long, text string"), ready.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(marked):
    docs, labels = marked
    rows = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    held = [(r["predicted"], d % 5 == 0) for d, r in rows.items() if r["held_out"]]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    kept = {r["doc_id"] for r in without_toxic(docs, labels).collect()}
    assert kept == {d for d, r in rows.items() if not r["predicted"]}


def test_toxicity_never_learns_from_held_out_rows(marked):
    from pyspark.sql import functions as F

    docs, labels = marked
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {tuple(r) for r in toxicity(docs, flipped).collect()} == {tuple(r) for r in toxicity(docs, labels).collect()}


def test_toxicity_awkward(awkward, marked, nothing):
    rows = toxicity(awkward, marked[1]).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in toxicity(awkward, marked[1].limit(0)).collect()} == {0.5}


def test_quality_agrees_with_labels_it_never_saw(ready, awkward):
    docs = table(ready, SF_ORACLE, "documents")
    human = {r["doc_id"]: r["quality"] for r in table(ready, SF_ORACLE, "labels").collect()}
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    good, bad = ([got[d]["score"] for d, q in human.items() if q == k] for k in (1, 0))
    above = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert above >= 0.97 and sum(s >= 0.5 for s in good) >= 0.98 * len(good)
    odd = quality(awkward).collect()
    assert len(odd) == awkward.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in odd if r["votes"] == "-" * 9} >= {0.0}


def test_expectation_maximisation_recovers_accuracies():
    rng = random.Random(5)
    rates = [0.95, 0.9, 0.85, 0.8, 0.75, 0.9, 0.9, 0.7, 0.8]
    seen = Counter()
    for _ in range(20_000):
        y = rng.random() < 0.7
        seen["".join("-" if rng.random() < 0.2 else str(int(y if rng.random() < a else not y)) for a in rates)] += 1
    _, accuracy, prior = expectation_maximisation(seen)
    assert abs(prior - 0.7) < 0.03 and np.abs(accuracy.mean(axis=1) - rates).max() < 0.03


# --- sharding

@pytest.mark.parametrize("shards", [7, 40])
def test_shards(awkward, shards):
    rows = shard_rows(awkward, shards).collect()
    assert len(rows) == awkward.count()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    want = Counter((d["doc_id"], len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode())) for d in awkward.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_shards_keep_groups_together(ready):
    rows = [(i, f"text {i % 150}" if i < 300 else "hot" if i < 700 else f"own {i}") for i in range(2000)]
    got = shard_rows(ready.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    where = defaultdict(set)
    for r in got:
        where[rows[r["doc_id"]][1]].add(r["shard"])
    assert sum(len(where[f"text {k}"]) == 1 for k in range(150)) >= 145
    assert len(where["hot"]) <= 8  # 400 rows: two shards at least


def shards_of(ready, texts: list[str], shards: int) -> dict:
    """text -> its shards; the counts of all shards are checked."""
    got = shard_rows(ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    assert {Counter(r["shard"] for r in got)[s] - len(texts) // shards for s in range(shards)} <= {0, 1}
    where = defaultdict(set)
    for r in got:
        where[texts[r["doc_id"]]].add(r["shard"])
    return where


def test_shards_split_only_groups_that_no_shard_holds(ready):
    texts = ["hot"] * 400 + [f"large {i % 6}" for i in range(6 * 170)] + [f"own {i}" for i in range(580)]
    where = shards_of(ready, texts, 10)
    assert len(where["hot"]) == 2 and all(len(where[f"large {k}"]) == 1 for k in range(6))
    where = shards_of(ready, [f"pair {i % 40}" for i in range(80)], 40)
    assert all(len(x) == 1 for x in where.values())


def test_shards_keep_copies_together_in_full_tables(ready):
    where = shards_of(ready, [f"pair {i % 500}" for i in range(1000)], 10)
    assert all(len(x) == 1 for x in where.values())
    texts = [f"group {k}" for k in range(700) for _ in range(2 + k % 6)]
    where = shards_of(ready, texts, 10)
    assert sum(len(x) > 1 for x in where.values()) < 10


def cut_of(where: dict, links: list) -> int:
    return sum(w for u, v, w in links if u in where and v in where and where[u] != where[v])


@pytest.mark.parametrize("copies", [1, 3])
def test_shards_follow_links(ready, copies):
    """Communities of linked documents: far fewer links are cut than by the first placing, counts stay even, copies stay together."""
    rng = random.Random(copies)
    n, shards = 240, 8
    docs = [(copies * i + k, f"text {i}") for i in range(n) for k in range(copies)]
    pairs = set()
    for i in range(n):  # 10 communities of 24
        pairs |= {tuple(sorted((i, i // 24 * 24 + rng.randrange(24)))) for _ in range(4)}
    links = [(copies * u, copies * v + copies - 1, 1 + (u + v) % 3) for u, v in sorted(pairs) if u != v] + [(0, 10**9, 5), (None, 3, 5), (7, 7, 9)]
    table = ready.createDataFrame(links, "u long, v long, weight long")
    frame = ready.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["shard"] for r in shard_rows(frame, shards, links=table).collect()}
    start = {r["doc_id"]: r["shard"] for r in shard_rows(frame, shards).collect()}
    assert sorted(got) == sorted(d for d, _ in docs)
    counts = Counter(got.values())
    assert {counts[s] - n * copies // shards for s in range(shards)} <= {0, 1}
    known = [x for x in links if x[0] is not None and x[1] < 10**9 and x[0] != x[1]]
    assert cut_of(got, known) < 0.6 * cut_of(start, known)
    split = sum(len({got[copies * i + k] for k in range(copies)}) > 1 for i in range(n))
    assert split < shards


def test_improving_rounds_count_and_lower_the_cut(ready):
    """The weight of the links cut against a plain count, before and after rounds in full shards (swaps only)."""
    rng = random.Random(5)
    members = {k: 2 for k in range(60)}
    at = {k: k % 6 for k in members}
    pairs = {(a, b): rng.randrange(1, 5) for a in members for b in members if a < b and a // 10 == b // 10 and rng.random() < 0.5}
    both = [(a, a, b, b, w) for (a, b), w in pairs.items()] + [(b, b, a, a, w) for (a, b), w in pairs.items()]
    links = ready.createDataFrame(both, "g1 long, g2 long, h1 long, h2 long, weight long")
    labels = ready.createDataFrame([(k, k, members[k], at[k]) for k in members], "g1 long, g2 long, members long, at int")
    plain = lambda where: sum(w for (a, b), w in pairs.items() if where[a] != where[b])
    assert sharding.cut_weight(links, labels) == plain(at)
    room = [0] * 6
    moved = sharding.improve(labels, links, room)
    where = {r["g1"]: r["at"] for r in moved.collect()}
    assert sharding.cut_weight(links, moved) == plain(where) < plain(at)
    load = Counter()
    for k, s in where.items():
        load[s] += members[k]
    assert room == [0] * 6 and all(load[s] == 20 for s in range(6))


# --- decontamination

def test_contamination(awkward, clean, texts, ready):
    words = (texts[3 * 5] or "").split()
    items = {1: " ".join(words[:40]), 2: " ".join(words[20:26]).upper(), 3: "", 4: None, 5: " ".join(words[:40]), 6: "日本語テキスト", 7: sentence(random.Random(8), 30), 8: "x"}
    bench = ready.createDataFrame([*items.items(), (1, items[1])], "item_id long, text string")
    for block in (1 << 20, 20):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in contamination(clean, bench, block_words=block).collect()}
        assert got == brute.contamination(texts, items)
    assert any(v[3] for v in got.values())
    kept = contamination(awkward, bench, keep=awkward.columns)
    assert kept.schema == awkward.schema
    bad = {d for d, v in got.items() if v[3]}
    assert not bad & {r["doc_id"] for r in kept.collect()}


def test_longest_match(ready):
    item = sentence(random.Random(2), 50)
    docs = ready.createDataFrame([(1, "before it " + " ".join(item.split()[5:45]) + " after")], "doc_id long, text string")
    r = contamination(docs, ready.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert (r["longest_match"], r["longest_at"], [(s["start"], s["end"]) for s in r["spans"]]) == (40, 2, [(2, 42)])


# --- suffix dedup and line dedup

def test_suffix_dedup(clean, texts):
    want = brute.suffix_dedup(sorted(texts.items()))
    for r in suffix_dedup(clean).collect():
        kept, removed, runs = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len((texts[r["doc_id"]] or "").encode()), removed, runs, sha(kept)), r["doc_id"]


def test_suffix_dedup_in_small_blocks(clean, texts, monkeypatch):
    from tarmac.llm import suffix_dedup as module

    monkeypatch.setattr(module, "BLOCK", 3)
    monkeypatch.setattr(module, "PART", 700)
    want = brute.suffix_dedup(sorted(texts.items()))
    assert {r["doc_id"]: r["kept_sha256"] for r in suffix_dedup(clean).collect()} == {d: sha(w[0]) for d, w in want.items()}


def test_suffix_dedup_ties(awkward):
    rows = suffix_dedup(awkward).collect()
    assert len(rows) == awkward.count()
    same = defaultdict(set)
    for r, n in Counter(tuple(r) for r in rows).items():
        same[r[0]].add(n)
    assert same[9] == {2}  # a repeated row: the same document twice, equal results


def test_merge_sort_orders_suffixes():
    rng = random.Random(6)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(500)).encode(), np.uint8)
    starts = np.arange(0, 400, 3)
    order = merge_sort(PrefixHashes(data), data, starts, 100)
    got = [data[s:s + 100].tobytes() for s in starts[order]]
    assert got == sorted(got)


def test_line_dedup(awkward, clean, texts):
    want = brute.line_dedup(sorted(texts.items()))
    for r in line_dedup(clean, texts=True).collect():
        kept, gone = want[r["doc_id"]]
        assert r["n_deleted"] == gone and [x for x in r["kept"].split("\n") if x.encode().strip()] == kept
        assert (r["kept"] == (texts[r["doc_id"]] or "")) or gone
    cut = without_repeated_lines(awkward)
    assert cut.schema == awkward.schema and cut.count() == awkward.count()


def test_line_dedup_to_the_end_of_a_run(ready):
    rng = random.Random(9)
    long, tail = sentence(rng, 20), sentence(rng, 5)
    docs = [(1, f"{long}\n{tail}"), (2, f"{sentence(rng, 12)}\n{long}\n\n{tail}\n{sentence(rng, 12)}"), (3, f"{long}\n{tail}")]
    pool = [sentence(rng, n) for n in (1, 1, 2, 3, 4, 6, 9, 14)] + ["日本語テキスト" * 3, "文" * 70]  # no spaces: 3 and 10 words
    docs += [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 25)))) for k in range(10, 40)]
    table = ready.createDataFrame(docs, "doc_id long, text string")
    for min_words in (10, 1, 17):
        got = {r["doc_id"]: r for r in line_dedup(table, min_words, texts=True).collect()}
        want = {d: w[0] for d, w in brute.line_dedup(docs, min_words).items()}
        assert {d: [x for x in r["kept"].split("\n") if x.strip()] for d, r in got.items()} == want
        assert (got[2]["n_deleted"], got[3]["kept"]) == (2, "")
    assert without_repeated_lines(table).where("doc_id = 3").first()["text"] == ""


# --- n-gram join

def test_near_duplicates(clean, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(clean).collect()}
    assert got == brute.components(texts)
    assert len({c for _, c in got.values()}) < len(got) - 60
    kept = {r["doc_id"] for r in one_of_each(clean).collect()}
    assert kept == {c for _, c in got.values()}


def test_near_duplicates_with_ties_and_nulls(awkward):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert all((r["component_id"] is None) == (r["doc_id"] is None) for r in rows)
    assert one_of_each(awkward).schema == awkward.schema


# --- all

def test_empty_tables(ready, nothing, marked, scores, bpe_path):
    bench = ready.createDataFrame([], "item_id long, text string")
    for out in (
        token_counts(nothing, scores), fingerprints(nothing), encode_decode(nothing, bpe_path), toxicity(nothing, marked[1].limit(0)), without_toxic(nothing, marked[1]),
        shard_rows(nothing), contamination(nothing, bench), suffix_dedup(nothing), line_dedup(nothing), without_repeated_lines(nothing), quality(nothing), near_duplicates(nothing), one_of_each(nothing),
    ):
        assert out.count() == 0


# --- names that clash, large ids, shared ids

def test_helper_names_do_not_clash(ready, marked):
    """The stages' own column names, taken by the table (in any case), and the empty table."""
    docs, labels = marked
    names = ["__d", "__T", "__cuts", "__later", "__scored_text", "__checked_TEXT", "__contaminated"]
    for n in names:
        docs = docs.withColumn(n, F.lit(n))
    items = ready.createDataFrame([(1, "some benchmark item")], "item_id long, text string")
    for table in (docs, docs.limit(0)):
        for out in (without_toxic(table, labels), without_repeated_lines(table), one_of_each(table), contamination(table, items, keep=table.columns)):
            assert out.columns == docs.columns
            assert all(r[n] == n for r in out.collect() for n in names)


def test_fingerprints_of_large_ids_beside_null(ready):
    rng = random.Random(8)
    rows = [(2**60 + i, sentence(rng, 12)) for i in range(200)] + [(None, "no id")]
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints(ready.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    for (i, t), (_, after) in zip(rows[:199], rows[1:200], strict=True):
        assert got[i] == sha(t[:len(t) - len(t) // 2] + after[:len(t) // 2])


def test_shared_ids_keep_their_links(ready):
    """Texts under a shared id are joined each on its own, and the id ties them together."""
    rng = random.Random(6)
    a, x, z = (sentence(rng, 60) for _ in range(3))
    near = " ".join([*x.split()[:-1], "changed"])
    rows = [(5, a), (5, x), (7, x), (11, near), (20, z), (20, z), (20, None), (None, x), (30, a + " more")]
    got = Counter(tuple(r) for r in near_duplicates(ready.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    sizes = {t: len(brute.shingles(t)) for _, t in rows}
    least = {5: 5, 7: 5, 11: 5, 20: 20, 30: 5, None: None}
    assert got == Counter((i, sizes[t], least[i]) for i, t in rows)
    kept = one_of_each(ready.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter([5, 20, None])
