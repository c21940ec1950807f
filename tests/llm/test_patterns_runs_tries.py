"""Packing by patterns, periodic runs and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import prefix_trie as trie
from pairloom.llm.pattern_packing import best_fit, length_patterns, numbered_by_length, pack_patterns, plan_sequences
from pairloom.llm.periodic import COVER, MODULUS, Extensions, collapse_runs, runs_of_documents
from pairloom.llm.queries import with_planted_periods
from pairloom.llm.tokens import tokenizer_file

WORD = r"[^\x20\x09-\x0D]+"


# Packing


@pytest.fixture(scope="module")
def content():
    pytest.importorskip("public_tokenizers")
    return tokenizer_file()


def held(kinds, window):
    got = np.zeros(window + 1, np.int64)
    for lengths, many in kinds:
        assert sum(lengths) <= window and many > 0
        for length in lengths:
            got[length] += many
    return got


@pytest.mark.parametrize("seed", range(8))
def test_plans_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([1, 2, 7, 64, 300]))
    histogram = rng.integers(0, 50, window + 1) * (rng.random(window + 1) < rng.random())
    histogram[0] = 0
    for plan in (plan_sequences, best_fit):
        assert (held(plan(histogram, window), window) == histogram).all()
    assert plan_sequences(np.zeros(window + 1, np.int64), window) == []


def test_patterns_are_complete():
    lengths = np.array([1, 2, 3, 5, 6, 9])
    want = {t for t in ((a, b, 10 - a - b) for a in range(11) for b in range(11)) if t[0] >= t[1] >= t[2] >= 0 and t[1]}
    want = {t for t in want if set(t) - {0} <= set(lengths.tolist())}
    assert sorted(map(tuple, length_patterns(lengths, 10).tolist())) == sorted(want)


def test_plans_need_few_sequences():
    rng = np.random.default_rng(3)
    lengths = (np.minimum(rng.lognormal(5.8, 1, 20_000).astype(int), 20_000)) % 1024 + 1
    histogram = np.bincount(lengths, minlength=1025)
    plan = plan_sequences(histogram, 1024)
    from_patterns = [many for kind, many in plan if sum(kind) == 1024 and 1 < len(kind) <= 3]
    assert sum(from_patterns) > 1000
    assert sum(many for _, many in plan) <= 1.001 * lengths.sum() / 1024


def test_pack_patterns(spark, content):
    texts = [(1, "a b c"), (2, None), (3, ""), (None, "x y"), (None, "x y"), (2, "again " * 700), (5, "é " * 3000), (5, "é " * 3000)]
    texts += [(100 + k, "word " * (k * 7 % 90)) for k in range(300)] + [(7, "the same words")] * 50
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in texts], "doc_id long, text string, length int, sequence_id string")
    rows = pack_patterns(docs.repartition(5), content, window=64).collect()
    own = Tokenizer.from_str(content)
    want = defaultdict(int)
    for i, t in texts:
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % 64 + 1
        for piece, stop in enumerate(range(first, len(ids) + 1, 64)):
            start = max(stop - 64, 0)
            want[i, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / 64 + 1


def test_pack_no_documents(spark, content):
    empty = spark.createDataFrame([], "doc_id long, text string")
    packed = pack_patterns(empty, content)
    assert packed.count() == 0 and packed.columns[-2:] == ["sequence_id", "offset"]


def test_a_frequent_length_is_numbered_in_shards(spark):
    pieces = spark.range(5000).select(F.col("id").alias("place"), F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7).alias("length"))
    numbered = numbered_by_length(pieces, shard_pieces=100)
    numbers = defaultdict(list)
    for r in numbered.collect():
        numbers[r.length].append(r.number)
    assert len(numbers[7]) == 4500
    assert all(sorted(n) == list(range(len(n))) for n in numbers.values())


# Periodic runs


def plain_runs(x):
    """All runs by their definition."""
    found, seen = [], set()
    for q in range(1, len(x) // 4 + 1):
        at = 0
        while at < len(x) - q:
            end = at
            while end < len(x) - q and x[end] == x[end + q]:
                end += 1
            if end > at and end + q - at >= max(6, 4 * q) and (at, end + q) not in seen:
                seen.add((at, end + q))
                found.append((at, end + q, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made(rng, n, letters):
    x = rng.integers(1, letters + 1, n)
    if n > 8 and rng.random() < 0.6:
        a = int(rng.integers(0, n))
        p = int(rng.integers(1, max(2, (n - a) // 3 + 1)))
        x = np.array([x[i] if i < a else x[a + (i - a) % p] for i in range(n)])
    return x.astype(np.int64)


@pytest.mark.parametrize("seed", range(4))
def test_runs_by_definition(seed):
    rng = np.random.default_rng(seed)
    for _ in range(100):
        documents = [made(rng, int(rng.integers(0, 70)), int(rng.integers(1, 4))) for _ in range(rng.integers(1, 6))]
        got = runs_of_documents(documents)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(d.tolist()) for d in documents]


def test_long_documents():
    rng = np.random.default_rng(9)
    x = rng.integers(1, 5000, 60_000)
    x[10_000:40_000] = np.tile(x[10_000:17_000], 5)[:30_000]
    x[9_999], x[40_000] = 6000, 6001
    assert [tuple(r) for r in runs_of_documents([x])[0].tolist()] == [(10_000, 40_000, 7_000)]
    assert runs_of_documents([np.ones(30_000, np.int64)])[0].tolist() == [[0, 30_000, 1]]


def test_extensions():
    assert {(a - b) % MODULUS for a in COVER for b in COVER} == set(range(MODULUS))
    rng = np.random.default_rng(2)
    for n in (1, 2, 20, 22, 300):
        x = made(rng, n, 2)
        pairs = [(i, j) for i in range(n) for j in range(n + 1) if i != j][::7]
        i, j = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        if not len(i):
            continue
        want = []
        for a, b in pairs:
            k = 0
            while max(a, b) + k < n and x[a + k] == x[b + k]:
                k += 1
            want.append(k)
        assert Extensions(x).common(i, j).tolist() == want


def test_collapse_runs(spark):
    rnd = random.Random(1)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 9), (None, "a b " * 9), (4, "x " + "la " * 500 + "y"), (5, "1 2 3\xa04 " * 8)]
    rows += [(k, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60)))) for k in range(10, 60)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, runs int, collapsed string").repartition(3)
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(docs).collect()), key=str)
    want = []
    for i, text in rows:
        words = re.findall(WORD, text or "")
        numbers = {w: k for k, w in enumerate(sorted(set(words)), 1)}
        runs = plain_runs([numbers[w] for w in words])
        gone = {k for s, e, q in runs for k in range(s + q, e)}
        want.append((i or 0, len(words), [(s, e - s, q) for s, e, q in runs], " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert got == sorted(want, key=str)
    assert collapse_runs(docs.limit(0)).count() == 0


def test_planted_periods(spark):
    texts = [(k, " ".join(f"w{j}" for j in range(k % 37))) for k in range(400)] + [(None, "a b"), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.text for r in with_planted_periods(docs).where("doc_id IS NOT NULL AND doc_id <> 5").collect()}
    planted = 0
    for i, text in texts[:400]:
        words, h = re.findall(WORD, text), zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
            planted += 1
        assert i == 5 or got[i] == text
    assert planted > 20


# Prefix trie


def plain_trie(rows, members):
    turns = defaultdict(list)
    for c, pos, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append((pos is not None, pos or 0, digest, (role, text)))
    ways = {c: tuple(t[-1] for t in sorted(own)) for c, own in turns.items()}
    for c in members:
        ways.setdefault(c, ())
    nodes, children, below, out = defaultdict(list), defaultdict(list), {}, set()
    for c, way in ways.items():
        for depth in range(len(way) + 1):
            nodes[way[:depth]].append(c)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(WORD, node[-1][1])) if node else 0
        leaves = sum(below[k][0] for k in children[node]) or 1
        saved = (len(nodes[node]) - 1) * words + sum(below[k][1] for k in children[node])
        below[node] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in nodes[node] if ways[c] == node)))
        parent = min(nodes[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(nodes[node]), len(node), parent, len(nodes[node]), len(children[node]), leaves, saved, sha))
    return out


CONVERSATIONS = "conv_id long, pos long, role string, text string, depth string, words int"


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(trie, "LISTED", 3)
    rnd = random.Random(5)
    rows = [(None, 1, "u", "x")]
    for c in range(60):
        for pos in range(rnd.randint(0, 14)):
            text = rnd.choice(["x y", "z", None, " q\tq\n"]) if rnd.random() < 0.3 else "the same  thing"
            rows.append((c - 10, pos if rnd.random() < 0.95 else None, rnd.choice(["u", "a", None]) if pos > 6 else "u", text))
    # One conversation many times, one with many turns, and one whose rows repeat.
    rows += [(c, pos, "u", f"copy {pos}") for c in range(100, 130) for pos in range(6)]
    rows += [(200, pos, "u", f"turn {pos % 3}") for pos in range(200)] + [(201, pos, "u", f"turn {pos % 3}") for pos in range(150)] * 2
    rnd.shuffle(rows)
    members = [*range(-10, 50), 300, 300, None]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATIONS).repartition(3)
    got = [tuple(r) for r in trie.prefix_trie(turns, spark.createDataFrame([(m,) for m in members], "conv_id long")).collect()]
    want = plain_trie(rows, [m for m in members if m is not None])
    assert len(got) == len(want) and set(got) == want


def test_trie_without_turns(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert trie.prefix_trie(none).count() == 0
    (root,) = trie.prefix_trie(none, spark.range(3).withColumnRenamed("id", "conv_id")).collect()
    assert tuple(root) == (0, 0, None, 3, 0, 1, 0, hashlib.sha256(b"0,1,2").hexdigest())


def test_superblocks_make_no_difference(spark):
    rows = [(c, pos, f"{pos % 5}{c * pos % 3}", 2) for c in range(3) for pos in range(1, 60)]
    turns = spark.createDataFrame(rows, "conv_id long, pos long, digest string, words long")
    results = []
    for superblock in (2, 1000):
        blocks, ways = trie.turn_blocks(turns, 4, superblock)
        results.append((sorted(map(str, blocks.collect())), sorted(map(str, ways.collect()))))
    assert results[0] == results[1]


def test_share_beginnings(spark):
    rnd = random.Random(2)
    rows = [(c, t if t else None, "u", f"{c} {t}") for c in range(90) if c % 20 or c % 40 for t in range(rnd.randint(0, 5))]
    conversations = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    begun, ids = trie.share_beginnings(conversations)
    own = defaultdict(list)
    for c, t, _, text in rows:
        own[c].append((t or 0, text))
    want = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        texts = [x for _, x in sorted(own[c])]
        want[c] = [x for _, x in sorted(own.get(c - c % 20, []))][:h] + texts[h:]
    got = defaultdict(list)
    for r in begun.orderBy("conv_id", "pos").collect():
        got[r.conv_id].append(r.text)
    assert {r.conv_id for r in ids.collect()} == set(want)
    assert got == {c: t for c, t in want.items() if t}
