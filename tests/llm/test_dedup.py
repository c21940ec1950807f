"""Line dedup, repeated byte strings, near duplicates."""

import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from pairloom.llm import repeats
from pairloom.llm.components import connected_components
from pairloom.llm.hashing import WordHashes
from pairloom.llm.line_dedup import dedup_lines
from pairloom.llm.near_dedup import (
    BUCKETS,
    SAMPLES,
    _gamma_levels,
    bag,
    keep_one_of_each,
    near_classes,
    sample,
    similarity,
    word_idf,
)
from pairloom.llm.repeats import LENGTH, MOST_CONTEXTS, anchors_of, remove_repeats, repeated_starts, suffix_array

DOCS = "doc_id long, text string, n_removed string, line_no string"


def frame(spark, texts):
    return spark.createDataFrame([(*t, "x", "y") if isinstance(t, tuple) else (k, t, "x", "y") for k, t in enumerate(texts)], DOCS)


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    for i in range(len(a)):
        if a[:i] + a[i + 1 :] == b or (len(a) == len(b) and a[:i] + a[i + 1 :] == b[:i] + b[i + 1 :]):
            return True
    return False


def brute_lines(texts, near=8):
    lines = [(d, k, line.lower().split(" ")) for d, t in enumerate(texts) if t is not None for k, line in enumerate(t.split("\n"))]
    lines = [(d, k, [w for w in words if w]) for d, k, words in lines]
    gone = set()
    for n, (d, k, words) in enumerate(lines):
        for _, _, other in lines[:n]:
            long_enough = len(words) >= near and len(other) >= near
            if words and (words == other or (long_enough and one_edit(words, other))):
                gone.add((d, k))
                break
    return ["\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) if t is not None else None for d, t in enumerate(texts)]


def test_lines_against_all_pairs(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcde") for _ in range(rng.choice([3, 7, 8, 9, 12, 17]))] for _ in range(6)]

    def line():
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = [rng.choice("abcdef")] * rng.choice([0, 1])
        text = (" " * rng.choice([1, 1, 2])).join(words)
        return text.upper() if rng.random() < 0.3 else text

    texts = ["\n".join(line() for _ in range(rng.randrange(1, 6))) for _ in range(60)] + [None, "", "\n\n", "   "]
    got = {r.doc_id: r for r in dedup_lines(frame(spark, texts)).collect()}
    want = brute_lines(texts)
    assert [got[k].text for k in range(len(texts))] == want
    assert got[60].n_lines == 0 and got[61].n_lines == 1 and got[62].n_lines == 3 and got[62].n_removed == 0


def test_lines_of_repeated_rows_and_long_lines(spark):
    long_line = " ".join(f"w{k}" for k in range(3000))
    edited = long_line.replace(" w1500 ", " other ")
    df = frame(spark, [(5, "same"), (5, "same"), (None, "same\nsame"), (7, long_line), (8, edited + "\nrest"), (9, long_line.replace(" w7 ", " "))])
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in dedup_lines(df).collect())
    # Null ids come first; rows with equal id and text are one document.
    assert got == [(False, 0, "same"), (True, 5, ""), (True, 5, ""), (True, 7, long_line), (True, 8, "rest"), (True, 9, "")]
    assert dedup_lines(df.limit(0)).collect() == []
    assert dedup_lines(df).columns == ["doc_id", "text", "line_no", "n_lines", "n_removed"]


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 4, 5, 6, 7, 40, 500):
        for top in (1, 2, 5):
            s = rng.integers(1, top + 1, n)
            assert suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("top", [1 << 22, 1 << 27])
def test_suffix_arrays_of_wide_alphabets(top):
    rng = np.random.default_rng(5)
    some = rng.integers(1, top, 300)
    s = np.concatenate([some, rng.integers(1, top, 100), some[50:250], some])
    assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_repeats_in_the_largest_flush():
    """As many contexts as a task sorts, of random bytes around one anchor; every fifth shares strings with the next."""
    rng = np.random.default_rng(6)
    sides = rng.integers(0, 256, (MOST_CONTEXTS, 240), np.uint8)
    sides[1::5, 30:200] = sides[::5, 30:200]
    sides[1::5, [29, 200]] = sides[::5, [29, 200]] + 1
    anchor = rng.integers(0, 256, (1, 80), np.uint8).repeat(MOST_CONTEXTS, axis=0)
    contexts = [bytes(c) for c in np.hstack([sides[:, :120], anchor, sides[:, 120:]])]
    found = repeated_starts(contexts)
    want = np.zeros((MOST_CONTEXTS, 321), bool)
    want[::5, 30 : 280 - LENGTH + 1] = want[1::5, 30 : 280 - LENGTH + 1] = True
    assert np.array_equal(found, want.ravel()[:-1])


def test_memory_of_the_suffix_sort():
    """Shared passages in different surroundings, so that names recur and every level recurses."""
    rng = np.random.default_rng(7)
    passage = rng.integers(97, 123, 180, np.uint8).tobytes()
    contexts = [side[:60].tobytes() + passage + side[60:].tobytes() for side in rng.integers(97, 123, (1000, 120), np.uint8)]
    tracemalloc.start()
    try:
        found = repeated_starts(contexts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert not found.any() and peak < 50 * len(found)


def test_a_large_anchor_is_sorted_apart_from_what_waits(monkeypatch):
    """What a task sorts at a time exceeds the limit only by a single anchor's contexts."""
    sizes = {1: 3, 2: 3, 3: 9, 4: 2, 5: 12, 6: 1, 7: 1}
    rows = [(h, f"{h}", h, 7, k % 2 == 0, bytes([h]) * 100) for h, n in sizes.items() for k in range(n)]
    columns = ["h", "doc_id", "text_key", "first", "alone", "data"]
    batches = [pd.DataFrame(rows[k : k + 5], columns=columns) for k in range(0, len(rows), 5)]
    sorted_together = []

    def note(strings, length):
        sorted_together.append([s[0] for s in strings])
        return np.ones(101 * len(strings) - 1, bool)

    class Contexts:
        def mapInPandas(self, search, schema):
            return list(search(iter(batches)))

    monkeypatch.setattr(repeats, "repeated_starts", note)
    monkeypatch.setattr(repeats, "SORT_BYTES", 1000)
    out = pd.concat(repeats._sorted_out(Contexts(), 40))
    assert [sorted(set(s)) for s in sorted_together] == [[1, 2], [3], [4], [5], [6, 7]]
    assert sum(sorted_together, []) == [r[0] for r in rows]
    assert out.values.tolist() == [[r[1], r[2], 7, 106] for r in rows if r[4]]


def test_runs_merge_into_disjoint_ranges():
    rng = np.random.default_rng(8)
    for n in (1, 2, 5, 40):
        for reach in (1, 30, 300):
            begin = np.sort(rng.integers(0, 500, n))
            end = begin + rng.integers(1, reach + 1, n)
            covered = np.zeros(900, bool)
            touching = set()
            for a, b in zip(begin.tolist(), end.tolist()):
                covered[a:b] = True
                touching.add(a)
            spans = repeats._merged(begin, end)
            again = np.zeros(900, bool)
            for a, b in spans:
                assert a in touching and not again[a:b].any()
                again[a:b] = True
            assert np.array_equal(covered, again)
            assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_kept_texts_leave_a_task_in_slices(spark, monkeypatch):
    """A worker never holds what is kept of a whole batch."""
    docs = pd.DataFrame({"doc_id": [str(k) for k in range(50)], "data": [b"x" * (k * 100) for k in range(50)]})
    docs["spans"] = [[[0, 50], [60, 90]] if k % 3 == 1 else None for k in range(50)]
    sent = []

    class Done(Exception):
        pass

    def cut(self, function, schema):
        if "kept" in schema:
            sent.extend(function(iter([docs, docs[:0]])))
            raise Done
        return real(self, function, schema)

    frame_type = type(spark.range(1))
    real = frame_type.mapInPandas
    monkeypatch.setattr(frame_type, "mapInPandas", cut)
    monkeypatch.setattr(repeats, "CUT_BYTES", 5000)
    with pytest.raises(Done):
        remove_repeats(frame(spark, ["some text"]))
    assert max(part["n_bytes"].sum() for part in sent) < 5000 + 4900 and len(sent) > 10
    got = pd.concat(sent)
    assert got["doc_id"].tolist() == docs["doc_id"].tolist() and got["n_bytes"].tolist() == docs["data"].map(len).tolist()
    assert got["kept"].map(len).tolist() == [100 * k - (80 if k % 3 == 1 else 0) for k in range(50)]


def test_every_string_has_one_anchor_that_follows_its_bytes():
    data = np.random.default_rng(2).integers(97, 100, 900).astype(np.uint8).tobytes()
    data += data[100:400] + b"a" * 120
    seen = {}
    for places, first, last, hashes in anchors_of(data, 40, 8):
        assert first[0] == 0 and last[-1] == len(data) - 40 and (first[1:] == last[:-1] + 1).all()
        for p, a, b, h in zip(places.tolist(), first.tolist(), last.tolist(), hashes.tolist()):
            for i in range(a, b + 1):
                assert i <= p <= i + 32
                assert seen.setdefault(data[i : i + 40], (p - i, h)) == (p - i, h)


@pytest.mark.parametrize("most", [20_000, 1])
def test_repeats_against_all_strings(spark, most):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(15, 70))) for _ in range(8)]
    texts = ["".join(rng.choice([rng.choice(passages), "".join(rng.choice("xyz") for _ in range(9))]) for _ in range(6)) for _ in range(40)]
    texts += [None, "", "short", "z" * 90, "q" * 19, "q" * 20, texts[0]]
    length = 20
    raw = [(t or "").encode() for t in texts]
    count = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    got = {r.doc_id: r for r in remove_repeats(frame(spark, texts), length=length, anchor=8, most_contexts=most).collect()}
    for k, t in enumerate(raw):
        gone = {j for i in range(len(t) - length + 1) if count[t[i : i + length]] > 1 for j in range(i, i + length)}
        assert {j for a, b in got[k].spans for j in range(a, b)} == gone
        assert all(x[1] < y[0] for x, y in zip(got[k].spans, got[k].spans[1:]))
        assert bytes(got[k].kept) == bytes(c for j, c in enumerate(t) if j not in gone) and got[k].n_bytes == len(t)


def test_repeats_of_repeated_rows(spark):
    text = hashlib.sha256(b"x").hexdigest() * 4
    df = frame(spark, [(1, text), (1, text), (None, "other " * 3)])
    assert sorted((r.doc_id or 0, len(r.kept)) for r in remove_repeats(df).collect()) == [(0, 18), (1, 0), (1, 0)]
    assert remove_repeats(df.limit(0)).collect() == []


def brute_classes(rows, idf):
    cache = WordHashes()
    bags = [bag(cache.of(t or ""), idf) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] == rows[j][1] and any(c.isalnum() for c in rows[i][1] or "")
            if same or (len(bags[i][0]) and len(bags[j][0]) and similarity(bags[i], bags[j]) >= 0.8):
                root[find(i)] = find(j)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    return {(i, min(g)) for g in groups.values() for i in g}


def test_near_classes_against_all_pairs(spark):
    rng = random.Random(9)
    vocabulary = [f"word{k}" for k in range(400)]
    texts = []
    for _ in range(4):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(30)]
    texts += [texts[3], "two words", "two words", "Two words", "", None, "...", "", texts[120] + " " + texts[120]]
    df = frame(spark, texts)
    idf = word_idf(df.select("text").where("text IS NOT NULL AND text rlike '[a-z]'"))
    got = {tuple(r) for r in near_classes(df).collect()}
    assert got == brute_classes(list(enumerate(texts)), idf)
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got})


def test_near_classes_of_repeated_rows_and_nulls(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = frame(spark, [(3, text), (3, text), (2, text), (None, text + " more"), (None, None), (4, "")])
    got = sorted(((r.doc_id, r.class_id) for r in near_classes(df).collect()), key=repr)
    assert got == sorted([(3, 2), (2, 2), (None, 2), (None, None), (4, 4)], key=repr)
    kept = sorted((r.doc_id for r in keep_one_of_each(df).collect()), key=repr)
    assert kept == sorted([2, None, 4], key=repr)
    assert near_classes(df.limit(0)).collect() == []


def test_samples_agree_like_the_similarity():
    rng = np.random.default_rng(7)
    gamma = _gamma_levels()
    assert abs(gamma.mean() - 2) < 0.01 and (np.diff(gamma) > 0).all()
    agreed, wanted = [], []
    for _ in range(60):
        keys = np.unique(rng.integers(0, 2**63, 80).astype(np.uint64))
        w = rng.uniform(0.5, 3, len(keys))
        changed = w * rng.choice([0.3, 1, 1, 2], len(keys))
        a, b = (keys, w), (keys[10:], changed[10:])
        s = sample(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, len(keys)]), gamma, np.log(gamma))
        agreed.append((s[0] == s[1]).mean())
        wanted.append(similarity(a, b))
    assert abs(np.mean(agreed) - np.mean(wanted)) < 0.04 and s.shape == (2, SAMPLES)


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (103, 101), (7, 7), (5, 4)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {tuple(r) for r in connected_components(df).collect()}
    assert got == {(k, 1) for k in range(1, 41)} | {(100, 100), (101, 100), (103, 100)}
    assert connected_components(df.limit(0)).collect() == []


def test_idf_counts_documents(spark):
    df = spark.createDataFrame([("a a b",), ("a",), ("",)], "text string")
    idf = word_idf(df)
    slot = lambda w: int(WordHashes().of(w)[0]) & (BUCKETS - 1)
    assert idf[slot("a")] == pytest.approx(np.log(4 / 3) + 1) and idf[slot("b")] == pytest.approx(np.log(2) + 1)


def test_anchors_of_different_bytes_differ():
    """No two of a million anchors meet by chance."""
    rng = np.random.default_rng(11)
    found = [h for k in range(16) for _, _, _, h in anchors_of(rng.bytes(4 << 20))]
    hashes = np.concatenate(found)
    assert len(hashes) > 1_000_000 and len(np.unique(hashes)) == len(hashes)
    assert (hashes >> np.uint64(63)).mean() == pytest.approx(0.5, abs=0.01)


def test_a_large_cluster_of_long_texts(spark, monkeypatch):
    """Many near copies of one long text, in groups of a few that each get the hub's text once."""
    from pairloom.llm import near_dedup

    monkeypatch.setattr(near_dedup, "HUB_MEMBERS", 7)
    rnd = random.Random(6)
    words = [f"w{rnd.randrange(5000)}" for _ in range(2000)]
    rows = [(k, " ".join(f"x{k}" if i == 13 * k % 2000 else w for i, w in enumerate(words))) for k in range(300)]
    rows += [(1000 + k, " ".join(f"v{rnd.randrange(5000)}" for _ in range(2000))) for k in range(20)]
    found = {r.doc_id: r.class_id for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert found == {k: 0 if k < 1000 else k for k, _ in rows}
