"""Top-k search, licence scans, decontamination, archives."""

import base64
import hashlib
import struct
import textwrap

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from pairloom.llm import warc
from pairloom.llm.decontaminate import find_leaks, remove_leaked
from pairloom.llm.licences import HEADERS, directories, licence_texts, scan_licences
from pairloom.llm.topk import Block, _meeting, candidates, prepared, quantised, top_k

VECTORS = "vec_id long, embedding array<float>, score string, block string"


def brute_top(rows, k=5, every=50):
    good = [
        (i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(object))
        for i, v, *_ in rows
        if v and i is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    out = set()
    for q, x in {(i, tuple(v)) for i, v in good if i % every == 0}:
        hits = sorted((-int(sum(a * int(b) for a, b in zip(v, x))), i) for i, v in good if i != q and len(v) == len(x))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(hits[:k])}
    return out


def result(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=6) * rng.lognormal(sigma=1)], "x", "y") for i in range(300)]
    rows += [(300 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25], "x", "y") for i in range(60)]  # many ties
    rows += [(400, None, "", ""), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], "", ""), (402, [float("nan")] * 6, "", "")]
    rows += [(450, [float("inf")] * 6, "", ""), (500, [0.0] * 6, "", ""), (501, [], "", ""), (None, [1.0] * 6, "", "")]
    rows += [(550, [1.0, 2.0], "", ""), (551, [2.0, 1.0], "", ""), (600, [-9.0] * 6, "", "")]
    df = spark.createDataFrame(rows, VECTORS)
    assert result(top_k(df, block=16, query_block=3, seeds=20)) == brute_top(rows)
    assert result(top_k(df)) == brute_top(rows)


def test_spread_lengths_are_pruned(spark):
    """Blocks that meet hold far fewer products than all, also with one vector that is longer than all others."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=8) * rng.lognormal(sigma=1)], "x", "y") for i in range(6000)]
    rows.append((7001, [900.0] + [0.0] * 7, "", ""))
    df = spark.createDataFrame(rows, VECTORS)
    blocks, queries = prepared(quantised(df), 5, 50, 512, 64, 512)
    sizes = lambda table: {r.block: r.n for r in table.select("block", "n").collect()}
    n, q = sizes(blocks), sizes(queries)
    assert sum(n.values()) == 6001 and sum(q.values()) == 120
    products = sum(n[r.block] * q[r.q_block] for r in _meeting(blocks, queries).collect())
    assert products < 0.5 * 6001 * 120
    assert result(top_k(df, block=512, query_block=64, seeds=512)) == brute_top(rows)


def test_top_k_of_nothing(spark):
    assert top_k(spark.createDataFrame([], VECTORS)).collect() == []


def test_pruning_keeps_all_that_reach_the_bound():
    rng = np.random.default_rng(1)
    vectors = np.floor(256 * rng.normal(size=(500, 8)))
    vectors = vectors[np.argsort(-(vectors**2).sum(axis=1))]
    block = Block(8, np.arange(500, dtype="<i8").tobytes(), vectors.astype("<f8").tobytes())
    pruned = 0
    for query in np.floor(256 * rng.normal(size=(40, 8))):
        products = vectors @ query
        least = np.sort(products)[-4]
        rows = np.arange(500)[candidates(block, query, float(np.sqrt(query @ query)), float(least))]
        assert set(np.flatnonzero(products >= least)) <= set(rows)
        pruned += 500 - len(rows)
    assert pruned > 0


ITEM = "one two three four five six seven eight nine ten"
DOCS = "doc_id long, text string, item_id string, key string"


def test_leaks(spark):
    long_text = " ".join(f"w{i}" for i in range(5000))
    rows = [
        (1, f"{long_text} {ITEM.upper().replace(' ', ', ')}! {long_text}", "", ""),
        (2, "one two three four five six seven eight nine TEN", "", ""),
        (3, "one two three four five six seven eight nine", "", ""),  # 5 of 6 shingles
        (4, "one two three four five six seven eight", "", ""),  # 4 of 6
        (5, None, "", ""),
        (6, "", "", ""),
        (2, "one two three four five six seven eight nine TEN", "", ""),
        (2, "other text with the same id", "", ""),
        (None, ITEM, "", ""),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    items = spark.createDataFrame([(7, ITEM), (8, "too short"), (9, None), (10, "")], "item_id long, text string")
    for options in ({}, {"broadcast_keys": 0}):
        found = {tuple(r) for r in find_leaks(docs, items, **options).collect()}
        assert {(r[0], r[1], r[2], r[3]) for r in found} == {(1, 7, 6, 6), (2, 7, 6, 6), (3, 7, 5, 6), (None, 7, 6, 6)}
    kept = remove_leaked(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [4, 5, 6]
    assert remove_leaked(docs, items.limit(0)).count() == len(rows)
    assert find_leaks(docs.limit(0), items).count() == 0


def test_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("/a/LICENSE", mit),
        ("/a/b/COPYING.txt", gpl),
        ("/a/x.txt", "code\nno notice"),
        ("/a/b/c/y.txt", None),
        ("/a/b/z.txt", f"first\n# {mit.lower()}\nlast"),
        ("/a/c/empty", ""),
        ("/q/none.txt", "A licence to say something else entirely, with many words that are in no template at all."),
        ("top", "x"),
        (None, mit),
        (None, "x"),
    ]
    files = spark.createDataFrame([(*r, "a", "b") for r in rows], "path string, text string, score string, licence string")
    found = {(r.path, r.own_licence, r.inherited_licence, r.inherited_from, r.licence) for r in scan_licences(files).collect()}
    assert found == {
        ("/a/LICENSE", "MIT", None, None, "MIT"),
        ("/a/b/COPYING.txt", "GPL-3.0", None, None, "GPL-3.0"),
        ("/a/x.txt", None, "MIT", "/a/", "MIT"),
        ("/a/b/c/y.txt", None, "GPL-3.0", "/a/b/", "GPL-3.0"),
        ("/a/b/z.txt", "MIT", None, None, "MIT"),
        ("/a/c/empty", None, "MIT", "/a/", "MIT"),
        ("/q/none.txt", None, None, None, None),
        ("top", None, None, None, None),
        (None, "MIT", None, None, "MIT"),
        (None, None, None, None, None),
    }
    assert scan_licences(files.limit(0)).count() == 0


def test_licence_headers_and_whole_texts(spark):
    texts, headers = dict(licence_texts()), {text: licence for licence, text in HEADERS if len(text) > 150}
    rows, want = [], {}
    for k, (text, licence) in enumerate(headers.items()):
        wrapped = "\n".join(f" * {line}" for line in textwrap.wrap(text, 40 + 7 * (k % 4)))
        for n, whole in enumerate((wrapped, f"# {text} And then twenty other words " + "follow " * 20)):
            path = f"/h/{k}/{n}.c"
            rows.append((path, f"int first;\n/*\n{whole}\n*/\nint code;\n" + "x = y\n" * 50))
            want[path] = licence
    for licence, text in texts.items():
        rows.append((f"/t/{licence}/LICENSE", f"Copyright (c) 2020 Somebody\n\n{text}"))
        rows.append((f"/t/{licence}/x.c", "code"))
        want |= {f"/t/{licence}/LICENSE": licence, f"/t/{licence}/x.c": licence}
    for path, text, licence in [
        ("/s/1.c", "// SPDX-License-Identifier: BSD-3-Clause\nint a;", "BSD-3-Clause"),
        ("/s/2.c", "code\nLicensed under the Apache License, Version 2.0. " + "other " * 20, "Apache-2.0"),
        ("/s/3.c", "This work is licensed under the GNU\nGeneral Public License,\nversion 3.", "GPL-3.0"),
        ("/s/4.c", "This work is licensed under the GNU General Public License.", "GPL"),
        ("/s/5.c", "A licence to say something else entirely, with many words that are in no template at all.", None),
    ]:
        rows.append((path, text))
        want[path] = licence
    found = {r.path: r.licence for r in scan_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found == want


def test_directories(spark):
    rows = spark.createDataFrame([("/a/b/c",), ("a/b",), ("x",), ("/",)], "p string")
    got = {r.p: r.d for r in rows.select("p", directories(F.col("p")).alias("d")).collect()}
    assert got == {"/a/b/c": ["/a/b/", "/a/", "/"], "a/b": ["/a/", "/"], "x": ["/"], "/": ["/"]}


PAGES = "page_id long, url string, html string, payload string, n string"


def test_archives_round_trip(spark):
    big = "<p>ä" + "x" * 2000
    rows = [
        (1, "http://a/ b\r\nc", big, "", ""), (2, None, big, "", ""), (9, "http://c", big, "", ""), (3, "u", "small", "", ""),
        (4, "u", "small", "", ""), (5, "u", None, "", ""), (6, "u", "", "", ""), (9, "http://c", big, "", ""), (None, "u", big, "", ""),
        (7, "u", "y" * 3_000_000, "", ""),
    ]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert {i for i, r in by_id.items() if r.record_type == "revisit"} == {1, 2, None}
    assert all(by_id[i].refers_to == 9 for i in (1, 2, None)) and by_id[9].refers_to is None
    assert {i: by_id[i].payload_bytes for i in (1, 3, 5, 6, 7)} == {1: len(big) + 1, 3: 5, 5: 0, 6: 0, 7: 3_000_000}
    assert by_id[1].payload_digest == by_id[9].payload_digest and by_id[5].payload_digest == by_id[6].payload_digest
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def archive(records, dictionary=b"", between=b""):
    """Frames as in a file, with or without a dictionary."""
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
    return head + b"".join(between + packer.compress(r) for r in records)


def raw_record(page=b"payload", **changes):
    digest = __import__("hashlib").sha1(page).hexdigest()
    return warc.record("1", "http://a", page, len(page), digest, None, **changes)


def test_frames_with_dictionary_and_skippable_frames():
    words = [b"some words to learn from %d " % k * 20 for k in range(2000)]
    dictionary = zstandard.train_dictionary(4096, words).as_bytes()
    records = [raw_record(b"a" * n) for n in (0, 1, 300, 70_000, 300_000)]
    content = archive(records, dictionary, warc.EMPTY_FRAME.encode())
    assert [raw for _, raw in warc.frames(content)] == records
    # The dictionary may itself be compressed.
    packed = zstandard.ZstdCompressor().compress(dictionary)
    tail = content[8 + len(dictionary) :]
    again = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + tail
    assert [raw for _, raw in warc.frames(again)] == records
    with pytest.raises(ValueError, match="byte"):
        list(warc.frames(tail))  # without its dictionary


@pytest.mark.parametrize("cut", [1, 5, 40])
def test_cut_archives_fail(cut):
    with pytest.raises(ValueError):
        list(warc.frames(archive([raw_record()])[:-cut]))


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
        lambda r: r.replace(b"WARC-Date", b"X-Date"),
        lambda r: r + b"more",
        lambda r: r[:-4],
        lambda r: r.replace(b"payload", b"changed"),
        lambda r: r.replace(b"sha1:", b"sha1:A", 1),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response"),
    ],
)
def test_bad_records_fail(change):
    with pytest.raises((ValueError, KeyError)):
        warc.read_record(*warc.parse_record(change(raw_record())))


def test_good_record():
    row = warc.read_record(*warc.parse_record(raw_record(b"\r\n\r\n")))
    assert row["payload"] == b"\r\n\r\n" and row["payload_bytes"] == 4
    assert base64.b32encode(bytes.fromhex(row["payload_digest"])).decode() in raw_record(b"\r\n\r\n").decode()


def foreign(http: bytes, body: bytes, *fields: bytes, kind=b"response") -> bytes:
    """A record as other programs write them."""
    block = http + b"\r\n\r\n" + body
    head = [b"WARC/1.0", b"WARC-Type:" + kind, b"WARC-Record-ID: <urn:uuid:1234>", b"WARC-Date: 2020-01-01T00:00:00Z"]
    head += [b"WARC-Target-URI: <http://example.org/a b>", *fields, b"Content-Length:%d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


CHUNKS = b"5;x=y\r\nhello\r\nA\r\n, you all!\r\n0\r\nTrailer: z\r\n\r\n"
SHA = hashlib.sha1(b"hello, you all!").hexdigest()


@pytest.mark.parametrize(
    ("record", "payload", "digest"),
    [
        (foreign(b"HTTP/1.0 200", b"hello, you all!"), b"hello, you all!", SHA),
        (foreign(b"HTTP/1.1 200 OK\r\nServer:x\r\nX-Long: a\r\n  b", b"hi"), b"hi", hashlib.sha1(b"hi").hexdigest()),
        (foreign(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked", CHUNKS), b"hello, you all!", SHA),
        (foreign(b"HTTP/1.1 200 OK\r\ntransfer-encoding:chunked", CHUNKS, b"WARC-Payload-Digest: sha1:" + hashlib.sha1(CHUNKS).hexdigest().encode()), b"hello, you all!", None),
        (foreign(b"HTTP/1.1 200 OK\r\ntransfer-encoding:chunked", CHUNKS, b"WARC-Payload-Digest: SHA-1:" + SHA.upper().encode()), b"hello, you all!", SHA),
        (foreign(b"HTTP/1.1 200 OK\r\nContent-Length: 99", b"cut", b"WARC-Truncated: length"), b"cut", hashlib.sha1(b"cut").hexdigest()),
        (foreign(b"HTTP/1.1 200", b"x", b"WARC-Payload-Digest: sha256:" + hashlib.sha256(b"x").hexdigest().encode()), b"x", hashlib.sha1(b"x").hexdigest()),
        (foreign(b"HTTP/1.1 200", b"x", b"WARC-Payload-Digest: crc:77"), b"x", hashlib.sha1(b"x").hexdigest()),
    ],
)
def test_records_of_other_writers(record, payload, digest):
    row = warc.read_record(*warc.parse_record(record))
    assert row["payload"] == payload and row["payload_bytes"] == len(payload)
    assert digest is None or row["payload_digest"] == digest
    assert row["record_id"] == "urn:uuid:1234" and row["page_id"] is None and row["url"] == "http://example.org/a b"


@pytest.mark.parametrize(
    "record",
    [
        foreign(b"HTTP/1.1 200 OK\r\nContent-Length: 3", b"four"),
        foreign(b"HTTP/1.1 200 OK\r\ntransfer-encoding: chunked", b"5\r\nhel"),
        foreign(b"HTTP/1.1 200 OK", b"x", b"WARC-Payload-Digest: sha256:" + b"0" * 64),
        foreign(b"HTTP/1.1 200 OK", b"x", kind=b"revisit"),
    ],
)
def test_bad_records_of_other_writers(record):
    with pytest.raises(ValueError):
        warc.read_record(*warc.parse_record(record))


def test_archives_of_other_writers(spark, tmp_path):
    """Frames without the size of their content, an archive without a dictionary, other names of files and kinds of records."""
    records = [foreign(b"HTTP/1.1 200 OK", b"page %d " % k * 3000) for k in range(5)]
    records += [foreign(b"x", b"y", kind=b"request"), foreign(b"HTTP/1.1 200", b"", kind=b"revisit")]
    data = b""
    for raw in records:
        stream = zstandard.ZstdCompressor(write_checksum=True).compressobj()
        data += stream.compress(raw) + stream.flush()
        assert zstandard.frame_content_size(data) < 0
    (tmp_path / "crawl.warc.zst").write_bytes(data)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in rows if r.payload) == [b"page %d " % k * 3000 for k in range(5)]
    (again,) = [r for r in rows if r.record_type == "revisit"]
    assert again.payload is None and again.payload_bytes is None and again.refers_to is None
    with pytest.raises(ValueError, match="more than"):
        warc.unpacked(zstandard.ZstdDecompressor(), memoryview(data), most=100)
