"""Packing, language identification, importance resampling."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm.hashing import WordHashes
from pairloom.llm.language import identify, keep_identified
from pairloom.llm.packing import fill_windows, pack, power_lengths
from pairloom.llm.resample import BUCKETS, kth_largest, ngram_counts, resample
from pairloom.llm.tokens import ChunkEncoder, tokenizer_file

DOCS = "doc_id long, text string, start string, key string, lang_pred string"
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def content():
    pytest.importorskip("public_tokenizers")
    return tokenizer_file()


TEXTS = [
    "a  b", " a", "a ", "a\n\nb", "x\t\ty z", "a \n b.", 'don\'t "q," a...b. c', "a\xa0 b\x1c c", "\n", "   ", "end.\n", "A,b,c. D.,", "x\0y z",
    "we'll, they've. it's; 12:30, 5.", "日本語 テキスト。 ー", "é́ ñ. ß\r\n\r\nz", "a\n\t\tb 　c", "<|endoftext|> x<|endoftext|>. y", "", "..", "x.", "😀 , 😀,",
]


ODD_TEXTS = [
    "x" * 700 + " y", " " * 700, "\n \t" * 300 + "z", "ab12" * 200, "naïve Größe – „ja“ 5€ it’s ’s “q” …", "Ωμέγα Ёж ѓ", "a\u2028b\u2009c\u202fd",
    "\x85a\x1cb\xadc\x7f", "²³¼ ª º ÷×", "x\ttab\r\nline  two", "I'll he's WE'VE'd'", "\u0378\u0380 \u0250 \u2071", "a\u0301 \u0483",
]


@pytest.mark.parametrize("merge", [True, False])
def test_encoder_gives_the_tokenizers_ids(content, merge):
    encoder, own = ChunkEncoder(content, most=5, group=10, merge=merge), Tokenizer.from_str(content)
    assert (encoder.merging is not None) == merge
    rng = np.random.default_rng(0)
    texts = TEXTS + ODD_TEXTS + ["".join(rng.choice(list(" \n\tab.,'7é–ß’日€\xa0")) for _ in range(30)) for _ in range(600)]
    for got, text in zip(encoder.encode(texts), texts, strict=True):
        assert got.tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_known_characters_are_classed_alike(content):
    """Every character that the faster library is trusted with, beside a letter, a digit, a space and itself."""
    encoder, own = ChunkEncoder(content), Tokenizer.from_str(content)
    known = [chr(c) for c in range(0x3000) if encoder._merges(chr(c))]
    assert len(known) > 700 and not {"\x85", "\xa0", "\u2028", "\u0250"} & set(known)
    texts = [f"a{c}1{c}{c} {c}b  {c}\n{c}" for c in known]
    for got, text in zip(encoder.encode(texts), texts, strict=True):
        assert got.tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_only_plain_tokenizers_are_merged_elsewhere(content):
    import json

    from pairloom.llm.tokens import merge_encoding

    spec = json.loads(content)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"model": spec["model"] | {"dropout": 0.1}}):
        assert merge_encoding(json.dumps(spec | change)) is None


def check_pieces(rows, texts, content, window):
    own = Tokenizer.from_str(content)
    want = [np.array(own.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in texts]
    left = defaultdict(list)
    for (i, _), ids in zip(texts, want):
        left[i].append(ids)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, pieces in by_doc.items():
        if len(left[i]) == 1:
            (ids,) = left[i]
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                at += r.length
                assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
            assert at == len(ids)
    assert sum(r.length for r in rows) == sum(map(len, want))
    for parts in sequences.values():
        total = 0
        for offset, length in sorted(parts):
            assert offset == total and length > 0
            total += length
        assert total == window or total & (total - 1) == 0


def test_packing(spark, content):
    rng = np.random.default_rng(1)
    topics = [[f"topic{t}word{k}" for k in range(30)] for t in range(4)]
    texts = [(k, " ".join(rng.choice(topics[k % 4], rng.integers(1, 60)))) for k in range(60)]
    texts += [(100, None), (101, ""), (102, "long " * 3000), (None, "no id"), (103, "again"), (103, "again"), (9007199254740993, "big id")]
    df = spark.createDataFrame([(*t, "a", "b", "c") for t in texts], DOCS)
    for options in ({"window": 128}, {"window": 128, "shard_units": 7}):
        check_pieces(pack(df, content, **options).collect(), texts, content, 128)
    assert pack(df.limit(0), content).collect() == []


def test_neighbours_share_windows():
    rng = np.random.default_rng(2)
    units = [rng.integers(1000 * (k % 5), 1000 * (k % 5) + 40, 30).astype(np.uint32) for k in range(100)]
    idf = np.ones(5000)
    sequences = fill_windows(units, idf, 30.0, 120)
    assert all(sum(p[2] for p in s) == 120 for s in sequences[:-1])
    mixed = sum(len({u % 5 for u, _, _ in s}) > 1 for s in sequences)
    assert mixed <= 5  # only where a topic runs out


def test_power_lengths():
    pieces = [(0, 0, 700), (1, 3, 800)]
    out = power_lengths(pieces, 2048)
    sums = [sum(p[2] for p in s) for s in out]
    assert sum(sums) == 1500 and all(n & (n - 1) == 0 for n in sums)
    assert power_lengths([(0, 0, 2048)], 2048) == [[(0, 0, 2048)]]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_languages_of_held_out_documents(spark, documents):
    rows = identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert len(held) > 20 and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_do_not_look_at_labels_or_ids(spark, documents):
    """Held-out rows get the same prediction with other labels, sources and, if all stay held out, ids."""
    blind = documents.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 != 1, F.col("lang"))).withColumn("source", F.lit("x"))
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(documents).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in identify(blind).collect()}
    assert a == b


def test_languages_of_odd_texts(spark, documents):
    odd = [(-1, None, "en"), (-2, "", "en"), (-3, "12 34 -- !", None), (None, "the and of that", None), (-4, "𝔘 " * 5, None)]
    docs = documents.select("doc_id", "text", "lang").union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    docs = docs.withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit("l"))
    got = {r.doc_id: r for r in identify(docs).collect()}
    assert all((got[k].lang_pred, got[k].score) == ("und", 0.0) for k in (-1, -2, -3))
    assert got[None].held_out is False and got[-4].lang_pred != "und"
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and not {-1, -2, -3} & {r.doc_id for r in kept.collect()}
    assert {r.score for r in kept.select("score").collect()} == {"s"}
    nothing = identify(documents.limit(0))
    assert nothing.collect() == []
    unlabelled = identify(documents.limit(3).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_unlearnt_languages_and_noise_go(spark, documents):
    rng = np.random.default_rng(4)
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    ]
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), n)) for n in (60, 200, 2000, 20_000)]
    rows = [(-1 - k, text, None) for k, text in enumerate(foreign + noise)]
    clean = documents.select("doc_id", "text", "lang")
    docs = clean.union(spark.createDataFrame(rows, "doc_id long, text string, lang string")).withColumn("distance", F.lit("d"))
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and {r.distance for r in kept.collect()} == {"d"}
    ids = {r.doc_id for r in kept.collect()}
    assert not {r[0] for r in rows} & ids
    assert {r.doc_id for r in clean.collect()} <= ids


LABELS = "doc_id long, quality int, toxic int"


def test_weights_against_plain_counts(spark):
    texts = [(k, ("good words here " if k % 2 else "bad stuff there ") * (k % 7 + 1)) for k in range(50)] + [(90, None), (91, ""), (92, "...")]
    labels = [(k, k % 2, 0) for k in range(20)] + [(1, 1, 1), (None, 1, 0), (3, None, None), (777, 1, 0)]
    docs = spark.createDataFrame([(*t, "a", "b", "c") for t in texts], DOCS)
    got = {r.doc_id: r for r in resample(docs, spark.createDataFrame(labels, LABELS), fraction=0.3).collect()}
    cache = WordHashes()
    counts = {k: ngram_counts(cache.of(t or ""), BUCKETS) for k, t in texts}
    raw = 1.0 + sum(counts.values())
    target = 1.0 + sum(counts[k] for k in range(20) if k % 2 and k != 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for k in range(50):
        assert got[k].log_weight == pytest.approx(float(counts[k] @ ratio))
    assert all(got[k].log_weight is None and not got[k].selected for k in (90, 91, 92))
    keys = sorted((got[k].sample_key for k in range(50)), reverse=True)
    assert {k for k in range(50) if got[k].selected} == {k for k in range(50) if got[k].sample_key >= keys[14]}


def test_resampling_of_nothing_and_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "", "", ""), (1, "a b", "", "", ""), (None, "c", "", "", "")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert resample(docs.limit(0), none).collect() == []
    rows = resample(docs, none, fraction=1.0).collect()
    assert len(rows) == 3 and all(r.selected for r in rows)


@pytest.mark.parametrize("k", [1, 17, 11_000, 20_000, 30_000])
def test_kth_largest(spark, k):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=15_000), np.full(5_000, 0.25)]).tolist()
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert kth_largest(df, "x", k) == sorted(values, reverse=True)[min(k, 20_000) - 1]
    assert kth_largest(df, "x", 0) is None and kth_largest(df.limit(0), "x", 3) is None
    assert math.isfinite(kth_largest(df, "x", k))


def test_packing_in_many_parts(spark, content, monkeypatch):
    """Parts of the keys' range, of which one key alone has more than a part."""
    from pairloom.llm import packing

    monkeypatch.setattr(packing, "PARTITION_TOKENS", 300)
    texts = [(k, f"alpha w{k % 50} beta w{k % 7} gamma") for k in range(150)] + [(1000 + k, "the same words again") for k in range(150)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    packed = packing.pack(docs, content, window=64)
    rows = packed.collect()
    check_pieces(rows, texts, content, 64)
    assert packed.rdd.getNumPartitions() > 5
    assert len({r.sequence_id >> 40 for r in rows}) > 5
