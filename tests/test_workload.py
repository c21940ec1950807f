"""The tables of the queries, and what their runs shuffle and write."""

import importlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_sources_and_runs import OPTIONS, TEXTS
from test_stages import Words, plan

from pairloom import schemas
from pairloom.functions.codecs import Codec, ExternalCodec
from pairloom.operators.encode import SLICE_BYTES, encode_pairs
from pairloom.plans.preprocess import preprocess
from pairloom.sources.pairs import load_pairs
from pairloom.sources.storage import materialize, stored_tables
from workload import fixtures

IDS = [0, 1, 1, 2, 2, 5, 62, 63, 64, 64, 65, 127, 128, -1, -64, -65, 1 << 40, None, None]


@pytest.mark.parametrize("ordered", [False, True])
def test_pairs_are_the_left_join_with_one_shuffle(spark, monkeypatch, ordered):
    rows = [(i, None if k % 5 == 4 else f"text {k}") for k, i in enumerate(IDS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).checkpoint()
    monkeypatch.setattr(fixtures, "documents", lambda spark, sf_dir: docs)
    got = fixtures.flat_pairs(spark, "", ordered=ordered)
    assert plan(got).count("Exchange") == 1
    joined = spark.sql(fixtures.PAIRS.replace("FROM documents a", "FROM {documents} a").replace("documents b", "{documents} b"), documents=docs)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, joined.collect()), key=repr)
    if ordered:
        ids = [r["id"] for r in got.collect()]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_staged_run_with_compressed_snapshots(spark, tmp_path):
    spark.createDataFrame([(t,) for t in TEXTS], schemas.raw_pairs()).coalesce(1).write.parquet(str(tmp_path / "in/train"))
    found = []
    for compression in (None, "gzip"):
        staging = tmp_path / f"staging-{compression}"
        preprocess(
            spark, str(tmp_path / f"out-{compression}"), ExternalCodec(Words, "words"),
            load_options={"path_name": str(tmp_path / "in"), "split": "train"},
            map_options={"src_lang": "de", "tgt_lang": "en"},
            staging=str(staging), staging_compression=compression, **OPTIONS,
        )
        parts = [p.name for p in staging.glob("*/part-*")]
        assert parts and all(name.endswith(".gz") == (compression == "gzip") for name in parts)
        found.append({p.name: sorted(r["value"] for r in spark.read.text(str(p)).collect()) for p in staging.iterdir()})
    assert found[0] == found[1] and len(found[0]) == 8


def test_staged_run_stores_normalized_texts_only(spark, tmp_path, monkeypatch):
    """The texts as loaded go to their snapshot, not into the stored table of the checked ones, too."""
    module, stored = importlib.import_module("pairloom.plans.preprocess"), {}
    monkeypatch.setattr(module, "materialize", lambda df, name, *more: stored.update({name: df.columns}) or materialize(df, name, *more))
    spark.createDataFrame([(t,) for t in TEXTS], schemas.raw_pairs()).write.parquet(str(tmp_path / "in/train"))
    preprocess(
        spark, str(tmp_path / "out"), ExternalCodec(Words, "words"),
        load_options={"path_name": str(tmp_path / "in"), "split": "train"},
        map_options={"src_lang": "de", "tgt_lang": "en"}, staging=str(tmp_path / "staging"), **OPTIONS,
    )
    assert stored["checked"] == ["translation", "id", "de_norm_changes", "en_norm_changes", "de_flaws", "en_flaws", "pair_flaws"]
    assert len(list(Path(tmp_path / "staging/dataset_load.jsonl").glob("part-*"))) > 0


def test_rows_by_order_column_are_stored_once_and_small(spark, tmp_path):
    spark.range(100).selectExpr("id AS position", "struct(repeat('a', 9) AS de, 'b' AS en) AS translation").write.json(str(tmp_path / "in"))
    with stored_tables(spark) as folder:
        rows = load_pairs(spark, "json", split="train", data_files=str(tmp_path / "in"), order_by=[F.desc("position")])
        assert [(r["id"], r["position"]) for r in rows.orderBy("id").collect()] == [(i, 99 - i) for i in range(100)]
        parts = list(Path(folder.removeprefix("file:")).glob("*/part-*"))
    assert parts and all(p.name.endswith(".zstd.parquet") and p.parent.name.startswith("sequence-") for p in parts)


class Noting(Codec):
    """Notes in every encoding how many bytes of text were encoded with it."""

    name, fields = "noting", ("input_ids", "attention_mask")

    def encode_batch(self, texts, **options):
        total = sum(len(text.encode()) for text in texts)
        return [{"input_ids": [len(text), total, len(texts)], "attention_mask": [1]} for text in texts]


def test_a_codec_gets_bounded_slices_of_a_batch(spark):
    """What it returns would else grow with the batch, which is as large as 64 MB."""
    lengths = [0, 300_000, 5, 700_000, 2_500_000, 1, 0, 900_000, 200_000, 0]
    rows = spark.range(len(lengths), numPartitions=1).select("id", F.element_at(F.lit(lengths), (F.col("id") + 1).cast("int")).alias("n"))
    text = F.when(F.col("n") > 0, F.expr("repeat('ä', n)"))
    encoded = encode_pairs(rows.select("id", F.struct(text.alias("de"), F.lit("x").alias("en")).alias("translation")), Noting())
    ids = [r[0] for r in encoded.orderBy("id").select("tokenized_translation.de.input_ids").collect()]
    assert [i[0] for i in ids] == lengths
    # One text more than fits at most.
    assert all(total <= SLICE_BYTES + 2 * max(lengths) and count < len(lengths) for _, total, count in ids)
    assert [r[0] for r in encoded.where("id < 0").collect()] == []
    assert {tuple(r[0]) for r in encoded.select("tokenized_translation.en.input_ids").collect()} == {(1, len(lengths), len(lengths))}
