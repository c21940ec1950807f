"""Sources, sinks, manifests, summaries, the whole run and the stream."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_stages import Words, as_dicts

import pairloom
from pairloom import schemas
from pairloom.functions.codecs import ExternalCodec, WordLengthCodec
from pairloom.operators import summaries as su
from pairloom.plans.preprocess import preprocess, training_plan
from pairloom.sources import pairs as src
from pairloom.sources import places, sinks, storage
from pairloom.streaming.prepare import prepare_stream, write_stream


def lines(path):
    return [json.loads(x) for f in sorted(Path(path).glob("part-*")) for x in f.read_text("utf-8").splitlines()]


@pytest.fixture
def raw(spark, tmp_path):
    """Thirty pairs in three parquet files, in file order."""
    for part in range(3):
        rows = [((f"de {part * 10 + i}", f"en {i}"),) for i in range(10)]
        df = spark.createDataFrame(rows, schemas.raw_pairs()).coalesce(1)
        df.write.parquet(str(tmp_path / f"raw/train/part={part}"))
    return str(tmp_path / "raw")


def numbers(df):
    return {int(r["translation"]["de"].split()[1]): r["id"] for r in df.collect()}


# --- loading ------------------------------------------------------------------


def test_ids_follow_file_order(spark, raw):
    df = pairloom.load(spark, raw, split="train", schema=schemas.raw_pairs())
    assert df.columns == ["translation", "part", "id"]
    assert numbers(df) == {i: i for i in range(30)}
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_ids_start_anywhere_and_rows_are_limited(spark, raw):
    df = pairloom.load(spark, raw, split="train", start_id=100, max_examples=13)
    assert numbers(df) == {i: 100 + i for i in range(13)}
    assert pairloom.load(spark, raw, split="train", max_examples=99).count() == 30
    without = pairloom.load(spark, raw, split="train", max_examples=13, include_ids=False)
    assert "id" not in without.columns and without.count() == 13


def test_ids_can_be_left_out(spark, raw):
    assert pairloom.load(spark, raw, split="train", include_ids=False).columns == ["translation", "part"]


def test_list_of_files_keeps_its_order(spark, raw):
    files = [f"{raw}/train/part={part}" for part in (2, 0)]
    expected = {20 + i: i for i in range(10)} | {i: 10 + i for i in range(10)}
    assert numbers(pairloom.load(spark, "parquet", split="train", data_files=files)) == expected
    chosen = pairloom.load(spark, "parquet", split="train", data_files={"train": files, "test": "nowhere"})
    assert numbers(chosen) == expected
    with pytest.raises(ValueError, match="no split"):
        pairloom.load(spark, "parquet", split="dev", data_files={"train": files})


@pytest.mark.parametrize("batch", [1, 2, 100])
def test_batches_of_files_give_the_same_ids(spark, raw, monkeypatch, batch):
    monkeypatch.setattr(places, "BROADCAST_FILES", batch)
    df = pairloom.load(spark, raw, split="train")
    assert numbers(df) == {i: i for i in range(30)}
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert numbers(pairloom.load(spark, raw, split="train", max_examples=25)) == {i: i for i in range(25)}
    files = [f"{raw}/train/part={part}" for part in (2, 0, 1)]
    listed = pairloom.load(spark, "parquet", split="train", data_files=files)
    assert numbers(listed) == {(20 + i) % 30: i for i in range(30)}


def test_json_lines_keep_their_order(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    rows = [{"translation": {"de": f"de {i}", "en": "Grüße"}} for i in range(500)]
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n\n", "utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert numbers(pairloom.load(spark, "json", split="train", data_files=str(path))) == {i: i for i in range(500)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_order_column_decides(spark, raw):
    df = pairloom.load(spark, raw, split="train", order_by=[F.desc("translation.de")], max_examples=2)
    assert numbers(df) == {9: 0, 8: 1}


def test_existing_ids(spark, tmp_path, make_pairs):
    make_pairs([("de 1", "x"), ("de 2", "y")], start_id=42).coalesce(1).write.parquet(str(tmp_path / "d/train"))
    with pytest.raises(ValueError, match="has a column"):
        pairloom.load(spark, str(tmp_path), name="d", split="train")
    df = pairloom.load(spark, str(tmp_path), name="d", split="train", overwrite_ids=True, start_id=100)
    assert numbers(df) == {1: 100, 2: 101}
    kept = pairloom.load(spark, str(tmp_path), name="d", split="train", include_ids=False)
    assert numbers(kept) == {1: 42, 2: 43}


def json_file(tmp_path, rows):
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in rows), "utf-8")
    return str(path)


def test_json_keeps_all_columns_and_its_ids(spark, tmp_path):
    pair = {"de": "a", "en": "b"}
    path = json_file(tmp_path, [{"id": 70, "web": "x", "translation": pair}, {"id": 5, "translation": pair, "n": 1}])
    with pytest.raises(ValueError, match="has a column"):
        pairloom.load(spark, "json", split="train", data_files=path)
    kept = pairloom.load(spark, "json", split="train", data_files=path, include_ids=False).collect()
    assert [(r.id, r.web, r.n, r.translation.en) for r in kept] == [(70, "x", None, "b"), (5, None, 1, "b")]
    new = pairloom.load(spark, "json", split="train", data_files=path, overwrite_ids=True).collect()
    assert sorted((r.id, r.web) for r in new) == [(0, "x"), (1, None)]


def test_flat_json(spark, tmp_path):
    path = json_file(tmp_path, [{"de": "a", "en": "b", "k": 1}, {"de": "c", "en": None}])
    rows = pairloom.load(spark, "json", split="train", data_files=path).orderBy("id").collect()
    assert [(tuple(r.translation), r.k) for r in rows] == [(("a", "b"), 1), (("c", None), None)]
    with pytest.raises(ValueError, match="no column 'translation'"):
        pairloom.load(spark, "json", split="train", data_files=json_file(tmp_path, [{"de": "a", "fr": "b"}]))
    with pytest.raises(ValueError, match="must hold an object"):
        pairloom.load(spark, "json", split="train", data_files=json_file(tmp_path, [{"translation": "a"}]))


def test_bad_json_is_an_error(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"translation": {"de": "a", "en": "b"}}\n\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        src.read_records(spark, str(path), schemas.raw_pairs()).collect()


# --- sinks --------------------------------------------------------------------


def test_json_snapshot(spark, tmp_path, make_pairs):
    df = make_pairs([("Grüße „x“", None), ('"q"\n', "b")])
    path = str(tmp_path / "deep/er/x.jsonl")
    sinks.write_jsonl(df.coalesce(1), path)
    assert lines(path)[0] == {"id": 0, "translation": {"de": "Grüße „x“", "en": None}}
    assert "Grüße" in next(Path(path).glob("part-*")).read_text("utf-8")
    assert as_dicts(src.read_records(spark, path, df.schema)) == as_dicts(df)


def test_dataset_with_schema(spark, tmp_path):
    df = spark.createDataFrame([("1", ["2"], ["3"])], "id string, src_ids array<string>, tgt_ids array<string>")
    saved = sinks.save_dataset(df, str(tmp_path / "d"), schemas.training_rows())
    assert saved.first().asDict() == {"id": 1, "src_ids": [2], "tgt_ids": [3]}
    assert sinks.write_dataset(spark.range(17).repartition(3), str(tmp_path / "n")) == 17


def test_manifest_covers_ids_above_the_vocabulary():
    codec = ExternalCodec(Words, "words")
    manifest = sinks.dataset_manifest(codec, src_lang="de", tgt_lang="en", num_examples=3, max_seq_len=9)
    assert list(manifest) == schemas.DATASET_MANIFEST.fieldNames()
    assert (manifest["base_vocab_size"], manifest["src_vocab_size"], manifest["tgt_vocab_size"]) == (59, 59, 60)
    codec = WordLengthCodec(vocab_size=None)
    with pytest.raises(ValueError, match="vocab_size"):
        sinks.dataset_manifest(codec, src_lang="de", tgt_lang="en", num_examples=3)


def test_text_export(spark, tmp_path):
    df = spark.createDataFrame([(1, [2, 1], [1, 3, 0])], schemas.training_rows())
    sinks.export_texts(df, ExternalCodec(Words, "words"), str(tmp_path / "t"))
    assert lines(tmp_path / "t") == [{"src": "xx x", "ref": "x xxx"}]


def test_old_report_files(spark, tmp_path):
    path = tmp_path / "flaw_report.txt"
    path.write_text(
        "{'seq_no': 11, 'de_flaws': ['is_too_long(max=300)'], 'en_flaws': [], 'pair_flaws': []}\n\n"
        "{'seq_no': 24, 'de_flaws': ['is_too_long(max=300)'], 'en_flaws': ['is_too_long(max=300)'], 'pair_flaws': ['are_equal']}\n"
    )
    with path.open("a") as f:
        f.write("[1, {'a': 2}]\n'text'\n-3.5\nNone\n   \n")
    report = src.read_report(spark, str(path), schemas.flaw_report())
    assert report.count() == 2
    assert [r.asDict() for r in su.flaw_counts(report).collect()] == [
        {"label": "is_too_long(max=300)", "de": 2, "en": 1, "total": 3}
    ]
    assert [tuple(r) for r in su.pair_flaw_counts(report).collect()] == [("are_equal", 1)]


def test_printed_reports(spark, tmp_path):
    records = [
        {"seq_no": 1, "removed_id": None, "text": "a\x01b\xa0c", "flag": True},
        {"seq_no": 2, "removed_id": 3, "text": "it's \"None\", 'True' \\ and \\x41\n\tend", "flag": False},
        {"seq_no": 3, "removed_id": None, "text": "it's None: x", "flag": None},
        {"seq_no": 4, "removed_id": 5, "text": 'say "x", None', "flag": True},
        {"seq_no": 5, "removed_id": 5, "text": "", "flag": True},
    ]
    path = tmp_path / "report.txt"
    path.write_text("\n".join(map(repr, records)) + "\n" + json.dumps(records[1]) + "\n", "utf-8")
    schema = "seq_no long, removed_id long, text string, flag boolean"
    got = [r.asDict() for r in src.read_report(spark, str(path), schema).collect()]
    assert got == [*records, records[1]]


def test_tables_of_a_run_are_removed(spark, tmp_path):
    before = set(Path(storage.shared_dir(spark)).iterdir())
    with pytest.raises(RuntimeError, match="stop"), storage.stored_tables(spark) as folder:
        assert storage.materialize(spark.range(5), "x").count() == 5
        assert Path(folder).is_dir()
        raise RuntimeError("stop")
    assert set(Path(storage.shared_dir(spark)).iterdir()) == before


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, configured=None, on_context=None, master="local[2]"):
        self.conf = {storage.CHECKPOINT_DIR: configured}
        self.sparkContext = self
        self.master, self.folder = master, on_context

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert storage.shared_dir(Session("hdfs:///shared/", "other", "yarn")) == "hdfs:///shared"
    assert storage.shared_dir(Session(None, "hdfs:///own", "yarn")) == "hdfs:///own"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session(master="yarn"))
    local = Session()
    assert storage.shared_dir(local) == storage.shared_dir(local)


@pytest.mark.parametrize("line", ["{'seq_no': 1", "garbage", "{1}", "None of these"])
def test_bad_report_lines(spark, tmp_path, line):
    path = tmp_path / "report.txt"
    path.write_text(f"{{'seq_no': 11, 'de_flaws': []}}\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        src.read_report(spark, str(path), schemas.flaw_report()).collect()


# --- splits -------------------------------------------------------------------

MANIFEST = dict.fromkeys(schemas.DATASET_MANIFEST.fieldNames(), 7) | {
    name: "x" for name in ("tokenizer_model_name", "src_lang", "tgt_lang", "id_field", "src_field", "tgt_field")
}


@pytest.fixture
def dataset(spark, tmp_path):
    path = str(tmp_path / "set")
    rows = [(i, [7] * (i + 1), [8, 9 - i]) for i in range(5)]
    spark.createDataFrame(rows, schemas.training_rows()).write.parquet(path)
    sinks.write_manifest(spark, MANIFEST, schemas.DATASET_MANIFEST, f"{path}/{sinks.MANIFEST}")
    return path


def test_splits_and_manifests_are_written(spark, dataset):
    ratios = {"train": 0.6, "val": 0.2, "test": 0.2}
    assert pairloom.split(spark, dataset, ratios, 7) == {"train": 3, "val": 1, "test": 1}
    seen = []
    for name, count in (("train", 3), ("val", 1), ("test", 1)):
        path = sinks.split_path(dataset, name)
        rows = spark.read.parquet(path).collect()
        assert len(rows) == count
        seen += [r["id"] for r in rows]
        assert sinks.read_manifest(spark, f"{path}/{sinks.MANIFEST}") == {**MANIFEST, "num_examples": count}
        assert sinks.read_manifest(spark, f"{path}/{sinks.SPLIT_INFO}", schemas.SPLIT_MANIFEST) == {
            "source_dataset": dataset,
            "split_name": name,
            "split_seed": 7,
            "split_ratio": ratios,
            "num_examples": count,
        }
    assert sorted(seen) == [0, 1, 2, 3, 4]


def test_splits_of_repeated_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "set")
    rows = [(i % 3 if i % 4 else None, [i], [1]) for i in range(40)]
    spark.createDataFrame(rows, schemas.training_rows()).repartition(3).write.parquet(path)
    sinks.write_manifest(spark, MANIFEST, schemas.DATASET_MANIFEST, f"{path}/{sinks.MANIFEST}")
    assert pairloom.split(spark, path, {"a": 0.35, "b": 0.4, "c": 0.25}, 3) == {"a": 14, "b": 16, "c": 10}
    seen = [r["src_ids"][0] for name in "abc" for r in spark.read.parquet(sinks.split_path(path, name)).collect()]
    assert sorted(seen) == list(range(40))


def test_split_checks_come_before_any_output(spark, dataset, tmp_path):
    ratios = {"train": 0.5, "test": 0.5}
    with pytest.raises(ValueError, match="dataset"):
        pairloom.split(spark, None, ratios, 1)
    with pytest.raises(FileNotFoundError):
        pairloom.split(spark, str(tmp_path / "missing"), ratios, 1)
    spark.range(1).write.parquet(sinks.split_path(dataset, "test"))
    with pytest.raises(FileExistsError, match="split-test"):
        pairloom.split(spark, dataset, ratios, 1)
    assert not Path(sinks.split_path(dataset, "train")).exists()
    spark.range(1).write.parquet(str(tmp_path / "bare"))
    with pytest.raises(FileNotFoundError, match="manifest"):
        pairloom.split(spark, str(tmp_path / "bare"), ratios, 1)


# --- summaries ----------------------------------------------------------------


def test_char_lengths(spark):
    nested = spark.createDataFrame([(("Tür", "a door"),), (("Ölbaum", "tree"),), ((None, "x"),), (None,)], schemas.raw_pairs())
    flat = spark.createDataFrame([("Tür", "a door"), ("Ölbaum", "tree"), ("x", None)], "de string, en string")
    text = flat.withColumn("translation", F.lit("no struct"))
    for df in (nested, flat, text):
        assert sorted(map(tuple, su.char_lengths(df).collect())) == [(3, 6), (6, 4)]


def test_token_lengths_skip_incomplete_rows(spark):
    tokens = "tokenized_translation struct<de: struct<input_ids: array<int>>, en: struct<input_ids: array<int>>>"
    rows = [((([10, 11, 0],), ([20, 21, 22, 0],)),), ((([30, 0],), ([40, 41, 0],)),), (None,), ((([1],), (None,)),)]
    df = spark.createDataFrame(rows, tokens)
    assert sorted(map(tuple, su.token_lengths(df).collect())) == [(2, 3), (3, 4)]


@pytest.mark.parametrize(
    "low, high, bins, expected",
    [(None, None, 60, (-0.5, 1, 1)), (1, 100, 10, (0.5, 10, 10)), (5, 5, 60, (4.5, 1, 1)), (0, 60, 60, (-0.5, 2, 31))],
)
def test_histogram_edges(low, high, bins, expected):
    assert su.histogram_edges(low, high, bins) == expected


def test_length_histogram(spark):
    lengths = spark.createDataFrame([(1, 2), (3, 100)], "de int, en int")
    rows = as_dicts(su.length_histogram(lengths, max_bins=10), "bin")
    assert len(rows) == 10 and rows[0]["lower"] == 0.5 and rows[-1]["upper"] == 100.5
    assert [(r["bin"], r["de"], r["en"]) for r in rows if r["de"] or r["en"]] == [(0, 2, 1), (9, 0, 1)]
    assert as_dicts(su.length_histogram(lengths.limit(0)), "bin") == [
        {"bin": 0, "lower": -0.5, "upper": 0.5, "de": 0, "en": 0}
    ]


def test_label_counts(spark):
    report = spark.createDataFrame(
        [(["a", "b"], ["a"]), (["c"], ["c", "c"]), ([], [])], "de_norm_changes array<string>, en_norm_changes array<string>"
    )
    assert [tuple(r) for r in su.norm_change_counts(report).collect()] == [("c", 1, 2, 3), ("a", 1, 1, 2), ("b", 1, 0, 1)]


# --- the whole run ------------------------------------------------------------

OPTIONS = {
    "norm_options": {"changes": ["strip_edges", "collapse_whitespace"]},
    "filter_options": {"predicates": ["is_blank", "contains_url"], "pair_predicates": ["are_equal"]},
    "tokenize_options": {"max_seq_len": 4},
}
TEXTS = [
    ("  gut   so ", "good"),
    ("gleich", "Gleich"),
    ("siehe a.de/x", "see"),
    ("eins zwei drei vier fünf", "one"),
    ("vier", "north south east west"),
    ("ja", "yes  sir"),
]


@pytest.fixture
def raw_texts(spark, tmp_path):
    spark.createDataFrame([(t,) for t in TEXTS], schemas.raw_pairs()).coalesce(1).write.parquet(str(tmp_path / "in/train"))
    return str(tmp_path / "in")


@pytest.mark.parametrize("staged", [False, True])
def test_preprocess(spark, tmp_path, raw_texts, staged):
    staging = str(tmp_path / "staging") if staged else None
    output = str(tmp_path / "out")
    manifest = preprocess(
        spark,
        output,
        ExternalCodec(Words, "words"),
        load_options={"path_name": raw_texts, "split": "train"},
        map_options={"src_lang": "de", "tgt_lang": "en", "include_text": True},
        split_options={"split_ratio": {"train": 0.5, "test": 0.5}, "seed": 1},
        staging=staging,
        dataset_name="texts",
        **OPTIONS,
    )
    rows = as_dicts(spark.read.parquet(output))
    assert rows == [
        {"id": 0, "src_ids": [3, 2], "tgt_ids": [59, 4, 0], "src_text": "gut so", "tgt_text": "good"},
        {"id": 5, "src_ids": [2], "tgt_ids": [59, 3, 3, 0], "src_text": "ja", "tgt_text": "yes sir"},
    ]
    assert manifest["num_examples"] == 2 and manifest["configured_max_seq_len"] == 4
    assert sinks.read_manifest(spark, f"{output}/{sinks.MANIFEST}") == manifest
    assert sum(spark.read.parquet(sinks.split_path(output, n)).count() for n in ("train", "test")) == 2
    if not staged:
        return
    counts = {stage: len(lines(f"{staging}/texts_{stage}.jsonl")) for stage in ("load", "norm", "filter", "tokenize", "map")}
    assert counts == {"load": 6, "norm": 6, "filter": 4, "tokenize": 2, "map": 2}
    assert [r["seq_no"] for r in lines(f"{staging}/norm_report")] == [1, 6]
    flaws = sorted(lines(f"{staging}/filter_report"), key=lambda r: r["seq_no"])
    assert [(r["seq_no"], r["de_flaws"], r["pair_flaws"]) for r in flaws] == [(2, [], ["are_equal"]), (3, ["contains_url"], [])]
    report = src.read_report(spark, f"{staging}/tokenize_report", schemas.tokenize_report())
    assert [(r["seq_no"], r["removed_id"]) for r in report.orderBy("seq_no").collect()] == [(1, None), (2, 3), (3, 4), (4, None)]


@pytest.mark.parametrize(
    "changed, message",
    [
        ({"tokenize_options": {"src_lang": "en"}}, "src_lang"),
        ({"map_options": {"src_lang": "de", "tgt_lang": "en", "id_key": "key"}}, "id field"),
        ({"map_options": {"src_lang": "de", "tgt_lang": "en", "tgt_bos_id": 3}}, "tgt_bos_id"),
        ({"map_options": {"src_lang": "de", "tgt_lang": "en", "tgt_eos_id": 3}}, "tgt_eos_id"),
    ],
)
def test_conflicting_options(spark, raw_texts, tmp_path, changed, message):
    options = {
        "load_options": {"path_name": raw_texts, "split": "train"},
        "map_options": {"src_lang": "de", "tgt_lang": "en"},
        **changed,
    }
    with pytest.raises(ValueError, match=f"Conflicting {message}"):
        preprocess(spark, str(tmp_path / "o"), WordLengthCodec(), **options)


def test_run_has_no_shuffle(spark, raw_texts):
    pairs = pairloom.load(spark, raw_texts, split="train")
    df = training_plan(pairs, WordLengthCodec(), map_options={"src_lang": "de", "tgt_lang": "en"}, **OPTIONS)
    shown = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in shown and "Exchange rangepartitioning" not in shown


def test_stream_gives_the_same_rows(spark, tmp_path, make_pairs):
    df = make_pairs(TEXTS)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    options = dict(map_options={"src_lang": "de", "tgt_lang": "en", "tgt_bos_id": 1, "tgt_eos_id": 0}, **OPTIONS)
    codec = ExternalCodec(Words, "words")
    batch = as_dicts(training_plan(df, codec, **options))
    for _ in range(2):  # the second start finds nothing new
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = write_stream(prepare_stream(stream, codec, **options), str(tmp_path / "out"), str(tmp_path / "progress"))
        assert query.awaitTermination(120)
        assert as_dicts(spark.read.parquet(str(tmp_path / "out"))) == batch
