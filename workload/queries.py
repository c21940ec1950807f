"""One query per operator, over the given tables."""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.functions.codecs import ExternalCodec, WordLengthCodec, training_token_ids
from pairloom.functions.registry import (
    CHANGES,
    PREDICATES,
    resolve_changes,
    resolve_pair_predicates,
    resolve_predicates,
)
from pairloom.operators.encode import encode_pairs, tokenize, tokenize_report
from pairloom.operators.flaws import filter_pairs, find_flaws, flaw_report, keep
from pairloom.operators.normalize import norm, norm_report
from pairloom.operators.split import shuffle_positions, split_dataframe
from pairloom.operators.summaries import (
    char_lengths,
    flaw_counts,
    length_histogram,
    norm_change_counts,
    pair_flaw_counts,
    token_lengths,
)
from pairloom.operators.training import map_training
from pairloom.plans.preprocess import preprocess, training_plan
from pairloom.sources.pairs import attach_ids, load_pairs, read_records, read_report
from pairloom.sources.sinks import (
    MANIFEST,
    SPLIT_INFO,
    dataset_manifest,
    decode_rows,
    save_dataset,
    split_path,
    write_dataset,
    write_jsonl,
    write_manifest,
    write_splits,
)
from pairloom.sources.storage import shared_dir
from pairloom.streaming.prepare import prepare_stream, write_stream
from workload.fixtures import documents, flat_pairs, pages, pairs, texts

CHAIN = ["strip_edges", "remove_control_chars", "collapse_whitespace", "normalize_unicode_quotes"]
TEXT_FLAWS = [
    "is_blank",
    ["is_too_short", {"min": 10}],
    ["is_too_long", {"max": 5000}],
    "contains_url",
    "contains_email",
    "contains_control_chars",
    "contains_invisible_format_chars",
    "has_odd_number_of_quotes",
    "has_unbalanced_brackets",
]
PAIR_FLAWS = [["bad_length_ratio", {"min": 0.33, "max": 3}], "are_equal"]
# Options of the predicates that need some.
OPTIONS = {"is_too_short": {"min": 10}, "is_too_long": {"max": 5000}}
MAX_SEQ_LEN = 600
# Escapes as printed, at the end of the texts of a report.
REPORT_TAILS = ("\\x01", "\\xe4", "\\n", "\\u2028", "\\U000e0001", "\\\\U0001f600")
REJECT = {"prob": 0.1, "seed": 7}
FIRST_N = 150
FIRST_NS = (1, 150, 400, 10_000_000)
SLICES = "train[:40]+train[10%:35%]+train[-7:]"
# The id of staged_kept_ids, in SQL.
ROW_KEY = "id * 7 + 3"
RATIOS = {"train": 0.979, "validation": 0.001, "test": 0.02}
SMALL_RATIOS = {"train": 0.6, "val": 0.2, "test": 0.2}
SEED = 7
BOS, EOS = 3, 5


def _joined(labels: str) -> Column:
    return F.array_join(labels, "|")


def _ids(ids) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")


def _flat(df: DataFrame) -> DataFrame:
    return df.select("id", "translation.de", "translation.en")


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _change(name: str):
    def query(spark, sf_dir):
        (step,) = resolve_changes([name])
        changed = texts(spark, sf_dir).withColumn("after", step(F.col("text")))
        return changed.select("id", F.col("after").alias("text"), (F.col("after") != F.col("text")).alias("changed"))

    return query


def _predicate(name: str):
    def query(spark, sf_dir):
        (test,) = resolve_predicates([[name, OPTIONS.get(name, {})]])
        return texts(spark, sf_dir).select("id", test(F.col("text")).alias("flawed"))

    return query


def _pair_predicate(entry):
    def query(spark, sf_dir):
        (test,) = resolve_pair_predicates([entry])
        return flat_pairs(spark, sf_dir).select("id", test(F.col("de"), F.col("en")).alias("flawed"))

    return query


# --- normalization ------------------------------------------------------------


def _normed(spark, sf_dir, **options) -> DataFrame:
    return norm(pairs(spark, sf_dir), CHAIN, **options)


def norm_chain(spark, sf_dir):
    normed = _normed(spark, sf_dir, annotate=True)
    return normed.select(
        "id",
        "translation.de",
        "translation.en",
        _joined("de_norm_changes").alias("de_changes"),
        _joined("en_norm_changes").alias("en_changes"),
    )


def _norm_report(spark, sf_dir, debug=False):
    return norm_report(_normed(spark, sf_dir, annotate=True, debug=debug), debug=debug)


def norm_report_rows(spark, sf_dir):
    return _norm_report(spark, sf_dir).select(
        "seq_no", _joined("de_norm_changes").alias("de_changes"), _joined("en_norm_changes").alias("en_changes")
    )


def norm_report_debug(spark, sf_dir):
    return _norm_report(spark, sf_dir, debug=True).select("seq_no", "de_before", "de_after", "en_before", "en_after")


def norm_counts(spark, sf_dir):
    return norm_change_counts(_norm_report(spark, sf_dir))


# --- flaws --------------------------------------------------------------------


def _flaws(spark, sf_dir) -> DataFrame:
    return find_flaws(_normed(spark, sf_dir), TEXT_FLAWS, PAIR_FLAWS)


def _clean(spark, sf_dir) -> DataFrame:
    return filter_pairs(_normed(spark, sf_dir), TEXT_FLAWS, PAIR_FLAWS)


def filter_keep(spark, sf_dir):
    return _flat(_clean(spark, sf_dir))


def filter_keep_labelled(spark, sf_dir):
    return _flat(keep(_flaws(spark, sf_dir)))


def flaw_report_rows(spark, sf_dir):
    return flaw_report(_flaws(spark, sf_dir)).select(
        "seq_no",
        _joined("de_flaws").alias("de_flaws"),
        _joined("en_flaws").alias("en_flaws"),
        _joined("pair_flaws").alias("pair_flaws"),
    )


def flaw_label_counts(spark, sf_dir):
    return flaw_counts(_flaws(spark, sf_dir))


def pair_flaw_label_counts(spark, sf_dir):
    return pair_flaw_counts(_flaws(spark, sf_dir))


def page_flaws(spark, sf_dir):
    """All text predicates on the raw pages."""
    tests = [[name, OPTIONS.get(name, {})] for name in PREDICATES]
    flaws = find_flaws(pages(spark, sf_dir), tests, langs=("html",))
    return flaws.select("id", _joined("html_flaws").alias("flaws"))


def page_norm(spark, sf_dir):
    """All changes on the raw pages."""
    normed = norm(pages(spark, sf_dir), list(CHANGES), langs=("html",), annotate=True)
    return normed.select("id", F.col("translation.html").alias("html"), _joined("html_norm_changes").alias("changes"))


# --- loading ------------------------------------------------------------------


def load_ids(spark, sf_dir):
    """Ids in the order of a column whose values repeat, with a tie-break."""
    rows = documents(spark, sf_dir).select("doc_id", "n_chars")
    return attach_ids(rows, [F.desc("n_chars"), "doc_id"], start_id=100)


def load_ids_overwrite(spark, sf_dir):
    """An existing id column is replaced."""
    rows = documents(spark, sf_dir).select("source", "lang", F.col("doc_id").alias("id"), F.col("doc_id").alias("old"))
    return attach_ids(rows, ["source", "id"], overwrite_ids=True)


def load_file_order(spark, sf_dir):
    """Ids in file order, from the footers and the row positions."""
    rows = load_pairs(spark, "parquet", split="train", data_files={"train": f"{sf_dir}/documents.parquet"})
    return rows.select("id", "doc_id", "lang")


def load_first_n(spark, sf_dir):
    rows = load_pairs(
        spark, "parquet", split="train", data_files=f"{sf_dir}/documents.parquet", max_examples=FIRST_N, start_id=5
    )
    return rows.select("id", "doc_id")


def load_first_n_ordered(spark, sf_dir):
    """The first rows in the order of a column whose values repeat, for several numbers of them."""
    parts = []
    for n in FIRST_NS:
        rows = load_pairs(
            spark, "parquet", split="train", data_files=f"{sf_dir}/documents.parquet", max_examples=n,
            order_by=[F.desc("n_chars"), "doc_id"],
        )
        parts.append(rows.select(F.lit(n).alias("n"), "id", "doc_id"))
    return reduce(DataFrame.unionByName, parts)


def load_split_range(spark, sf_dir):
    """Slices of a split, by numbers and per cent, one after the other."""
    rows = load_pairs(spark, "parquet", split=SLICES, data_files={"train": f"{sf_dir}/documents.parquet"})
    return rows.select("id", "doc_id", "lang")


def load_json_order(spark, sf_dir):
    """Ids of JSON lines by file and line, whole texts, without an order column."""
    path = f"{_run_dir(spark)}/pairs.jsonl"
    write_jsonl(documents(spark, sf_dir).orderBy("doc_id").selectExpr("doc_id", "text AS de", "source AS en"), path)
    rows = load_pairs(spark, "json", split="train", data_files={"train": [path]}, schema="doc_id long, de string, en string", start_id=1)
    return rows.select("id", "doc_id", "translation.de", "translation.en")


def load_json_slices(spark, sf_dir):
    """Slices of JSON lines."""
    path = f"{_run_dir(spark)}/pairs.jsonl"
    write_jsonl(documents(spark, sf_dir).orderBy("doc_id").selectExpr("doc_id", "text AS de", "source AS en"), path)
    rows = load_pairs(spark, "json", split=SLICES, data_files={"train": path}, schema="doc_id long, de string, en string")
    return rows.select("id", "doc_id", F.md5("translation.de").alias("de_md5"))


def read_located(spark, sf_dir):
    """A snapshot whose errors would name file and line."""
    source = pairs(spark, sf_dir)
    path = f"{_run_dir(spark)}/pairs.jsonl"
    write_jsonl(source, path)
    return _flat(read_records(spark, path, source.schema, locate=True))


def load_json(spark, sf_dir):
    """Ids by order column over a JSON source."""
    path = f"{_run_dir(spark)}/pairs.jsonl"
    write_jsonl(flat_pairs(spark, sf_dir).selectExpr("id AS position", "struct(de, en) AS translation"), path)
    schema = "position long, translation struct<de: string, en: string>"
    rows = load_pairs(spark, "json", split="train", data_files=[path], schema=schema, order_by=[F.desc("position")])
    return rows.select("id", "position", "translation.de", "translation.en")


def load_json_columns(spark, sf_dir):
    """All fields of a JSON source stay, its own ids among them."""
    path = f"{_run_dir(spark)}/docs.jsonl"
    pair = F.struct(F.col("text").alias("de"), F.col("source").alias("en")).alias("translation")
    write_jsonl(documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "lang", "n_chars", pair), path)
    rows = load_pairs(spark, "json", split="train", data_files=path, include_ids=False)
    return rows.select("id", "lang", "n_chars", "translation.de", "translation.en")


def load_json_flat(spark, sf_dir):
    """One field per language instead of the pair; an existing id is replaced."""
    path = f"{_run_dir(spark)}/flat.jsonl"
    write_jsonl(documents(spark, sf_dir).selectExpr("doc_id AS id", "doc_id AS old", "lang AS de", "source AS en"), path)
    rows = load_pairs(spark, "json", split="train", data_files=path, overwrite_ids=True, order_by=[F.desc("old")])
    return rows.select("id", "old", "translation.de", "translation.en")


def load_json_flat_text(spark, sf_dir):
    """The same with whole texts."""
    path = f"{_run_dir(spark)}/flat.jsonl"
    write_jsonl(documents(spark, sf_dir).selectExpr("doc_id AS id", "doc_id AS old", "text AS de", "concat(text, source) AS en"), path)
    rows = load_pairs(spark, "json", split="train", data_files=path, overwrite_ids=True, order_by=[F.desc("old")])
    return rows.select("id", "old", "translation.de", "translation.en")


# --- encoding -----------------------------------------------------------------


class _Words:
    """A tokenizer of the external kind: whitespace words, the id is the length."""

    eos_token_id, pad_token_id, vocab_size = 0, 0, 1024

    def __call__(self, text, truncation=False, max_length=None):
        ids = [len(word) for word in text.split()]
        ids = ids[:max_length] if truncation else ids
        return {"input_ids": ids, "attention_mask": [1] * len(ids)}

    def decode(self, ids, skip_special_tokens=True):
        return " ".join("x" * i for i in ids if i != self.eos_token_id or not skip_special_tokens) + " "


def _external() -> ExternalCodec:
    return ExternalCodec(_Words, "words")


def _tokens(df: DataFrame) -> DataFrame:
    tokens = "tokenized_translation"
    return df.select(
        "id",
        _ids(F.col(f"{tokens}.de.input_ids")).alias("de_ids"),
        _ids(F.col(f"{tokens}.en.input_ids")).alias("en_ids"),
        F.aggregate(f"{tokens}.de.attention_mask", F.lit(0), lambda a, b: a + b).alias("de_mask"),
        F.aggregate(f"{tokens}.en.attention_mask", F.lit(0), lambda a, b: a + b).alias("en_mask"),
    )


def tokenize_words(spark, sf_dir):
    return _tokens(encode_pairs(pairs(spark, sf_dir), WordLengthCodec()))


def tokenize_truncated(spark, sf_dir):
    options = {"truncation": True, "max_length": 12}
    return _tokens(encode_pairs(pairs(spark, sf_dir), WordLengthCodec(), tokenizer_kwargs=options))


def tokenize_external(spark, sf_dir):
    return _tokens(encode_pairs(pairs(spark, sf_dir), _external()))


def tokenize_overlong(spark, sf_dir):
    return _tokens(tokenize(pairs(spark, sf_dir), WordLengthCodec(), max_seq_len=MAX_SEQ_LEN))


def tokenize_report_rows(spark, sf_dir):
    encoded = encode_pairs(_clean(spark, sf_dir), WordLengthCodec())
    return tokenize_report(encoded, MAX_SEQ_LEN).select(
        "seq_no",
        F.col("token_lengths.de").alias("de_length"),
        F.col("token_lengths.en").alias("en_length"),
        "removed_id",
    )


# --- training rows ------------------------------------------------------------


def _training(df: DataFrame) -> DataFrame:
    texts_too = [c for c in df.columns if c.endswith("_text")]
    return df.select("id", _ids(F.col("src_ids")).alias("src_ids"), _ids(F.col("tgt_ids")).alias("tgt_ids"), *texts_too)


def _encoded(spark, sf_dir):
    return encode_pairs(pairs(spark, sf_dir), WordLengthCodec())


def map_rows(spark, sf_dir):
    return _training(map_training(_encoded(spark, sf_dir), src_lang="en", tgt_lang="de", include_text=True))


def map_bos_eos(spark, sf_dir):
    mapped = map_training(_encoded(spark, sf_dir), src_lang="de", tgt_lang="en", tgt_bos_id=BOS, tgt_eos_id=EOS)
    return _training(mapped)


def _mapped(spark, sf_dir):
    codec = WordLengthCodec()
    ids = training_token_ids(codec)
    return training_plan(
        pairs(spark, sf_dir),
        codec,
        norm_options={"changes": CHAIN},
        filter_options={"predicates": TEXT_FLAWS, "pair_predicates": PAIR_FLAWS},
        tokenize_options={"max_seq_len": MAX_SEQ_LEN},
        map_options={
            "src_lang": "de",
            "tgt_lang": "en",
            "tgt_bos_id": ids["tgt_bos_id"],
            "tgt_eos_id": ids["tgt_eos_id"],
        },
    )


def preprocess_plan(spark, sf_dir):
    return _training(_mapped(spark, sf_dir))


def preprocess_staged(spark, sf_dir):
    """A run with snapshots and reports: rows per stage, report and final dataset."""
    run = _run_dir(spark)
    save_dataset(pairs(spark, sf_dir).drop("id"), f"{run}/raw/train", compression="zstd")
    preprocess(
        spark,
        f"{run}/out",
        WordLengthCodec(),
        load_options={"path_name": f"{run}/raw", "split": "train"},
        norm_options={"changes": CHAIN},
        filter_options={"predicates": TEXT_FLAWS, "pair_predicates": PAIR_FLAWS},
        tokenize_options={"max_seq_len": MAX_SEQ_LEN},
        map_options={"src_lang": "de", "tgt_lang": "en"},
        staging=f"{run}/staging",
        staging_compression="gzip",
        dataset_name="docs",
    )
    sources = {stage: f"{run}/staging/docs_{stage}.jsonl" for stage in ("load", "norm", "filter", "tokenize", "map")}
    sources |= {f"{stage}_report": f"{run}/staging/{stage}_report" for stage in ("norm", "filter", "tokenize")}
    counts = [spark.read.text(path).select(F.lit(stage).alias("stage")) for stage, path in sources.items()]
    counts.append(spark.read.parquet(f"{run}/out").select(F.lit("dataset").alias("stage")))
    union = counts[0]
    for other in counts[1:]:
        union = union.union(other)
    return union.groupBy("stage").agg(F.count(F.lit(1)).alias("row_count"))


def staged_contents(spark, sf_dir):
    """What lies in every snapshot and report of a run: a digest of each row."""
    run = _run_dir(spark)
    save_dataset(pairs(spark, sf_dir, ordered=True).drop("id"), f"{run}/raw/train", compression="zstd")
    preprocess(
        spark,
        f"{run}/out",
        WordLengthCodec(),
        load_options={"path_name": f"{run}/raw", "split": "train"},
        norm_options={"changes": CHAIN},
        filter_options={"predicates": TEXT_FLAWS, "pair_predicates": PAIR_FLAWS},
        tokenize_options={"max_seq_len": MAX_SEQ_LEN},
        map_options={"src_lang": "de", "tgt_lang": "en"},
        staging=f"{run}/staging",
        staging_compression="gzip",
        dataset_name="docs",
    )
    tokens = "tokenized_translation struct<de: struct<input_ids: array<int>>, en: struct<input_ids: array<int>>>"
    texts_of, lengths = ["translation.de", "translation.en"], ["token_lengths.de", "token_lengths.en", "removed_id"]
    listed = [_ids(F.col(f"tokenized_translation.{lang}.input_ids")) for lang in ("de", "en")]
    stages = {
        **{stage: (f"docs_{stage}.jsonl", "id", schemas.pairs_with_id(), texts_of) for stage in ("load", "norm", "filter")},
        "tokenize": ("docs_tokenize.jsonl", "id", f"id long, {tokens}", listed),
        "map": ("docs_map.jsonl", "id", schemas.training_rows(False), [_ids(F.col("src_ids")), _ids(F.col("tgt_ids"))]),
        "norm_report": ("norm_report", "seq_no", schemas.norm_report(), [_joined("de_norm_changes"), _joined("en_norm_changes")]),
        "filter_report": ("filter_report", "seq_no", schemas.flaw_report(), [_joined(f"{c}_flaws") for c in ("de", "en", "pair")]),
        "tokenize_report": ("tokenize_report", "seq_no", schemas.tokenize_report(), lengths),
    }
    found = []
    for stage, (name, key, schema, columns) in stages.items():
        rows = spark.read.schema(schema).json(f"{run}/staging/{name}", mode="FAILFAST")
        values = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-")) for c in columns]
        found.append(rows.select(F.lit(stage).alias("stage"), F.col(key).alias("id"), F.md5(F.concat_ws("/", *values)).alias("content")))
    return reduce(DataFrame.unionByName, found)


def staged_kept_ids(spark, sf_dir):
    """Positions in the reports of a run that keeps the sparse ids of its source."""
    run = _run_dir(spark)
    source = pairs(spark, sf_dir, ordered=True).withColumn("row", F.col("id") * 7 + 3)
    save_dataset(source.drop("id"), f"{run}/raw/train", compression="zstd")
    preprocess(
        spark,
        f"{run}/out",
        WordLengthCodec(),
        load_options={"path_name": f"{run}/raw", "split": "train", "include_ids": False, "id_field": "row"},
        norm_options={"changes": CHAIN},
        filter_options={"predicates": TEXT_FLAWS, "pair_predicates": [*PAIR_FLAWS, ["reject_with_probability", REJECT]]},
        tokenize_options={"max_seq_len": MAX_SEQ_LEN},
        map_options={"src_lang": "de", "tgt_lang": "en"},
        staging=f"{run}/staging",
        staging_compression="gzip",
    )
    norm_rows = spark.read.json(f"{run}/staging/norm_report").select(F.lit("norm").alias("report"), "seq_no")
    flaw_rows = spark.read.json(f"{run}/staging/filter_report").select(F.lit("filter"), "seq_no")
    return norm_rows.union(flaw_rows)


def preprocess_stream(spark, sf_dir):
    """The run as a stream over stored pairs."""
    run = _run_dir(spark)
    source = pairs(spark, sf_dir)
    save_dataset(source, f"{run}/pairs")
    ids = training_token_ids(WordLengthCodec())
    prepared = prepare_stream(
        spark.readStream.schema(source.schema).parquet(f"{run}/pairs"),
        WordLengthCodec(),
        norm_options={"changes": CHAIN},
        filter_options={"predicates": TEXT_FLAWS, "pair_predicates": PAIR_FLAWS},
        tokenize_options={"max_seq_len": MAX_SEQ_LEN},
        map_options={
            "src_lang": "de",
            "tgt_lang": "en",
            "tgt_bos_id": ids["tgt_bos_id"],
            "tgt_eos_id": ids["tgt_eos_id"],
        },
    )
    write_stream(prepared, f"{run}/out", f"{run}/progress").awaitTermination()
    return _training(read_records(spark, f"{run}/out"))


# --- split --------------------------------------------------------------------


def _document_ids(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"))


def shuffle_order(spark, sf_dir):
    return shuffle_positions(_document_ids(spark, sf_dir), SEED)


def split_membership(spark, sf_dir):
    return split_dataframe(_document_ids(spark, sf_dir), RATIOS, SEED)


def split_counts(spark, sf_dir):
    members = split_dataframe(_document_ids(spark, sf_dir), SMALL_RATIOS, SEED)
    return members.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"))


def split_written(spark, sf_dir):
    """The split datasets and their manifests, as written."""
    path = f"{_run_dir(spark)}/data"
    rows = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "n_chars")
    count = write_dataset(rows, path)
    manifest = dataset_manifest(WordLengthCodec(), src_lang="de", tgt_lang="en", num_examples=count)
    write_manifest(spark, manifest, schemas.DATASET_MANIFEST, f"{path}/{MANIFEST}")
    write_splits(spark, path, RATIOS, SEED)
    parts = []
    for name in RATIOS:
        target = split_path(path, name)
        split = spark.read.schema(schemas.SPLIT_MANIFEST).json(f"{target}/{SPLIT_INFO}")
        whole = spark.read.schema(schemas.DATASET_MANIFEST).json(f"{target}/{MANIFEST}")
        # Both manifests have one row.
        info = split.select("split_name", "split_seed", "num_examples").join(
            F.broadcast(whole.select("num_examples", "base_vocab_size")), "num_examples"
        )
        data = spark.read.parquet(target).select(F.lit(name).alias("split_name"), "id", "n_chars")
        parts.append(data.join(F.broadcast(info), "split_name"))
    return parts[0].union(parts[1]).union(parts[2])


def split_written_repeated_ids(spark, sf_dir):
    """Sizes of splits of a dataset whose ids repeat or are null, and the rows in them."""
    path = f"{_run_dir(spark)}/data"
    row_id = F.when(F.col("doc_id") % 7 != 0, F.floor(F.col("doc_id") / 50))
    count = write_dataset(documents(spark, sf_dir).select(row_id.alias("id"), "doc_id"), path)
    manifest = dataset_manifest(WordLengthCodec(), src_lang="de", tgt_lang="en", num_examples=count)
    write_manifest(spark, manifest, schemas.DATASET_MANIFEST, f"{path}/{MANIFEST}")
    write_splits(spark, path, SMALL_RATIOS, SEED)
    parts = [spark.read.parquet(split_path(path, name)).select(F.lit(name).alias("split"), "doc_id") for name in SMALL_RATIOS]
    rows = parts[0].union(parts[1]).union(parts[2])
    sizes = rows.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"))
    return sizes.union(rows.agg(F.lit("distinct"), F.countDistinct("doc_id")))


# --- sources and sinks --------------------------------------------------------


def manifest_row(spark, sf_dir):
    path = f"{_run_dir(spark)}/data"
    codec = WordLengthCodec(vocab_size=1)
    count = write_dataset(_mapped(spark, sf_dir), path, schemas.training_rows())
    manifest = dataset_manifest(codec, src_lang="de", tgt_lang="en", num_examples=count, max_seq_len=MAX_SEQ_LEN)
    write_manifest(spark, manifest, schemas.DATASET_MANIFEST, f"{path}/{MANIFEST}")
    return spark.read.schema(schemas.DATASET_MANIFEST).json(f"{path}/{MANIFEST}")


def snapshot_json(spark, sf_dir):
    source = pairs(spark, sf_dir)
    path = f"{_run_dir(spark)}/pairs.jsonl"
    write_jsonl(source, path)
    return _flat(read_records(spark, path, source.schema))


def snapshot_parquet(spark, sf_dir):
    schema = schemas.pairs_with_id()
    return _flat(save_dataset(pairs(spark, sf_dir), f"{_run_dir(spark)}/pairs", schema))


def report_read(spark, sf_dir):
    """Flaw counts from a report in the old one-record-per-line, single-quoted form."""
    path = f"{_run_dir(spark)}/report"

    def quoted(labels: str) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform(labels, lambda s: F.concat(F.lit("'"), s, F.lit("'"))), ", "), F.lit("]"))

    names = ("de_flaws", "en_flaws", "pair_flaws")
    fields = [F.concat(F.lit(f"'{name}': "), quoted(name)) for name in names]
    line = F.concat(F.lit("{'seq_no': "), F.col("seq_no").cast("string"), F.lit(", "), F.concat_ws(", ", *fields), F.lit("}"))
    flaw_report(_flaws(spark, sf_dir)).select(line.alias("value")).write.text(path)
    return flaw_counts(read_report(spark, path, schemas.flaw_report()))


def _printed(text: Column) -> Column:
    """A text as Python prints it between quotes, but for the quotes."""
    for char, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    return text


def report_read_debug(spark, sf_dir):
    """A report as printed, with whole texts in either kind of quotes, escapes of all lengths and missing values."""
    path = f"{_run_dir(spark)}/report"
    escaped = _printed(F.col("text"))
    tail = F.element_at(F.array(*map(F.lit, REPORT_TAILS)), (F.col("doc_id") % len(REPORT_TAILS) + 1).cast("int"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), tail, F.lit("'"))
    double = F.concat(F.lit('"it\'s '), F.replace(escaped, F.lit('"'), F.lit('\\"')), F.lit('"'))
    quoted = F.when(F.col("text").isNull(), "None").when(F.col("doc_id") % 2 == 0, single).otherwise(double)
    removed = F.when(F.col("doc_id") % 5 == 0, F.lit("None")).otherwise(F.col("doc_id").cast("string"))
    line = F.concat(
        F.lit("{'seq_no': "), F.col("doc_id").cast("string"), F.lit(", 'text': "), quoted,
        F.lit(", 'kept': "), F.when(F.col("doc_id") % 2 == 0, "True").otherwise("False"), F.lit(", 'removed_id': "), removed, F.lit("}"),
    )
    documents(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_report(spark, path, "seq_no long, text string, kept boolean, removed_id long")


def report_read_whole(spark, sf_dir):
    """The same with whole texts; line ends, tabs, backslashes and the quotes around are escaped as Python prints them."""
    path = f"{_run_dir(spark)}/report"
    # Every text gets all of them at its end, and a backslash before a letter.
    text = _printed(F.concat("text", F.lit("\\n\t'\"\r\n")))
    single = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"'))
    quoted = F.when(F.col("text").isNull(), F.lit("None")).when(F.col("doc_id") % 2 == 0, single).otherwise(double)
    line = F.concat(F.lit("{'seq_no': "), F.col("doc_id").cast("string"), F.lit(", 'text': "), quoted, F.lit("}"))
    documents(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_report(spark, path, "seq_no long, text string")


def text_export(spark, sf_dir):
    return decode_rows(_mapped(spark, sf_dir), _external()).groupBy("src", "ref").agg(F.count(F.lit(1)).alias("row_count"))


# --- lengths ------------------------------------------------------------------


def char_length_pairs(spark, sf_dir):
    return char_lengths(pairs(spark, sf_dir)).groupBy("de", "en").agg(F.count(F.lit(1)).alias("row_count"))


def char_length_hist(spark, sf_dir):
    return length_histogram(char_lengths(flat_pairs(spark, sf_dir)))


def token_length_hist(spark, sf_dir):
    return length_histogram(token_lengths(_encoded(spark, sf_dir)), max_bins=40)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"norm_{name}": _change(name) for name in CHANGES},
    "norm_chain": norm_chain,
    "norm_report": norm_report_rows,
    "norm_report_debug": norm_report_debug,
    "norm_change_counts": norm_counts,
    **{f"flaw_{name}": _predicate(name) for name in PREDICATES},
    "pair_bad_length_ratio": _pair_predicate(PAIR_FLAWS[0]),
    "pair_are_equal": _pair_predicate("are_equal"),
    "pair_reject_hash": _pair_predicate(["reject_with_probability", REJECT]),
    "filter_keep": filter_keep,
    "filter_keep_labelled": filter_keep_labelled,
    "flaw_report": flaw_report_rows,
    "flaw_counts": flaw_label_counts,
    "pair_flaw_counts": pair_flaw_label_counts,
    "page_flaws": page_flaws,
    "page_norm": page_norm,
    "load_ids": load_ids,
    "load_ids_overwrite": load_ids_overwrite,
    "load_file_order": load_file_order,
    "load_first_n": load_first_n,
    "load_first_n_ordered": load_first_n_ordered,
    "load_split_range": load_split_range,
    "load_json": load_json,
    "load_json_order": load_json_order,
    "load_json_slices": load_json_slices,
    "load_json_columns": load_json_columns,
    "load_json_flat": load_json_flat,
    "load_json_flat_text": load_json_flat_text,
    "tokenize_words": tokenize_words,
    "tokenize_truncated": tokenize_truncated,
    "tokenize_external": tokenize_external,
    "tokenize_overlong": tokenize_overlong,
    "tokenize_report": tokenize_report_rows,
    "map_training": map_rows,
    "map_bos_eos": map_bos_eos,
    "shuffle_order": shuffle_order,
    "split_membership": split_membership,
    "split_counts": split_counts,
    "split_written": split_written,
    "split_written_repeated_ids": split_written_repeated_ids,
    "manifest": manifest_row,
    "snapshot_json": snapshot_json,
    "read_located": read_located,
    "snapshot_parquet": snapshot_parquet,
    "report_read": report_read,
    "report_read_debug": report_read_debug,
    "report_read_whole": report_read_whole,
    "text_export": text_export,
    "char_length_pairs": char_length_pairs,
    "char_length_hist": char_length_hist,
    "token_length_hist": token_length_hist,
    "preprocess_plan": preprocess_plan,
    "preprocess_staged": preprocess_staged,
    "staged_contents": staged_contents,
    "staged_kept_ids": staged_kept_ids,
    "preprocess_stream": preprocess_stream,
}
