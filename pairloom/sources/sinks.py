"""Writing snapshots, datasets, manifests and text exports."""

import math
from collections.abc import Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import text as tx
from pairloom.functions.codecs import Codec, training_token_ids
from pairloom.operators.boundary import stage_boundary
from pairloom.operators.split import in_split_order, split_counts, split_ranges, validate_ratios
from pairloom.schemas import DATASET_MANIFEST, SPLIT_MANIFEST
from pairloom.sources.storage import write_apart

# Manifests lie inside the dataset folder; the underscore hides them from readers of
# the data.
MANIFEST = "_dataset_manifest"
SPLIT_INFO = "_split_manifest"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system knows the path.

    Asks Hadoop's file system, for which PySpark has no public name: a read that fails instead
    would log an error with every target that is, as it should be, not there yet.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def write_jsonl(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write one JSON object per row; null fields and non-ASCII text are kept. Plain text unless compressed."""
    df.write.json(path, ignoreNullFields=False, compression=compression)


def write_dataset(
    df: DataFrame, path: str, schema: T.StructType | None = None, compression: str | None = None
) -> int:
    """Write the final dataset and return its row count, taken in the same pass."""
    if schema is not None:
        df = df.select(*(F.col(field.name).cast(field.dataType) for field in schema))
    seen = Observation()
    stage_boundary(df, seen).write.parquet(path, compression=compression)
    return seen.get["rows"]


def save_dataset(
    df: DataFrame, path: str, schema: T.StructType | None = None, compression: str | None = None
) -> DataFrame:
    """Write the dataset and return it as read back."""
    write_dataset(df, path, schema, compression)
    return df.sparkSession.read.parquet(path)


def dataset_manifest(
    codec: Codec,
    *,
    src_lang: str,
    tgt_lang: str,
    num_examples: int,
    id_field: str = "id",
    max_seq_len: int | None = None,
    token_ids: Mapping[str, int] | None = None,
) -> dict[str, Any]:
    """What a training run needs to know about the dataset.

    A vocabulary covers the special ids in use, also those above the codec's own size.
    """
    ids = dict(token_ids or training_token_ids(codec))
    if codec.vocab_size is None:
        raise ValueError(f"codec {codec.name!r} must define vocab_size")
    size = int(codec.vocab_size)
    targets = (value for key, value in ids.items() if key.startswith("tgt_"))
    return {
        "schema_version": 1,
        "tokenizer_model_name": codec.name,
        "src_lang": src_lang,
        "tgt_lang": tgt_lang,
        "id_field": id_field,
        "src_field": "src_ids",
        "tgt_field": "tgt_ids",
        "base_vocab_size": size,
        "src_vocab_size": max(size, ids["src_pad_id"] + 1),
        "tgt_vocab_size": max(size, 1 + max(targets)),
        **ids,
        "num_examples": num_examples,
        "configured_max_seq_len": max_seq_len,
    }


def write_manifest(spark: SparkSession, manifest: Mapping[str, Any], schema: T.StructType, path: str) -> None:
    row = spark.createDataFrame([tuple(manifest[field.name] for field in schema)], schema)
    write_jsonl(row.coalesce(1), path)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType = DATASET_MANIFEST) -> dict[str, Any]:
    return spark.read.schema(schema).json(path, mode="FAILFAST").first().asDict()


def split_path(dataset: str, name: str) -> str:
    return f"{dataset.rstrip('/')}_split-{name}"


def write_splits(
    spark: SparkSession, dataset: str | None, split_ratio: Mapping[str, float], seed: int, *, id_field: str = "id"
) -> dict[str, int]:
    """Cut a written dataset into ``<dataset>_split-<name>`` and return the row counts.

    All targets are checked before the first is written. Rows lie in the order of the
    seeded permutation inside a split; all splits are written in one pass. Ids may repeat or
    be null: rows with the same id are told apart by file and place in it.
    """
    if dataset is None:
        raise ValueError("dataset is required")
    validate_ratios(split_ratio)
    for needed in (dataset, f"{dataset}/{MANIFEST}"):
        if not path_exists(spark, needed):
            raise FileNotFoundError(needed)
    for name in split_ratio:
        if path_exists(spark, split_path(dataset, name)):
            raise FileExistsError(split_path(dataset, name))

    place = F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    rows = spark.read.parquet(dataset).select("*", place.alias("_row"))
    total = rows.count()
    counts = split_counts(total, split_ratio)
    ranges = split_ranges(rows, split_ratio, seed, id_field=id_field, total=total, tie="_row")
    source = read_manifest(spark, f"{dataset}/{MANIFEST}")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filled = list(ranges)
    parts = {name: math.ceil(partitions * counts[name] / total) for name in filled}
    # Every row is read and moved once, whatever the number of splits; each split's partitions go to its folder.
    seen = Observation()
    ordered = in_split_order(rows, seed, ranges, parts, id_field=id_field, tie="_row").drop("_row")
    each = [F.count_if(F.col("_split") == k).alias(f"n{k}") for k in range(len(filled))]
    if filled:
        write_apart(ordered.observe(seen, *each), "_split", [split_path(dataset, name) for name in filled], "parquet")
    for name, count in counts.items():
        target = split_path(dataset, name)
        written = seen.get[f"n{filled.index(name)}"] if name in filled else write_dataset(rows.limit(0).drop("_row"), target)
        if written != count:
            raise RuntimeError(f"split {name!r} has {written} rows instead of {count}")
        write_manifest(spark, {**source, "num_examples": count}, DATASET_MANIFEST, f"{target}/{MANIFEST}")
        info = {
            "source_dataset": dataset,
            "split_name": name,
            "split_seed": seed,
            "split_ratio": {key: float(value) for key, value in split_ratio.items()},
            "num_examples": count,
        }
        write_manifest(spark, info, SPLIT_MANIFEST, f"{target}/{SPLIT_INFO}")
    return counts


def decode_rows(df: DataFrame, codec: Codec) -> DataFrame:
    """Texts of the token rows: ``src, ref`` without special tokens, stripped."""

    def decode(batches):
        for batch in batches:
            yield pd.DataFrame(
                {
                    out: codec.decode_batch([[int(i) for i in ids] for ids in batch[ids_column]])
                    for out, ids_column in (("src", "src_ids"), ("ref", "tgt_ids"))
                }
            )

    texts = df.select("src_ids", "tgt_ids").mapInPandas(decode, "src string, ref string")
    return texts.select(tx.strip(F.col("src")).alias("src"), tx.strip(F.col("ref")).alias("ref"))


def export_texts(df: DataFrame, codec: Codec, path: str) -> None:
    """Write the decoded texts as JSON lines."""
    write_jsonl(decode_rows(df, codec), path)
