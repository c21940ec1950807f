"""The whole run: load, norm, filter, tokenize, map, and optionally split."""

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.codecs import Codec, training_token_ids
from pairloom.operators.boundary import stage_boundary
from pairloom.operators.encode import (
    drop_overlong,
    encode_pairs,
    is_overlong,
    numbered_report,
    sides,
    tokenize_report_columns,
)
from pairloom.operators.flaws import filter_pairs, find_flaws, flaw_count, flaw_report_columns, keep
from pairloom.operators.normalize import norm, norm_report_row
from pairloom.operators.split import validate_ratios
from pairloom.operators.training import map_training, training_columns
from pairloom.schemas import DATASET_MANIFEST, LANGS, training_rows
from pairloom.sources.pairs import load_pairs
from pairloom.sources.sinks import (
    MANIFEST,
    dataset_manifest,
    path_exists,
    split_path,
    write_dataset,
    write_jsonl,
    write_manifest,
    write_splits,
)
from pairloom.sources.storage import materialize, run_folder, stored_tables, write_apart

# Column of a staged run: the position in the input if ids are the source's.
POSITION = "_position"
# Stored tables of whole texts are read once or twice: smaller ones cost less than their compression.
COMPRESSION = "zstd"


def _agree(what: str, *values) -> None:
    given = {value for value in values if value is not None}
    if len(given) > 1:
        raise ValueError(f"Conflicting {what} values: {sorted(map(str, given))}")


def training_plan(
    pairs: DataFrame,
    codec: Codec,
    *,
    norm_options: Mapping[str, Any] | None = None,
    filter_options: Mapping[str, Any] | None = None,
    tokenize_options: Mapping[str, Any] | None = None,
    map_options: Mapping[str, Any],
) -> DataFrame:
    """All stages after loading as one lazy plan, without shuffles and without reports."""
    tokenize_options = dict(tokenize_options or {})
    limit = tokenize_options.pop("max_seq_len", None)
    src_lang = tokenize_options.pop("src_lang", None) or map_options["src_lang"]
    clean = filter_pairs(
        norm(pairs, **(norm_options or {})), **{"id_field": map_options.get("id_key", "id"), **(filter_options or {})}
    )
    encoded = encode_pairs(clean, codec, **tokenize_options)
    return map_training(drop_overlong(encoded, limit, src_lang=src_lang), **map_options)


def preprocess(
    spark: SparkSession,
    output: str,
    codec: Codec,
    *,
    load_options: Mapping[str, Any],
    map_options: Mapping[str, Any],
    norm_options: Mapping[str, Any] | None = None,
    filter_options: Mapping[str, Any] | None = None,
    tokenize_options: Mapping[str, Any] | None = None,
    split_options: Mapping[str, Any] | None = None,
    staging: str | None = None,
    dataset_name: str = "dataset",
    staging_compression: str | None = None,
) -> dict[str, Any]:
    """Run all stages, write the dataset to ``output`` and return its manifest.

    The options of a stage are the keyword arguments of its function. With ``staging``,
    every stage is also written there as ``<dataset_name>_<stage>.jsonl`` and every
    report as ``<stage>_report``; each stage then continues from a stored table. They are plain text, or compressed
    as ``staging_compression`` says (``gzip``), which Spark's readers see by the names of the files.
    """
    ids = training_token_ids(codec)
    id_field = load_options.get("id_field", "id")
    tokenize_options = dict(tokenize_options or {})
    _agree("src_lang", tokenize_options.get("src_lang"), map_options["src_lang"])
    _agree("id field", map_options.get("id_key"), id_field)
    _agree("tgt_bos_id", map_options.get("tgt_bos_id"), ids["tgt_bos_id"])
    _agree("tgt_eos_id", map_options.get("tgt_eos_id"), ids["tgt_eos_id"])
    tokenize_options["src_lang"] = map_options["src_lang"]
    map_options = {
        **map_options,
        "id_key": id_field,
        "tgt_bos_id": ids["tgt_bos_id"],
        "tgt_eos_id": ids["tgt_eos_id"],
    }

    _check_targets(spark, output, split_options)
    # What the run stores for itself goes when all has been written.
    with stored_tables(spark):
        if staging is None:
            pairs = load_pairs(spark, **load_options)
            mapped = training_plan(
                pairs,
                codec,
                norm_options=norm_options,
                filter_options=filter_options,
                tokenize_options=tokenize_options,
                map_options=map_options,
            )
        else:
            kept_ids = not load_options.get("include_ids", True)
            # Ids of the source say nothing about positions: reports then count the rows as they lie.
            if kept_ids:
                numbering = {"include_ids": True, "id_field": POSITION, "start_id": 0}
                pairs = load_pairs(spark, **{**load_options, **numbering})
            else:
                pairs = load_pairs(spark, **load_options)
            mapped = _staged(
                pairs,
                codec,
                f"{staging.rstrip('/')}/{dataset_name}",
                staging.rstrip("/"),
                id_field=id_field,
                seq_field=POSITION if kept_ids else id_field,
                start_id=0 if kept_ids else load_options.get("start_id", 0),
                norm_options=dict(norm_options or {}),
                filter_options=dict(filter_options or {}),
                tokenize_options=tokenize_options,
                map_options=map_options,
                compression=staging_compression,
            )

        rows = write_dataset(mapped, output, training_rows(map_options.get("include_text", False)))
        manifest = dataset_manifest(
            codec,
            src_lang=map_options["src_lang"],
            tgt_lang=map_options["tgt_lang"],
            num_examples=rows,
            id_field=id_field,
            max_seq_len=tokenize_options.get("max_seq_len"),
            token_ids=ids,
        )
        write_manifest(spark, manifest, DATASET_MANIFEST, f"{output}/{MANIFEST}")
        if split_options is not None:
            write_splits(spark, output, **split_options)
    return manifest


def _check_targets(spark: SparkSession, output: str, split_options: Mapping[str, Any] | None) -> None:
    """What would fail at the end of a run fails before it."""
    if path_exists(spark, output):
        raise FileExistsError(output)
    if split_options is not None:
        validate_ratios(split_options["split_ratio"])
        for name in split_options["split_ratio"]:
            if path_exists(spark, split_path(output, name)):
                raise FileExistsError(split_path(output, name))


def _staged(
    pairs,
    codec,
    prefix,
    staging,
    *,
    id_field,
    seq_field,
    start_id,
    norm_options,
    filter_options,
    tokenize_options,
    map_options,
    compression,
) -> DataFrame:
    """The stages with a stored table after the filter and the encoding.

    Each table is read twice, once for all its snapshots and reports, which are written side by side, and once to go on.
    The source is read twice, too: its texts are not stored again beside the normalized ones.
    """
    langs = LANGS
    debug = norm_options.get("debug", False)
    columns = [c for c in pairs.columns if c != POSITION]
    write_jsonl(pairs.select(*columns), f"{prefix}_load.jsonl", compression)
    normed = norm(pairs, **{**norm_options, "annotate": True})

    # Changes and flaws are found in one pass and stored once with their labels.
    checked = materialize(find_flaws(normed, **{"id_field": id_field, **filter_options}), "checked", COMPRESSION)
    altered, norm_columns = norm_report_row(langs, seq_field, start_id, debug)
    flaws = flaw_report_columns(langs, seq_field, start_id)
    normed_row, flawed = [F.col(c) for c in columns], flaw_count(langs) > 0
    _write_lines(
        checked,
        {
            f"{staging}/norm_report": (altered, norm_columns, False),
            f"{prefix}_norm.jsonl": (F.lit(True), normed_row, True),
            f"{staging}/filter_report": (flawed, flaws, False),
            f"{prefix}_filter.jsonl": (~flawed, normed_row, True),
        },
        compression,
    )

    options = dict(tokenize_options)
    limit = options.pop("max_seq_len", None)
    src_lang = options.pop("src_lang")
    clean = keep(checked).select(columns + [c for c in (POSITION,) if c in checked.columns])
    encoded = materialize(encode_pairs(clean, codec, langs=langs, **options), "encoded", COMPRESSION)
    report = tokenize_report_columns(limit, src_lang, langs, id_field, seq_field)
    lengths = run_folder(checked.sparkSession, "lengths")
    kept = F.lit(True) if limit is None else ~is_overlong(limit, *sides(src_lang, langs))
    whole = [c for c in encoded.columns if c != POSITION]
    mapped = map_training(drop_overlong(encoded, limit, src_lang=src_lang).drop(POSITION), **map_options)
    _write_lines(
        encoded,
        {
            lengths: (F.lit(True), report, True),
            f"{prefix}_tokenize.jsonl": (kept, [F.col(c) for c in whole], True),
            f"{prefix}_map.jsonl": (kept, training_columns(**map_options), True),
        },
        compression,
    )
    stored = encoded.sparkSession.read.schema(encoded.select(*report).schema).json(lengths)
    numbered_report(stored).write.json(f"{staging}/tokenize_report", compression=compression)
    return mapped


def _write_lines(
    df: DataFrame, outputs: Mapping[str, tuple[Column, list[Column], bool]], compression: str | None
) -> None:
    """JSON lines to several folders in one pass: of the rows that a condition holds for, some columns, with or without nulls."""
    lines = []
    for k, (wanted, columns, nulls) in enumerate(outputs.values()):
        line = F.to_json(F.struct(*columns), {"ignoreNullFields": str(not nulls).lower()})
        lines.append(F.when(wanted, F.struct(F.lit(k).alias("_output"), line.alias("value"))))
    each = stage_boundary(df).select(F.explode(F.array_compact(F.array(*lines))).alias("line")).select("line.*")
    write_apart(each, "_output", list(outputs), "text", compression)
