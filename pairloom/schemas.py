"""Schemas of the tables that the stages read and write."""

from pyspark.sql import types as T

LANGS = ("de", "en")


def pair_struct(langs=LANGS) -> T.StructType:
    return T.StructType([T.StructField(lang, T.StringType()) for lang in langs])


def raw_pairs(langs=LANGS) -> T.StructType:
    return T.StructType([T.StructField("translation", pair_struct(langs))])


def pairs_with_id(langs=LANGS, id_field: str = "id") -> T.StructType:
    return T.StructType([T.StructField(id_field, T.LongType()), *raw_pairs(langs).fields])


def encoding(fields=("input_ids", "attention_mask")) -> T.StructType:
    return T.StructType([T.StructField(name, T.ArrayType(T.IntegerType())) for name in fields])


def tokenized_pairs(langs=LANGS, fields=("input_ids", "attention_mask"), id_field: str = "id") -> T.StructType:
    tokens = T.StructType([T.StructField(lang, encoding(fields)) for lang in langs])
    return T.StructType(
        [*pairs_with_id(langs, id_field).fields, T.StructField("tokenized_translation", tokens)]
    )


def training_rows(include_text: bool = False) -> T.StructType:
    ids = T.ArrayType(T.IntegerType())
    fields = [T.StructField("id", T.LongType()), T.StructField("src_ids", ids), T.StructField("tgt_ids", ids)]
    if include_text:
        fields += [T.StructField("src_text", T.StringType()), T.StructField("tgt_text", T.StringType())]
    return T.StructType(fields)


def norm_report(langs=LANGS, debug: bool = False) -> T.StructType:
    labels = T.ArrayType(T.StringType())
    fields = [T.StructField("seq_no", T.LongType())]
    fields += [T.StructField(f"{lang}_norm_changes", labels) for lang in langs]
    if debug:
        fields += [
            T.StructField(f"{lang}_{when}", T.StringType()) for lang in langs for when in ("before", "after")
        ]
    return T.StructType(fields)


def flaw_report(langs=LANGS) -> T.StructType:
    labels = T.ArrayType(T.StringType())
    names = [*(f"{lang}_flaws" for lang in langs), "pair_flaws"]
    return T.StructType([T.StructField("seq_no", T.LongType()), *(T.StructField(n, labels) for n in names)])


def tokenize_report(langs=LANGS) -> T.StructType:
    lengths = T.StructType([T.StructField(lang, T.IntegerType()) for lang in langs])
    return T.StructType(
        [
            T.StructField("seq_no", T.LongType()),
            T.StructField("token_lengths", lengths),
            T.StructField("removed_id", T.LongType()),
        ]
    )


DATASET_MANIFEST = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("tokenizer_model_name", T.StringType()),
        T.StructField("src_lang", T.StringType()),
        T.StructField("tgt_lang", T.StringType()),
        T.StructField("id_field", T.StringType()),
        T.StructField("src_field", T.StringType()),
        T.StructField("tgt_field", T.StringType()),
        T.StructField("base_vocab_size", T.LongType()),
        T.StructField("src_vocab_size", T.LongType()),
        T.StructField("tgt_vocab_size", T.LongType()),
        T.StructField("src_pad_id", T.LongType()),
        T.StructField("tgt_pad_id", T.LongType()),
        T.StructField("tgt_bos_id", T.LongType()),
        T.StructField("tgt_eos_id", T.LongType()),
        T.StructField("num_examples", T.LongType()),
        T.StructField("configured_max_seq_len", T.LongType()),
    ]
)

SPLIT_MANIFEST = T.StructType(
    [
        T.StructField("source_dataset", T.StringType()),
        T.StructField("split_name", T.StringType()),
        T.StructField("split_seed", T.LongType()),
        T.StructField("split_ratio", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("num_examples", T.LongType()),
    ]
)
