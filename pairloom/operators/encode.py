"""Encoding of sentence pairs into token ids, the length limit and its report."""

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.codecs import Codec
from pairloom.operators.boundary import stage_boundary
from pairloom.operators.sequence import dense_sequence
from pairloom.schemas import LANGS, encoding
from pairloom.sources.storage import materialize

TOKENIZED = "tokenized_translation"
# Bytes of text that a codec gets at a time. What it returns, lists or objects of its own, is many times as large.
SLICE_BYTES = 1 << 20


def _id_lists(values: Sequence) -> pa.Array:
    """Lists of ids, of whatever kind a codec returns, as one column."""
    kind = pa.list_(pa.int32())
    if all(isinstance(ids, list | tuple) for ids in values):
        return pa.array(values, kind)
    arrays = [np.asarray(ids, dtype=np.int32) for ids in values]
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in turn, at least one and about ``SLICE_BYTES`` at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(texts)]):
        yield texts.slice(begin, end - begin)


def _encoder(codec: Codec, options: Mapping):
    """Text column to encoding column: built in, or an Arrow UDF around the codec.

    The UDFs of both languages run in one round trip. A batch becomes one array of ids per field, without an object per list,
    and the codec sees a small slice of it at a time: only arrays grow with the batch, which Spark ends at 64 MB.
    """
    if hasattr(codec, "encode_column"):
        return lambda text: codec.encode_column(text, **options)
    fields = list(codec.fields)

    @F.arrow_udf(encoding(codec.fields))
    def encode(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([arrays(some) for some in _slices(texts)])

    def arrays(texts: pa.Array) -> pa.Array:
        encoded = codec.encode_batch(texts.to_pylist(), **options)
        return pa.StructArray.from_arrays([_id_lists([e[name] for e in encoded]) for name in fields], fields)

    return encode


def encode_pairs(
    df: DataFrame,
    codec: Codec,
    *,
    langs: Sequence[str] = LANGS,
    translation_key: str = "translation",
    output_key: str = TOKENIZED,
    tokenizer_kwargs: Mapping | None = None,
) -> DataFrame:
    """Add a struct with one encoding per language; all other columns stay."""
    encode = _encoder(codec, dict(tokenizer_kwargs or {}))
    texts = {lang: F.coalesce(F.col(f"{translation_key}.{lang}"), F.lit("")) for lang in langs}
    return df.withColumn(output_key, F.struct(*(encode(text).alias(lang) for lang, text in texts.items())))


def _length(lang: str, key: str = TOKENIZED) -> Column:
    return F.size(F.col(f"{key}.{lang}.input_ids"))


def is_overlong(max_seq_len: int, src_lang: str, tgt_lang: str) -> Column:
    """Source longer than the limit, or target reaching it: a target gets a begin id."""
    return (_length(src_lang) > max_seq_len) | (_length(tgt_lang) >= max_seq_len)


def sides(src_lang: str | None, langs: Sequence[str]) -> tuple[str, str]:
    src = src_lang or "de"
    return src, next(lang for lang in langs if lang != src)


def drop_overlong(
    encoded: DataFrame, max_seq_len: int | None, *, src_lang: str | None = None, langs: Sequence[str] = LANGS
) -> DataFrame:
    """Drop the pairs over the length limit; no limit keeps all."""
    if max_seq_len is None:
        return encoded
    return stage_boundary(encoded).where(~is_overlong(max_seq_len, *sides(src_lang, langs)))


def tokenize(
    df: DataFrame,
    codec: Codec,
    *,
    max_seq_len: int | None = None,
    src_lang: str | None = None,
    tokenizer_kwargs: Mapping | None = None,
    langs: Sequence[str] = LANGS,
) -> DataFrame:
    """Encode both sides and drop the pairs over the length limit."""
    encoded = encode_pairs(df, codec, langs=langs, tokenizer_kwargs=tokenizer_kwargs)
    return drop_overlong(encoded, max_seq_len, src_lang=src_lang, langs=langs)


def tokenize_report_columns(
    max_seq_len: int | None, src_lang: str | None, langs: Sequence[str], id_field: str, order_field: str
) -> list[Column]:
    """What the report needs of a row: its place, the lengths if it is kept, its id if it is dropped."""
    dropped = F.lit(False) if max_seq_len is None else is_overlong(max_seq_len, *sides(src_lang, langs))
    lengths = F.struct(*(_length(lang).alias(lang) for lang in langs))
    return [
        F.col(order_field),
        F.when(~dropped, lengths).alias("token_lengths"),
        F.when(dropped, F.col(id_field)).alias("removed_id"),
    ]


def numbered_report(lengths: DataFrame) -> DataFrame:
    """The report from a stored table of its columns, the place first."""
    numbered = dense_sequence(lengths, [lengths.columns[0]], "seq_no", start=1)
    return numbered.select("seq_no", "token_lengths", "removed_id")


def tokenize_report(
    encoded: DataFrame,
    max_seq_len: int | None = None,
    *,
    src_lang: str | None = None,
    langs: Sequence[str] = LANGS,
    id_field: str = "id",
    order_field: str | None = None,
) -> DataFrame:
    """One row per encoded pair: the lengths if it is kept, its id if it is dropped.

    Takes the result of ``encode_pairs``, before the length limit. ``seq_no`` is the
    1-based position in the order of ids, or of ``order_field``. Only lengths and ids are stored and numbered, so the
    encoding is computed once and the tokens are not shuffled.
    """
    columns = tokenize_report_columns(max_seq_len, src_lang, langs, id_field, order_field or id_field)
    return numbered_report(materialize(encoded.select(*columns), "lengths"))
