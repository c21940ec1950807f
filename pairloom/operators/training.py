"""Projection of encoded pairs to the flat training schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.encode import TOKENIZED


def with_markers(ids: Column, bos_id: int | None, eos_id: int | None) -> Column:
    """Begin id in front unless it is first already, then end id unless it is last."""
    for marker, place in ((bos_id, 1), (eos_id, -1)):
        if marker is None:
            continue
        mark = F.array(F.lit(int(marker)))
        present = F.try_element_at(ids, F.lit(place)).eqNullSafe(F.lit(int(marker)))
        longer = F.concat(mark, ids) if place == 1 else F.concat(ids, mark)
        ids = F.when(present, ids).otherwise(longer)
    return ids


def training_columns(
    *,
    src_lang: str,
    tgt_lang: str,
    id_key: str | None = None,
    tokenized_key: str = TOKENIZED,
    tgt_bos_id: int | None = None,
    tgt_eos_id: int | None = None,
    include_text: bool = False,
) -> list[Column]:
    """``id, src_ids, tgt_ids`` and on request ``src_text, tgt_text`` of encoded pairs."""

    def ids(lang: str) -> Column:
        return F.col(f"{tokenized_key}.{lang}.input_ids").cast("array<int>")

    columns = [
        F.col(id_key or "id").cast("long").alias("id"),
        ids(src_lang).alias("src_ids"),
        with_markers(ids(tgt_lang), tgt_bos_id, tgt_eos_id).alias("tgt_ids"),
    ]
    if include_text:
        columns += [
            F.col(f"translation.{lang}").cast("string").alias(name)
            for lang, name in ((src_lang, "src_text"), (tgt_lang, "tgt_text"))
        ]
    return columns


def map_training(df: DataFrame, **options) -> DataFrame:
    """Select the ``training_columns``, whose options these are."""
    return df.select(training_columns(**options))
