"""Aggregates over reports and lengths."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.operators.boundary import stage_boundary
from pairloom.operators.encode import TOKENIZED
from pairloom.schemas import LANGS
from pairloom.sources.storage import materialize


def label_counts(report: DataFrame, suffix: str, *, langs: Sequence[str] = LANGS) -> DataFrame:
    """Per label its count on each side and in total, largest total first.

    ``suffix`` names the label columns: ``norm_changes`` or ``flaws``.
    """

    def tagged(lang: str) -> Column:
        side = F.lit(lang).alias("side")
        return F.transform(f"{lang}_{suffix}", lambda label: F.struct(label.alias("label"), side))

    # Exploding adds a test for empty arrays; the boundary keeps it from repeating the work
    # behind the labels. Labels are few, so each task passes on a handful of counts.
    counts = (
        stage_boundary(report)
        .select(F.explode(F.concat(*map(tagged, langs))).alias("hit"))
        .groupBy(F.col("hit.label").alias("label"))
        .agg(*(F.count_if(F.col("hit.side") == lang).alias(lang) for lang in langs), F.count(F.lit(1)).alias("total"))
    )
    return counts.orderBy(F.desc("total"), "label")


def norm_change_counts(report: DataFrame, *, langs: Sequence[str] = LANGS) -> DataFrame:
    return label_counts(report, "norm_changes", langs=langs)


def flaw_counts(report: DataFrame, *, langs: Sequence[str] = LANGS) -> DataFrame:
    return label_counts(report, "flaws", langs=langs)


def pair_flaw_counts(report: DataFrame) -> DataFrame:
    """Per pair flaw its count, largest first."""
    labels = stage_boundary(report).select(F.explode("pair_flaws").alias("label"))
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), "label")


def char_lengths(df: DataFrame, *, langs: Sequence[str] = LANGS) -> DataFrame:
    """Characters per side, from ``translation`` or else from top-level columns.

    Rows lacking a side are skipped.
    """
    fields = df.schema.fieldNames()
    nested = "translation" in fields and isinstance(df.schema["translation"].dataType, T.StructType)
    texts = {lang: F.col(f"translation.{lang}" if nested else lang) for lang in langs}
    return _complete(df, {lang: F.length(text.cast("string")) for lang, text in texts.items()})


def token_lengths(df: DataFrame, *, key: str = TOKENIZED, langs: Sequence[str] = LANGS) -> DataFrame:
    """Tokens per side; rows lacking an encoding are skipped."""
    ids = {lang: F.col(f"{key}.{lang}.input_ids") for lang in langs}
    return _complete(df, {lang: F.when(i.isNotNull(), F.size(i)) for lang, i in ids.items()})


def _complete(df: DataFrame, lengths: dict[str, Column]) -> DataFrame:
    # The boundary keeps the null test from repeating the work behind the lengths.
    return stage_boundary(df).select(*(length.alias(lang) for lang, length in lengths.items())).dropna(how="any")


def histogram_edges(low: int | None, high: int | None, max_bins: int = 60) -> tuple[float, int, int]:
    """First edge, bin width and number of bins for integers from ``low`` to ``high``.

    Edges lie half-way between integers, so no value ever sits on one.
    """
    if low is None or high is None:
        return -0.5, 1, 1
    span = high - low + 1
    width = max(1, -(-span // max_bins))
    return low - 0.5, width, -(-span // width)


def length_histogram(lengths: DataFrame, *, max_bins: int = 60, langs: Sequence[str] = LANGS) -> DataFrame:
    """Counts per bin and side; all bins are present: ``bin, lower, upper, <lang>...``.

    The lengths are counted per distinct value in one pass; that small table is stored
    and gives both the range and the bins.
    """
    sides = F.explode(F.array(*(F.struct(F.lit(lang).alias("side"), F.col(lang).alias("value")) for lang in langs)))
    values = lengths.select(sides.alias("one")).groupBy("one.side", "one.value").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(values, "lengths")
    span = counts.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
    first, width, bins = histogram_edges(span["low"], span["high"], max_bins)
    number = F.floor((F.col("value") - F.lit(first)) / width).cast("long")
    filled = counts.groupBy(number.alias("bin")).agg(
        *(F.sum(F.when(F.col("side") == lang, F.col("n")).otherwise(0)).alias(lang) for lang in langs)
    )
    lower = F.lit(first) + F.col("bin") * width
    # At most max_bins rows on either side of this join.
    return (
        counts.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(filled, "bin", "left")
        .select(
            "bin",
            lower.alias("lower"),
            (lower + width).alias("upper"),
            *(F.coalesce(F.col(lang), F.lit(0)).alias(lang) for lang in langs),
        )
        .orderBy("bin")
    )
