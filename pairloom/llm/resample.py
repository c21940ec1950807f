"""Importance resampling of documents towards a target: hashed n-gram models and Gumbel top-k.

Two bag-of-n-grams models over hashed words and word pairs, one of the target texts (labelled good and
not toxic) and one of all texts, give each document the log of its likelihood ratio. Adding Gumbel
noise and taking the k largest draws k documents without replacement in proportion to the ratio.
The noise is a hash of seed, id and text, so a repeated run draws the same documents.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import broadcast_if_small
from pairloom.llm.hashing import WordHashes, windows
from pairloom.sources.storage import materialize

BUCKETS = 10_000
FRACTION = 0.5
SEED = 7
# Keys that the driver sorts to find the last one drawn, at most.
LAST_KEYS = 10_000


def ngram_counts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Counts of words and word pairs by bucket."""
    both = np.concatenate([windows(hashes, 1), windows(hashes, 2)])
    return np.bincount((both % np.uint64(buckets)).astype(np.int64), minlength=buckets)


def fit_log_ratio(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``log(p_target / p_raw)`` by bucket, from all of ``texts(text, target)``, with add-one smoothing."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, wanted in zip(batch["text"], batch["target"]):
                counts = ngram_counts(cache.of(text), buckets)
                raw += counts
                if wanted:
                    target += counts
        yield pd.DataFrame({"bucket": np.arange(buckets), "raw": raw, "target": target})

    counted = texts.mapInPandas(count, "bucket long, raw long, target long").groupBy("bucket")
    rows = counted.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow().to_pandas()  # one per bucket
    raw, target = np.ones(buckets), np.ones(buckets)
    at = rows["bucket"].to_numpy(np.int64)
    raw[at] += rows["raw"]
    target[at] += rows["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The exact k-th largest value, by counting in ever narrower ranges; None if k is 0."""
    if k <= 0:
        return None
    kept = values.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    low, high, count = kept.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not count:
        return None
    k = min(k, count)
    while count > LAST_KEYS and low < high:
        width = (high - low) / 1024
        slot = F.least(F.floor((F.col("v") - low) / width), F.lit(1023)).cast("int")
        slots = kept.groupBy(slot.alias("slot")).agg(F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        for row in sorted(slots.collect(), key=lambda r: -r["slot"]):
            if k <= row["n"]:
                break
            k -= row["n"]
        if (row["a"], row["b"]) == (low, high):
            break  # as narrow as numbers get
        low, high, count = row["a"], row["b"], row["n"]
        kept = kept.where(F.col("v").between(low, high))
    if low == high:
        return low
    return kept.orderBy(F.desc("v")).limit(k).agg(F.min("v")).first()[0]


def _noise(seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fraction: float = FRACTION,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``(doc_id, log_weight, sample_key, selected)`` of every row of ``docs``.

    ``labels(doc_id, quality, toxic)``: a document is a target if a label of it has quality 1 and none
    has toxic 1; null labels say nothing. Of the n texts with words, the ceil(fraction * n) largest keys are selected;
    rows that repeat an id and a text share a key and are selected together, even if that is more.
    Null texts and texts without words have null weight and key and are never selected. Without a
    target, the smoothed target model is uniform.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    good = labels.groupBy(F.col("doc_id").alias("of_doc")).agg(
        F.max(F.coalesce(F.col("quality"), F.lit(0))).alias("quality"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic")
    )
    good = good.where("quality = 1 and toxic = 0").select("of_doc")
    good = broadcast_if_small(materialize(good, "targets"))
    marked = docs.where(F.col("text").isNotNull()).join(good, F.col("doc_id") == F.col("of_doc"), "left")
    marked = marked.select("text", F.col("of_doc").isNotNull().alias("target"))
    ratio = docs.sparkSession.sparkContext.broadcast(fit_log_ratio(marked, buckets))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, log_ratio = WordHashes(), ratio.value
        for batch in batches:
            weights = []
            for text in batch["text"]:
                hashes = cache.of(text or "")
                weights.append(float(ngram_counts(hashes, buckets) @ log_ratio) if len(hashes) else None)
            out = batch[["doc_id", "noise"]].copy()
            out["log_weight"] = pd.Series(weights, dtype="object")
            yield out

    noisy = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", _noise(seed).alias("noise"))
    scored = noisy.mapInPandas(weigh, "doc_id string, noise double, log_weight double")
    id_type = docs.schema["doc_id"].dataType
    scored = scored.select(
        F.col("doc_id").cast(id_type), "log_weight", (F.col("log_weight") + F.col("noise")).alias("sample_key")
    )
    scored = materialize(scored, "scored")
    count = scored.where(F.col("sample_key").isNotNull()).count()
    last = kth_largest(scored, "sample_key", math.ceil(round(fraction * count, 6)))
    chosen = F.lit(False) if last is None else F.coalesce(F.col("sample_key") >= F.lit(last), F.lit(False))
    return scored.withColumn("selected", chosen)
