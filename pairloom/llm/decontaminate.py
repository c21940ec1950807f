"""Benchmark decontamination: size-partitioned MinHash containment search with an exact check.

Only DataFrame functions. A benchmark item counts as leaked into a document if at least
``threshold`` of its distinct word shingles occur in the document, which may be any length.

A MinHash signature of a whole long document says nothing about a short item inside it, so the
search is turned round: the *item* gets a bottom-k MinHash sketch, its k smallest shingle hashes,
and documents are probed with them. Items are partitioned by their number n of shingles, and the
partition sets k = n - ceil(threshold * n) + 1: among that many shingles at least one must be
in any document that contains ``threshold`` of them, so no leak is missed at any length.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import SHINGLE_WORDS, SIMILARITY, broadcast_if_small, set_aside, with_shingle_hashes, with_shingles
from pairloom.sources.storage import materialize

# A sketch table of at most this many rows (16 bytes each) is sent to every executor; a larger
# one is joined by shuffling.
BROADCAST_KEYS = 1_000_000


def item_sketches(items: DataFrame, size: int = SHINGLE_WORDS, threshold: float = SIMILARITY) -> DataFrame:
    """``(item_id, key)``: the k smallest shingle hashes of each item."""
    sets = with_shingle_hashes(items, "text", "hashes", size)
    n = F.size("hashes")
    # Rounded before ceil: 0.8 * 5 is a little more than 4 in binary.
    needed = F.ceil(F.round(n * F.lit(threshold), 6)).cast("int")
    return sets.where(n > 0).select(
        "item_id", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), n - needed + 1)).alias("key")
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: float = SIMILARITY,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item, containment)`` of every leak.

    Null and empty texts and items of fewer than ``size`` words match nothing. Equal items each
    match; rows repeating an id count as one text each, and equal result rows come once. Other
    columns are ignored, whatever their names.
    """
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.where(F.col("text").isNotNull()).withColumn("text_key", F.xxhash64("text"))
    keys = item_sketches(items, size, threshold)
    # Equal items share keys: a document's key is looked up once, then fans out to the items.
    distinct = keys.select("key").distinct()
    small = keys.limit(broadcast_keys + 1).count() <= broadcast_keys
    probes = with_shingle_hashes(docs, "text", "keys", size).select(
        "doc_id", "text_key", F.explode("keys").alias("key")
    )
    hits = probes.join(F.broadcast(distinct) if small else distinct, "key")
    candidates = hits.join(F.broadcast(keys) if small else keys, "key").select("doc_id", "text_key", "item_id")
    candidates = candidates.groupBy("doc_id", "text_key", "item_id").agg(F.count("*").alias("found"))

    # The exact check compares the words themselves. A document is split once for all its items.
    wanted = candidates.groupBy("doc_id", "text_key").agg(F.collect_list("item_id").alias("item_ids"))
    # Suspects are few: their keys travel to the texts, rather than all texts to their keys.
    wanted = broadcast_if_small(materialize(wanted.toDF("of_doc", "of_text", "item_ids"), "wanted"), F.size("item_ids") + 1)
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    suspects = docs.join(wanted, same).select("doc_id", "text", "item_ids")
    doc_sets = with_shingles(suspects, "text", "doc_set", size).drop("text")
    pairs = doc_sets.select("doc_id", "doc_set", F.explode("item_ids").alias("item_id"))
    item_sets = with_shingles(items, "text", "item_set", size).drop("text").where(F.size("item_set") > 0)
    checked = pairs.join(F.broadcast(item_sets) if small else item_sets, "item_id").select(
        "doc_id",
        "item_id",
        F.size(F.array_intersect("doc_set", "item_set")).cast("long").alias("n_shared"),
        F.size("item_set").cast("long").alias("n_item"),
    )
    enough = F.col("n_shared") >= F.ceil(F.round(F.col("n_item") * F.lit(threshold), 6))
    return checked.where(enough).withColumn("containment", F.col("n_shared") / F.col("n_item")).distinct()


def remove_leaked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without a leak, with all their columns; those with null ids or texts stay."""
    columns = docs.columns
    docs, own = set_aside(docs)
    leaked = find_leaks(docs, items, own[id_col], own[text_col], **options).select(F.col("doc_id").alias("leaked")).distinct()
    return docs.join(leaked, F.col(own[id_col]) == F.col("leaked"), "left_anti").toDF(*columns)
