"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

A document is a bag of five-word shingles, weighted by tf times idf; a shingle's idf is the mean
of its words' idf over all documents. Words are split at white space and compared by their
letters and digits in lower case. Word frequencies are counted in a table of a fixed number of
hashed buckets, so it has a fixed size at any size of the corpus. The idf of the words and not of the
shingle itself is used because a shingle's own frequency measures how often the document
was copied: weighting by it would make large groups of near copies look unlike each other.

Each document gets ``BANDS * ROWS`` consistent weighted samples: for each sample, every shingle of
weight S draws r, c from Gamma(2, 1) and b from [0, 1) by its hash, t = floor(ln S / r + b), and the
shingle with the least c / exp(r * (t - b + 1)) is sampled with its t. Two documents agree in a
sample with the probability of their weighted Jaccard similarity. Documents that agree in a whole
band are candidates (at the threshold of 0.8 a pair is missed with probability 0.0008), and the
exact weighted Jaccard similarity decides.

Equal texts are one node throughout. A bucket may be large, so its documents are first compared with one
of them only: that which lies in the largest buckets, as it has the fewest changes of its own. That
links most of a group of near copies. Documents of buckets that still hold several components are compared with
another hub, that with the least of its own among those that share a rare shingle, and then joined exactly, by a prefix join with a position filter. In any order of shingles, the first one that two
similar bags share stands near the beginning of both, as all that either has before it isn't shared. With rare
shingles first, a bag begins with what distinguishes it from its near copies, so a document with too many
changes of its own meets none of them. All that meet in different components are compared.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import SHINGLE_WORDS, SIMILARITY, broadcast_if_small, set_aside
from pairloom.llm.components import connected_components
from pairloom.llm.hashing import MASK, STEP, WordHashes, mix, tidy, windows
from pairloom.sources.storage import materialize

BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
BUCKETS = 1 << 18
# Hashed shingle frequencies that order shingles by rarity; ties and collisions only cost time.
RARITY_BUCKETS = 1 << 20
# Pairs that agree in fewer of the 30 samples aren't verified: at a similarity of 0.8 that has a
# probability of 1e-9.
LEAST_AGREEMENT = 9
# Texts that are compared with one copy of their hub's text, about.
HUB_MEMBERS = 1000
LEVELS = 1 << 16
# Weights are sums of numbers of six digits.
SLACK = 1e-6
# Shingles that are sampled at a time, and the bits for the place of one in a document's and the chunk's shingles.
CHUNK = 1 << 16
PLACE_BITS, PLACE_SCALE = 28, 27


def _gamma_levels() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of equal steps of probability."""
    p = (np.arange(LEVELS) + 0.5) / LEVELS
    x = np.full(LEVELS, 1.7)
    for _ in range(60):  # Newton's method on 1 - (1 + x) exp(-x), kept positive
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 8)
    return x


def bag(words: np.ndarray, idf: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, their weights and their idf."""
    hashes = windows(words, size)
    own = idf[(words & np.uint64(len(idf) - 1)).astype(np.int64)]
    sums = np.concatenate([[0.0], np.cumsum(own)])
    # Rounded: a running sum would make the last bits depend on what stands before.
    means = np.round((sums[size:] - sums[:-size]) / size, 6) if len(hashes) else np.empty(0)
    keys, first, count = np.unique(hashes, return_index=True, return_counts=True)
    return keys, means[first] * count, means[first]


def similarity(a, b) -> float:
    """Weighted Jaccard similarity of two bags."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum() if len(common) else 0.0
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 0.0


def sample(keys: np.ndarray, weights: np.ndarray, starts: np.ndarray, gamma: np.ndarray, log_gamma: np.ndarray):
    """``(documents, SAMPLES)`` sample hashes of the documents whose bags begin at ``starts``."""
    out = np.empty((len(starts), SAMPLES), np.uint64)
    log_w, places = np.log(weights), np.arange(len(keys))
    for k in range(SAMPLES):
        x = mix(keys ^ np.uint64((STEP * (k + 1)) & MASK)).view(np.int64)
        r = gamma[x & (LEVELS - 1)]
        b = (x >> 32 & 0xFFFFFF) * 2.0**-24
        t = np.floor(log_w / r + b)
        a = log_gamma[x >> 16 & (LEVELS - 1)] - r * (t - b + 1)
        # The least value and its place in one number; a lies well within the bounds.
        packed = ((np.clip(a, -63, 63) + 64) * 2.0**PLACE_SCALE).astype(np.int64) << PLACE_BITS | places
        at = np.minimum.reduceat(packed, starts) & ((1 << PLACE_BITS) - 1)
        out[:, k] = mix(keys[at] + t[at].astype(np.int64).astype(np.uint64) * np.uint64(STEP) + np.uint64(k))
    return out


def word_idf(texts: DataFrame) -> np.ndarray:
    """Idf of every word bucket over all documents; ``texts(text)``."""

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, df, docs = WordHashes(), np.zeros(BUCKETS, np.int64), 0
        last = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                slots = (cache.of(text) & np.uint64(BUCKETS - 1)).view(np.int64)
                # Each slot once: where the last place written to it is the own one.
                places = np.arange(len(slots))
                last[slots] = places
                df[slots[last[slots] == places]] += 1
                docs += 1
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(seen, -1), "n": np.append(df[seen], docs)})

    counted = texts.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow().to_pandas()  # BUCKETS + 1 rows at most
    df = np.zeros(BUCKETS)
    total = float(rows.loc[rows["bucket"] < 0, "n"].sum())
    rows = rows[rows["bucket"] >= 0]
    df[rows["bucket"].to_numpy(np.int64)] = rows["n"]
    return np.log((total + 1) / (df + 1)) + 1


def signatures(texts: DataFrame, idf, size: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, t, samples)`` of the texts; samples are empty for texts of fewer words than a shingle."""

    @tidy
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, gamma, weights = WordHashes(), _gamma_levels(), idf.value
        log_gamma = np.log(gamma)
        for batch in batches:
            samples: list = [np.empty(0, np.int64)] * len(batch)
            waiting, held = [], 0

            def flush():
                starts = np.cumsum([0] + [len(b[0]) for _, b in waiting[:-1]])
                keys = np.concatenate([b[0] for _, b in waiting])
                found = sample(keys, np.concatenate([b[1] for _, b in waiting]), starts, gamma, log_gamma)
                for (row, _), values in zip(waiting, found.view(np.int64)):
                    samples[row] = values
                waiting.clear()

            for row, text in enumerate(batch["text"]):
                of_text = bag(cache.of(text), weights, size)
                if len(of_text[0]):
                    waiting.append((row, of_text))
                    held += len(of_text[0])
                    if held >= CHUNK:
                        flush()
                        held = 0
            if waiting:
                flush()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "t": batch["t"], "samples": samples})

    return texts.mapInPandas(sign, "doc_id string, t binary, samples array<long>")


def _band_keys() -> Column:
    bands = [F.xxhash64(F.lit(b), *[F.get("samples", F.lit(b * ROWS + r)) for r in range(ROWS)]) for b in range(BANDS)]
    return F.explode(F.array(*bands))


def _verified(pairs: DataFrame, suspects: DataFrame, idf, threshold: float, size: int) -> DataFrame:
    """The pairs ``(a, b)`` of text keys whose texts are similar enough.

    Many pairs may have one ``b``, a hub. They are dealt in groups of about ``HUB_MEMBERS``, and each group gets the hub's text
    once, in front of its own texts.
    """
    pairs = materialize(pairs, "compared")
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB_MEMBERS).alias("groups"))
    dealt = pairs.join(many, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("groups")).alias("group"))
    texts = suspects.select("t", "text")
    members = dealt.join(texts, F.col("a") == F.col("t")).select("b", "group", "a", "text")
    hubs = dealt.select("b", "group").distinct().join(texts, F.col("b") == F.col("t"))
    hubs = hubs.select("b", "group", F.lit(None).cast("binary").alias("a"), "text")
    # Null comes first: the hub.
    rows = members.unionByName(hubs).repartition("b", "group").sortWithinPartitions("b", "group", "a")

    @tidy
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, weights, of_hub = WordHashes(), idf.value, None
        for batch in batches:
            good = np.zeros(len(batch), bool)
            for k, (member, text) in enumerate(zip(batch["a"], batch["text"])):
                own = bag(cache.of(text), weights, size)
                if member is None:
                    of_hub = own
                else:
                    good[k] = similarity(own, of_hub) >= threshold
            yield batch.loc[good, ["a", "b"]]

    return rows.mapInPandas(compare, "a binary, b binary")


def _prefixes(apart: DataFrame, idf, threshold: float, size: int) -> DataFrame:
    """``(t, root, w, before, shingle)``: the first shingles of each bag, of which similar bags share one.

    ``w`` is the weight of the bag, ``before`` that of the shingles before this one, ``own`` the share
    of the bag that few other texts have.
    """
    spark = apart.sparkSession

    def slots(keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(RARITY_BUCKETS - 1)).astype(np.int64)

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, weights, df = WordHashes(), idf.value, np.zeros(RARITY_BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                df[slots(bag(cache.of(text), weights, size)[0])] += 1
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"slot": seen, "n": df[seen]})

    counted = apart.select("text").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    # Slots that one text has are the many; they need no row.
    rows = counted.where("n > 1").toArrow().to_pandas()  # RARITY_BUCKETS rows at most
    df = np.ones(RARITY_BUCKETS, np.int64)
    df[rows["slot"].to_numpy(np.int64)] = rows["n"]
    rarity = spark.sparkContext.broadcast(df)

    @tidy
    def prefix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, weights, df = WordHashes(), idf.value, rarity.value
        for batch in batches:
            found = []
            for text in batch["text"]:
                keys, w, _ = bag(cache.of(text), weights, size)
                order = np.lexsort((keys, df[slots(keys)]))
                before = np.concatenate([[0.0], np.cumsum(w[order])[:-1]])
                # What is shared weighs at least threshold times the whole.
                first = before <= (1 - threshold) * w.sum() + SLACK
                # What few other texts have, as a share of the bag.
                own = float((w / df[slots(keys)]).sum() / w.sum())
                whole = np.full(first.sum(), w.sum())
                found.append((keys[order[first]].view(np.int64), before[first], whole, np.full(len(whole), own)))
            lengths = [len(f[0]) for f in found]
            columns = {c: batch[c].repeat(lengths).to_numpy() for c in ("t", "root")}
            columns |= {c: np.concatenate([f[k] for f in found]) for k, c in enumerate(("shingle", "before", "w", "own"))}
            yield pd.DataFrame(columns)

    schema = "t binary, root binary, shingle long, before double, w double, own double"
    return materialize(apart.mapInPandas(prefix, schema), "prefixes")


def _pairs_apart(prefixes: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components that share a prefix shingle and may be similar by what follows it.

    The bag of less weight needs the shorter prefix, as the other one has at least as much to share.
    """
    side = lambda p: prefixes.select("shingle", *[F.col(c).alias(f"{p}_{c}") for c in ("t", "root", "w", "before")])
    both = threshold / (1 + threshold)
    light, heavy = side("a"), side("b")
    light = light.where(F.col("a_before") <= F.col("a_w") * (1 - 2 * both) + SLACK)
    needed = (F.col("a_w") + F.col("b_w")) * both - SLACK
    rest = F.least(F.col("a_w") - F.col("a_before"), F.col("b_w") - F.col("b_before"))
    in_order = F.struct("a_w", "a_t") < F.struct("b_w", "b_t")
    size = F.col("a_w") >= F.col("b_w") * threshold - SLACK
    apart = F.col("a_root") != F.col("b_root")
    same = light["shingle"] == heavy["shingle"]
    met = light.join(heavy, same & apart & in_order & size & (rest >= needed))
    return met.select(F.col("a_t").alias("a"), F.col("b_t").alias("b")).distinct()


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = SIMILARITY,
    size: int = SHINGLE_WORDS,
) -> DataFrame:
    """``(doc_id, class_id)``, one row for each distinct id and text; the class is its smallest id.

    Equal texts are one class, also those of too few words for a shingle. Null, empty and other
    texts without a word are never duplicates: each row is its own class. Null ids are allowed and
    count as larger than others; a class of null ids has a null class id. Ids must be integers.
    """
    return _classes(docs, id_col, text_col, threshold, size).select("doc_id", "class_id").distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, size: int) -> DataFrame:
    """``(doc_id, t, class_id, stays)`` of all documents; ``t`` is null for texts without words.

    One id and text of a class stays, the smallest.
    """
    spark: SparkSession = docs.sparkSession
    # Ids pass through pandas as text, which would make floats of a column of integers and nulls.
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    has_word = F.coalesce(F.col("text"), F.lit("")).rlike(r"[\p{L}\p{N}]")
    texts = docs.where(has_word).select("doc_id", F.unhex(F.md5("text")).alias("t"), "text")
    idf = spark.sparkContext.broadcast(word_idf(texts))
    as_text = texts.withColumn("doc_id", F.col("doc_id").cast("string"))
    signed = signatures(as_text, idf, size).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = materialize(signed, "signed")

    nodes = signed.groupBy("t").agg(F.min("doc_id").alias("doc_id"), F.first("samples").alias("samples"))
    nodes = materialize(nodes, "nodes")
    members = nodes.where(F.size("samples") > 0).select(_band_keys().alias("key"), "t")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(members.join(shared, "key"), "members")
    # Few changes of its own put a document in large buckets.
    central = members.groupBy("t").agg(F.round(F.sum(F.log("n")), 6).alias("central"))
    ranked = members.join(central, "t").select("key", "t", F.struct("central", "t").alias("rank"))
    hubs = ranked.groupBy("key").agg(F.max("rank").alias("hub")).select("key", F.col("hub.t").alias("hub"))
    wanted = members.select("t").distinct().join(nodes, "t").select("t", F.col("doc_id").alias("of_doc"))
    wanted = broadcast_if_small(materialize(wanted, "wanted"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (texts["t"] == wanted["t"])
    suspects = texts.join(wanted, same).select(texts["t"], "text").dropDuplicates(["t"])
    suspects = materialize(suspects, "suspects")
    sampled = nodes.select("t", "samples").join(members.select("t").distinct(), "t", "left_semi")

    def plausible(pairs: DataFrame) -> DataFrame:
        a = sampled.select(F.col("t").alias("a"), F.col("samples").alias("sa"))
        b = sampled.select(F.col("t").alias("b"), F.col("samples").alias("sb"))
        agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
        return pairs.join(a, "a").join(b, "b").where(agree >= LEAST_AGREEMENT).select("a", "b")

    pairs = members.join(hubs, "key").where(F.col("t") != F.col("hub"))
    pairs = pairs.select(F.col("t").alias("a"), F.col("hub").alias("b")).distinct()
    links = materialize(_verified(plausible(pairs), suspects, idf, threshold, size), "similar")
    roots = connected_components(links)
    placed = members.select("key", "t").join(roots, F.col("t") == F.col("node"), "left")
    placed = placed.select("key", "t", F.coalesce("root", "t").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    mixed = placed.join(mixed.where(F.col("x") != F.col("y")).select("key"), "key", "left_semi")
    mixed = materialize(mixed.select("t", "root").distinct(), "mixed")
    apart = suspects.join(mixed, "t").select("t", "root", "text")
    prefixes = _prefixes(apart, idf, threshold, size)
    # Once more hubs, those with the least of their own in the group of a prefix shingle, now that this is known.
    hubs = prefixes.groupBy("shingle").agg(F.min(F.struct("own", "t", "root")).alias("hub"))
    pairs = prefixes.join(hubs, (prefixes["shingle"] == hubs["shingle"]) & (F.col("root") != F.col("hub.root")))
    pairs = plausible(pairs.select(F.col("t").alias("a"), F.col("hub.t").alias("b")).distinct())
    links = links.unionByName(materialize(_verified(pairs, suspects, idf, threshold, size), "similar"))
    roots = connected_components(links)
    placed = prefixes.drop("root").join(roots, F.col("t") == F.col("node"), "left")
    prefixes = placed.withColumn("root", F.coalesce("root", "t")).drop("node")
    pairs = plausible(_pairs_apart(prefixes, threshold))
    more = materialize(_verified(pairs, suspects, idf, threshold, size), "similar")
    roots = connected_components(links.unionByName(more))

    placed = signed.select("doc_id", "t").join(roots, F.col("t") == F.col("node"), "left")
    placed = placed.select("doc_id", "t", F.coalesce("root", "t").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("t"))
    smallest = placed.groupBy("root").agg(F.min(order).alias("first"))
    classed = placed.join(smallest, "root").select(
        "doc_id", "t", F.col("first.doc_id").alias("class_id"), (order.eqNullSafe(F.col("first"))).alias("stays")
    )
    wordless = docs.where(~has_word).select(
        "doc_id", F.lit(None).cast("binary").alias("t"), F.col("doc_id").alias("class_id"), F.lit(True).alias("stays")
    )
    return classed.unionByName(wordless)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the near duplicates of a document with a smaller id, with all columns.

    Rows with the same id and text are one document and stay or go together.
    """
    options = {"threshold": SIMILARITY, "size": SHINGLE_WORDS} | options
    columns = docs.columns
    docs, own = set_aside(docs)
    id_col, text_col = own[id_col], own[text_col]
    classes = _classes(docs, id_col, text_col, options["threshold"], options["size"])
    go = classes.where(~F.col("stays")).select(F.col("doc_id").alias("__doc"), F.col("t").alias("__t")).distinct()
    go = broadcast_if_small(materialize(go, "go"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__doc")) & (F.unhex(F.md5(F.col(text_col))) == F.col("__t"))
    return docs.join(go, same, "left_anti").toDF(*columns)
