"""Exact top-k inner products: vectors grouped by length, pruned per bucket by local cosine thresholds.

Every component x becomes floor(256 * x); scores are integer inner products, so they are exact. Vectors
are grouped into buckets of similar length, and large buckets dealt into blocks; queries are blocks too. The
longest vectors are searched first, as many blocks of them as hold ``SEEDS`` vectors, which gives every query a lower bound
on its k-th best score. From that bound, the length of the longest vector in a block and the query's own length follows the
cosine that a vector of the block must reach. Queries are then dealt anew, by the length that they ask for, and a
block whose vectors are all shorter than its queries ask for isn't sent to them. Else the
vectors left are those whose length suffices, or, if the cosine is high, those whose few most telling
coordinates lie in the range that the cosine allows; only their products are computed.

Vectors of one length in no direction that is common leave nothing to prune: there, queries times vectors are inherent in an
exact search of 2 % of all rows against all. Blocks of both meet by a join on block numbers, so a task holds one block of each.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.sources.storage import materialize

K = 5
QUERY_EVERY = 50
BLOCK = 4096
QUERY_BLOCK = 1024
# Vectors, the longest ones, that give the bounds.
SEEDS = 4096
# Lengths in a bucket differ by this factor at most.
BUCKET_RATIO = 1.1
# Coordinates looked at, and the least local cosine at which they prune more than they cost.
FOCUS = 3
COSINE = 0.5
# Products of floats are exact below this; above it, Python integers are used.
EXACT = float(1 << 53)

PACKED = "dim int, block long, n long, longest double, ids binary, vectors binary, shortest double, least binary"
HITS = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, dim, v, length)`` of the vectors that take part."""
    x = F.col("x")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(F.coalesce(c, F.lit(0.0))))
    rows = rows.where(x.isNotNull() & (F.size(x) > 0) & F.col("vec_id").isNotNull()).where(finite)
    rows = rows.select("vec_id", F.size("x").alias("dim"), F.transform("x", lambda c: F.floor(c * 256).cast("double")).alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def _packed(rows: DataFrame) -> DataFrame:
    """One row per block, its vectors longest first. ``least`` of the rows are their bounds, ``asked`` the lengths these ask for."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "vec_id"], ascending=[False, True])
        matrix = np.stack(part["v"].to_numpy()).astype("<f8")
        ids, least = part["vec_id"].to_numpy("<i8").tobytes(), part["least"].to_numpy("<f8").tobytes()
        row = (part["dim"].iloc[0], part["block"].iloc[0], len(part), part["length"].iloc[0], ids, matrix.tobytes(), part["asked"].min(), least)
        return pd.DataFrame([row], columns=["dim", "block", "n", "longest", "ids", "vectors", "shortest", "least"])

    for name in ("least", "asked"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(float("-inf")))
    return rows.select("dim", "block", "vec_id", "v", "length", "least", "asked").groupBy("dim", "block").applyInPandas(pack, PACKED)


def _bucket(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log(size) / float(np.log(BUCKET_RATIO)))).otherwise(-(10**6))


def _blocks(rows: DataFrame, bucket, size: int) -> DataFrame:
    """Deals rows into blocks of about ``size``: buckets first, large buckets split by a hash of the row, which must be stored."""
    rows = rows.withColumn("bucket", bucket)
    counts = rows.groupBy("dim", "bucket").agg(F.count("*").alias("count"))
    parts = F.ceil(F.col("count") / size)
    rows = rows.join(F.broadcast(counts), ["dim", "bucket"])  # one row for each power of BUCKET_RATIO
    return rows.withColumn("block", F.xxhash64("bucket", F.pmod(F.xxhash64("row"), parts)))


def _meeting(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """``(dim, block, q_block)``: numbers of blocks that meet; one that is too short for a whole block of queries stays away."""
    asked = queries.select("dim", F.col("block").alias("q_block"), "shortest")
    met = blocks.select("dim", "block", "longest").join(asked, "dim")
    return met.where(F.col("longest") * (1 + 1e-9) >= F.col("shortest")).select("dim", "block", "q_block")


class Block:
    def __init__(self, dim: int, ids: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.vectors = np.frombuffer(vectors, "<f8").reshape(len(self.ids), dim)
        self.lengths = np.sqrt((self.vectors**2).sum(axis=1))
        self.units = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    bound = float(np.abs(vectors).max(initial=0.0)) * float(np.abs(query).max(initial=0.0)) * len(query)
    if bound < EXACT:
        return vectors @ query
    whole = [int(c) for c in query]
    return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in vectors], object)


def candidates(block: Block, query: np.ndarray, length: float, least: float) -> np.ndarray | slice:
    """Rows of the block whose product with the query may reach ``least``."""
    if least <= 0 or length == 0:
        return slice(None)
    # Lengths fall along the block; a little slack for rounding.
    enough = np.searchsorted(-block.lengths, -(least / length) * (1 - 1e-9), side="right")
    if not enough:
        return np.empty(0, np.int64)
    cosine = least / (length * block.lengths[0])
    if cosine < COSINE:
        return slice(0, enough)
    unit = query / length
    rows = np.arange(enough)
    for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
        q = unit[f]
        spread = np.sqrt(max(0.0, (1 - q * q) * (1 - min(cosine, 1.0) ** 2)))
        p = block.units[rows, f]
        rows = rows[(p >= q * cosine - spread - 1e-9) | (q < 0)]
        p = block.units[rows, f]
        rows = rows[(p <= q * cosine + spread + 1e-9) | (q > 0)]
    return rows


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k and scores.dtype != object:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= cut)
        return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Best hits of each query in each block it meets; rows hold a packed block and packed queries."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block, queries = Block(row.dim, row.ids, row.vectors), Block(row.dim, row.q_ids, row.q_vectors)
                least = np.frombuffer(row.q_least, "<f8")
                out = []
                for n in np.flatnonzero(least <= queries.lengths * block.lengths[0] * (1 + 1e-9)):
                    query = queries.vectors[n]
                    rows = candidates(block, query, queries.lengths[n], least[n])
                    scores = products(block.vectors[rows], query)
                    ids = block.ids[rows]
                    keep = (ids != queries.ids[n]) & (scores >= least[n])
                    ids, scores = ids[keep], scores[keep]
                    top = best(ids, scores, k)
                    out.append(pd.DataFrame({"query_id": queries.ids[n], "vec_id": ids[top], "score": [int(s) for s in scores[top]]}))
                if out:
                    yield pd.concat(out)

    return pairs.mapInPandas(search, HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _pairs(met: DataFrame, blocks: DataFrame, queries: DataFrame) -> DataFrame:
    own = blocks.select("dim", "block", "ids", "vectors")
    names = {"block": "q_block", "ids": "q_ids", "vectors": "q_vectors", "least": "q_least"}
    asking = queries.select("dim", *[F.col(c).alias(n) for c, n in names.items()])
    return met.join(own, ["dim", "block"]).join(asking, ["dim", "q_block"])


def prepared(rows: DataFrame, k: int, every: int, block: int, query_block: int, seeds: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of vectors, and of queries with their bounds."""
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = materialize(_packed(_blocks(rows, _bucket(F.col("length")), block)), "blocks")
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    asked = materialize(asked.withColumn("row", F.xxhash64("vec_id", "v")), "asked")

    # First the blocks with the longest vectors of each dimension give every query a bound.
    longer = Window.partitionBy("dim").orderBy(F.desc("longest"), "block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select("dim", "block", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("before"))
    first = first.where(F.col("before") < max(seeds, k + 1)).select("dim", "block")
    unbound = _packed(_blocks(asked, F.lit(0), query_block))
    met = first.join(unbound.select("dim", F.col("block").alias("q_block")), "dim")
    found = _ranked(_search(_pairs(met, blocks, unbound), k), k).where(F.col("rank") == k)
    bounds = materialize(found.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least")), "bounds")

    least = F.coalesce(F.col("least"), F.lit(float("-inf")))
    # A query of length zero accepts all.
    length = F.when((least > 0) & (F.col("length") > 0), least / F.col("length")).otherwise(F.lit(0.0))
    bound = asked.join(bounds, "vec_id", "left").withColumn("asked", length).withColumn("least", least)
    return blocks, materialize(_packed(_blocks(bound, _bucket(F.col("asked")), query_block)), "queries")


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    every: int = QUERY_EVERY,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
    seeds: int = SEEDS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other vectors for each query.

    Queries are the rows whose id is divisible by ``every``. Vectors that are null or empty, have a null id
    or hold null or non-finite components take no part; vectors of another dimension than the query's
    aren't compared with it. A repeated id is the same row to a query: its own copies are no answers, and
    copies of another id each count. Ties go to the smaller id.
    """
    blocks, queries = prepared(quantised(vectors, id_col, vector_col), k, every, block, query_block, seeds)
    pairs = _pairs(_meeting(blocks, queries), blocks, queries)
    return _ranked(_search(pairs, k), k).select("query_id", "rank", "vec_id", "score")
