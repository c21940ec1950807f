"""Packing documents into sequences with lexical neighbours from a sharded BM25 index.

Every document becomes its token ids and an end id. Whole windows of it are sequences of their own;
what is left, shorter than a window, is a unit to pack. Units are sorted by a MinHash of their most
telling tokens, so that related ones lie together, and dealt out in shards of a bounded size.
A shard has an inverted index of its units' tokens, weighted by BM25 with the document frequencies and
the mean length of all units. The first unused unit is the seed of a sequence: its most
telling tokens are the query, and unused neighbours fill the window in the order of their scores, first those
that fit whole; the best of the others is cut to fill the rest, and what remains of it is a unit again. The last
sequence of a shard, if not full, is cut into lengths that are powers of two, which need no padding.

A seed is compared with its own shard only. Searching all shards for every seed takes time with the square of the
corpus, since the tokens are a fixed vocabulary and every posting list grows with it; the README has what the shards
find of the neighbours in the whole corpus. Documents don't change by it, and each id lies in one piece.
"""

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.hashing import MASK, STEP, mix, tidy
from pairloom.llm.tokens import worker_encoder
from pairloom.sources.storage import materialize

WINDOW = 2048
END = 1
# Units and tokens of a shard; its index takes some 20 bytes a token.
SHARD_UNITS = 4096
SHARD_TOKENS = 4_000_000
# Tokens on which a partition of the sorted units works; it holds one shard at a time.
PARTITION_TOKENS = 4_000_000
# Keys that are sampled for each partition, to cut the range of keys into even parts.
KEYS_SAMPLED = 50
# Neighbours that are ranked at first; all are if these don't fill the window.
RANKED = 128
QUERY_TOKENS = 32
KEY_TOKENS = 16
K1, B = 1.2, 0.75

PIECES = (
    "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """``(doc_id, doc_tokens, window_crcs, rest)`` of ``docs(doc_id, text)``, ids as text; ``rest`` as 32-bit ids.

    ``tokenizer`` is the content of a tokenizer file. A null text is empty and has the end id only.
    """
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)

    @tidy
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(content.value)
        last = np.array([end], np.uint32)
        for batch in batches:
            totals, crcs, rests = [], [], []
            for ids in encoder.encode("" if t is None else t for t in batch["text"]):
                ids = np.concatenate([ids, last])
                whole = len(ids) // window
                totals.append(len(ids))
                crcs.append([_crc(ids[k * window : (k + 1) * window]) for k in range(whole)])
                rests.append(ids[whole * window :].astype("<u4").tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "doc_tokens": totals, "window_crcs": crcs, "rest": rests})

    return docs.mapInPandas(encode, "doc_id string, doc_tokens long, window_crcs array<long>, rest binary")


def distinct(ids: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Each id once: where the last place written to it is the own one. ``last`` is working space."""
    places = np.arange(len(ids))
    last[ids] = places
    return ids[last[ids] == places]


def corpus_statistics(encoded: DataFrame) -> tuple[np.ndarray, float, int, int]:
    """Idf by token id over all units, their mean length, their number and their tokens."""

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, last, units, tokens = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for rest in batch["rest"]:
                ids = np.frombuffer(rest, "<u4")
                if ids.max(initial=0) >= len(df):
                    more = np.zeros(int(ids.max()) + 1 - len(df), np.int64)
                    df, last = np.concatenate([df, more]), np.concatenate([last, more])
                df[distinct(ids, last)] += 1
                units += 1
                tokens += len(rest) // 4
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"token": np.append(seen, [-1, -2]), "n": np.append(df[seen], [units, tokens])})

    rows = encoded.where(F.length("rest") > 0).select("rest").mapInPandas(count, "token long, n long")
    rows = rows.groupBy("token").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # a row for each id of the vocabulary
    n = dict(zip(rows["token"], rows["n"]))
    units, tokens = int(n.get(-1, 0)), int(n.get(-2, 0))
    rows = rows[rows["token"] >= 0]
    df = np.zeros(int(rows["token"].max()) + 1 if len(rows) else 1)
    df[rows["token"].to_numpy(np.int64)] = rows["n"]
    return np.log(1 + (units - df + 0.5) / (df + 0.5)), tokens / max(units, 1), units, tokens


class Shard:
    """Inverted index of the units of a shard."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean_length: float):
        lengths = np.array([len(u) for u in units])
        pair = np.repeat(np.arange(len(units), dtype=np.int64) << 32, lengths)
        pair |= np.concatenate(units)
        pair.sort()
        begins = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        tf = np.diff(np.append(begins, len(pair))).astype(np.float32)
        pair = pair[begins]
        del begins
        # Narrow types: a worker holds the index of one shard beside the shard's ids.
        unit, token = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
        del pair
        norm = (K1 * (1 - B + B * lengths / mean_length)).astype(np.float32)[unit]
        weight = idf.astype(np.float32)[token] * tf * np.float32(K1 + 1) / (tf + norm)
        self.starts = np.searchsorted(unit, np.arange(len(units) + 1))
        self.token, self.weight = token, weight
        order = np.argsort(token, kind="stable").astype(np.int32)
        self.posted, self.post_weight = unit[order], weight[order]
        self.vocabulary, first = np.unique(token[order], return_index=True)
        self.first = np.append(first, len(order))
        self.count = len(units)

    def scores(self, seed: int) -> np.ndarray:
        """Scores of all units for the seed's most telling tokens."""
        own = slice(self.starts[seed], self.starts[seed + 1])
        token, weight = self.token[own], self.weight[own]
        query = token[np.lexsort((token, -weight))[:QUERY_TOKENS]]
        lists = [slice(self.first[at], self.first[at + 1]) for at in np.searchsorted(self.vocabulary, query)]
        if not lists:
            return np.zeros(self.count)
        posted, weights = np.concatenate([self.posted[x] for x in lists]), np.concatenate([self.post_weight[x] for x in lists])
        return np.bincount(posted, weights, minlength=self.count)


def fill_windows(units: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int) -> list[list[tuple]]:
    """Sequences of ``(unit, start in it, length)`` pieces; all but the last ones are full."""
    index = Shard(units, idf, mean_length)
    begun = np.zeros(len(units), np.int64)
    left = np.array([len(u) for u in units])
    unused = np.arange(len(units))
    sequences = []
    seed = 0
    while True:
        while seed < len(units) and not left[seed]:
            seed += 1
        if seed == len(units):
            break
        pieces, room = [], window

        def take(unit: int, room: int) -> int:
            length = int(min(left[unit], room))
            pieces.append((unit, int(begun[unit]), length))
            begun[unit] += length
            left[unit] -= length
            return room - length

        room = take(seed, room)
        if room:
            # Used ones go now and then.
            alive = left[unused] > 0
            if 2 * np.count_nonzero(alive) < len(unused):
                unused = unused[alive]
                alive = left[unused] > 0
            score = np.where(alive, index.scores(seed)[unused], -1.0)

            def take_fitting(places: np.ndarray, room: int) -> int:
                for unit in unused[places[np.lexsort((places, -score[places]))]]:
                    if 0 < left[unit] <= room:
                        room = take(unit, room)
                        if not room:
                            break
                return room

            if len(unused) > 2 * RANKED:
                room = take_fitting(np.argpartition(-score, RANKED)[:RANKED], room)
            if room:
                # Lower ones, of which few are as short as the room that is left.
                room = take_fitting(np.flatnonzero((left[unused] > 0) & (left[unused] <= room)), room)
            if room and len(unused):
                score[left[unused] == 0] = -1.0
                best = unused[np.argmax(score)]
                if left[best]:
                    take(best, room)
        sequences.append(pieces)
    return sequences


def power_lengths(pieces: list[tuple], window: int) -> list[list[tuple]]:
    """A sequence cut into sequences whose lengths are powers of two."""
    total = sum(p[2] for p in pieces)
    if total == window:
        return [pieces]
    out, now, room = [], [], 1 << (total.bit_length() - 1)
    for unit, start, length in pieces:
        while length:
            part = min(length, room)
            now.append((unit, start, part))
            start, length, room, total = start + part, length - part, room - part, total - part
            if not room:
                out.append(now)
                now, room = [], 1 << max(total.bit_length() - 1, 0)
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end: int = END,
    shard_units: int = SHARD_UNITS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Null and empty texts are documents of the end id alone. Rows that repeat an id or a text are packed
    each. Ids must be integers and may be null. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    # Ids travel as text: pandas would make floats of a column of integers and nulls.
    docs = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    encoded = materialize(encode_documents(docs, tokenizer, window, end), "encoded")
    idf, mean_length, units, tokens = corpus_statistics(encoded)
    known = spark.sparkContext.broadcast((idf, mean_length))
    cuts: list[tuple[int, int, int]] = []

    def add_keys(cuts: list[tuple[int, int, int]]) -> Column:
        """``key, key2, part`` of a rest and its tie: two minima over its most telling tokens, and the part of their range."""

        @F.pandas_udf("key long, key2 long, part int")
        def keys_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            idf, _ = known.value
            last = np.zeros(len(idf), np.int64)
            tokens = np.arange(len(idf), dtype=np.uint64)
            hashes = [mix(tokens ^ np.uint64((STEP * (j + 1)) & MASK)) for j in range(2)]
            for rests, ties in batches:
                keys = np.zeros((len(rests), 2), np.int64)
                for k, rest in enumerate(rests):
                    if rest:
                        ids = distinct(np.frombuffer(rest, "<u4"), last)
                        if len(ids) > KEY_TOKENS:
                            own = idf[ids]
                            ids = ids[own >= np.partition(own, -KEY_TOKENS)[-KEY_TOKENS]]
                        keys[k] = [h[ids].min().view(np.int64) for h in hashes]
                parts = [bisect_right(cuts, at) for at in zip(keys[:, 0].tolist(), keys[:, 1].tolist(), ties)]
                yield pd.DataFrame({"key": keys[:, 0], "key2": keys[:, 1], "part": np.array(parts, np.int32)})

        return keys_of("rest", "tie")

    parts = max(1, -(-tokens // PARTITION_TOKENS))
    # Even parts of the keys' range from a sample of them; equal keys are told apart by document and content.
    order = ["key", "key2", "tie"]
    tied = encoded.withColumn("tie", F.xxhash64("doc_id", "rest"))
    if parts > 1:
        some = tied.where(F.length("rest") > 0).sample(min(1.0, KEYS_SAMPLED * parts / max(units, 1)), 1)
        found = some.select(add_keys([]).alias("at"), "tie").select("at.key", "at.key2", "tie").orderBy(*order).collect()
        cuts = [tuple(row) for row in found][KEYS_SAMPLED // 2 :: KEYS_SAMPLED][: parts - 1]
    keyed = tied.withColumn("at", add_keys(cuts)).select(*encoded.columns, "at.*", "tie")
    dealt = keyed.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(*order, "doc_id").drop("part", *order)

    @tidy
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf, mean_length = known.value
        # Numbers don't clash between partitions, and a repeated task gives the same.
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        waiting: list[tuple] = []
        held = 0

        def flush():
            nonlocal number, held
            held = 0
            ids = [w[2] for w in waiting]
            for pieces in fill_windows(ids, idf, mean_length, window):
                for sequence in power_lengths(pieces, window):
                    offset = 0
                    for unit, start, length in sequence:
                        doc_id, total, rest = waiting[unit]
                        crc = _crc(rest[start : start + length])
                        rows.append((doc_id, total - len(rest) + start, length, crc, total, number, offset))
                        offset += length
                    number += 1
            waiting.clear()

        def frame() -> pd.DataFrame:
            columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            out = pd.DataFrame(rows, columns=columns)
            rows.clear()
            return out

        for batch in batches:
            for doc_id, total, crcs, rest in zip(
                batch["doc_id"], batch["doc_tokens"], batch["window_crcs"], batch["rest"]
            ):
                for k, crc in enumerate(crcs):
                    rows.append((doc_id, k * window, window, int(crc), total, number, 0))
                    number += 1
                if rest:
                    waiting.append((doc_id, int(total), np.frombuffer(rest, "<u4")))
                    held += len(rest) // 4
                    if len(waiting) >= shard_units or held >= SHARD_TOKENS:
                        flush()
            if rows:
                yield frame()
        if waiting:
            flush()
        if rows:
            yield frame()

    return dealt.mapInPandas(fill, PIECES).withColumn("doc_id", F.col("doc_id").cast("long"))
