"""Removal of byte strings that repeat anywhere in the corpus, by difference-cover suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it starts at another place, too, in the same or another document.

To sort the suffixes of a corpus in pieces, equal strings must come to the same piece. Each string of 200 bytes
has an anchor, the 80 bytes in it with the least hash; equal strings have equal anchors at equal distances. An
anchor is shared by a run of neighbouring strings, and the bytes of that run are the anchor's context.

1. Anchors that occur once can't belong to a repeated string. Most of the corpus ends here.
2. A context that occurs twice is repeated as a whole; one copy of it goes on.
3. Different contexts of an anchor share some of their strings or none. Contexts are dealt out by anchor, and each
   task sorts the suffixes of its contexts by the difference-cover algorithm: it sorts the triples at places 1 and 2
   modulo 3, names them, recurses on the names, places the remaining suffixes among them, and
   compares neighbours in the order by the first 200 bytes. Neighbours that agree mark repeated strings.

An anchor with more contexts than a task should sort has its strings fingerprinted and counted instead, by Spark.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import broadcast_if_small
from pairloom.llm.hashing import MASK, STEP, mix, tidy
from pairloom.sources.storage import materialize

LENGTH = 200
ANCHOR = 80
# Positions in a piece of a text fit the low bits of a hash; longer texts are taken piece by piece.
PLACE_BITS = 24
PIECE = 1 << 22
# Contexts of one anchor that a task sorts, and bytes that it sorts at a time.
MOST_CONTEXTS = 20_000
SORT_BYTES = 1 << 20
# Partitions of the contexts, by their bytes.
PARTITION_BYTES = 16 << 20
# Bytes of documents that leave a task at a time.
CUT_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15


def _anchors(data: np.ndarray, length: int, anchor: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, first and last start of the strings they belong to, and their hashes."""
    h, size, power = table[data], 1, BASE
    parts, at = None, 0
    while True:  # hashes of ``anchor`` bytes, put together from powers of two
        if anchor & size:
            if parts is None:
                parts, at = h, size
            else:
                n = len(h) - at
                parts, at = parts[:n] * np.uint64(power) + h[at:], at + size
        size *= 2
        if size > anchor:
            break
        half = size // 2
        h = h[:-half] * np.uint64(power) + h[half:]
        power = power * power & MASK
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = mix(parts) & ~low | np.arange(len(parts), dtype=np.uint64)
    # The least key of ``width`` neighbours; equal hashes: the leftmost.
    width, size, least = length - anchor + 1, 1, keys
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    begin = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    end = np.append(begin[1:], len(least)) - 1
    place = (least[begin] & low).astype(np.int64)
    # The least keys crowd near zero: what tells anchors apart is another hash of the same bytes, all 64 bits of it.
    return place, begin, end, mix(parts[place] ^ np.uint64(STEP))


def anchors_of(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of anchor place, first and last string start, and anchor hash, piece by piece of a text.

    At the seams of pieces, a run may be cut in two; its strings have the same anchors all the same.
    """
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    view = np.frombuffer(data, np.uint8)
    for begin in range(0, max(len(data) - length + 1, 0), PIECE):
        place, first, last, hashes = _anchors(view[begin : begin + PIECE + length - 1], length, anchor, table)
        yield place + begin, first + begin, last + begin, hashes


# Sort keys must stay below this.
KEY_LIMIT = 1 << 63


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks from 0, equal keys have equal ones, and the order of the keys."""
    order = np.argsort(keys)
    values = keys[order]
    steps = np.zeros(len(keys), bool)
    np.not_equal(values[1:], values[:-1], out=steps[1:])
    del values
    ranks = np.empty(len(keys), _places(len(keys)))
    ranks[order] = np.cumsum(steps, dtype=ranks.dtype)
    return ranks, order


def _places(n: int) -> type:
    """The narrowest integers for places and ranks in ``n`` symbols: the sort's memory is made of them."""
    return np.int32 if n < (1 << 31) - 8 else np.int64


def _sampled(n: int) -> np.ndarray:
    """Places at 1, then at 2 modulo 3. With a length of 1 modulo 3, the empty suffix ends the first ones."""
    kind = _places(n)
    return np.concatenate([np.arange(1, n + (n % 3 == 1), 3, dtype=kind), np.arange(2, n, 3, dtype=kind)])


def _named(padded: np.ndarray, n: int, top: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Names of the triples at the sampled places, and their order if all of them differ."""
    sampled = _sampled(n)
    keys = padded[sampled].astype(np.int64)
    keys *= top
    keys += padded[sampled + 1]
    # With many different symbols, three of them don't fit a key; two and a rank do.
    if top**3 > KEY_LIMIT:
        keys = _ranks(keys)[0].astype(np.int64)
    keys *= top
    keys += padded[sampled + 2]
    del sampled
    names, order = _ranks(keys)
    distinct = int(names[order[-1]]) + 1 == len(names)
    names += 1
    return names, order if distinct else None


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order, by the difference cover {1, 2} modulo 3. Values are 1 or more.

    Takes up to some 40 bytes of memory a symbol: a level keeps nothing but its symbols while the next one is sorted.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    top = int(s.max()) + 1
    kind = _places(n)
    padded = np.concatenate([s, np.zeros(3, s.dtype)])
    del s
    names, order = _named(padded, n, top)
    if order is None:
        order = suffix_array(names)
    del names
    sampled = _sampled(n)[order]
    del order
    rank = np.zeros(n + 4, kind)
    rank[sampled] = np.arange(1, len(sampled) + 1, dtype=kind)
    sampled = sampled[sampled < n]
    # The remaining suffixes, by their first symbol and the rank of what follows.
    zeros = np.arange(0, n, 3, dtype=kind)
    many = len(rank) + 1
    ranked = None
    if top * top * many > KEY_LIMIT:
        pairs = padded[:-1].astype(np.int64)
        pairs *= top
        pairs += padded[1:]
        ranked = _ranks(pairs)[0]
        del pairs

    def after_one(i: np.ndarray) -> np.ndarray:
        keys = padded[i].astype(np.int64)
        keys *= many
        keys += rank[i + 1]
        return keys

    def after_two(i: np.ndarray) -> np.ndarray:
        if ranked is not None:
            keys = ranked[i].astype(np.int64)
        else:
            keys = padded[i].astype(np.int64)
            keys *= top
            keys += padded[i + 1]
        keys *= many
        keys += rank[i + 2]
        return keys

    zeros = zeros[np.argsort(after_one(zeros), kind="stable")]
    # A place in the merged order is the own order plus what comes before in the other one.
    place = np.empty(n, kind)
    place[zeros] = np.arange(len(zeros), dtype=kind)
    for residue, after in ((1, after_one), (2, after_two)):
        index = np.flatnonzero(sampled % 3 == residue).astype(kind)
        own = sampled[index]
        own_keys, zero_keys = after(own), after(zeros)
        place[zeros] += np.searchsorted(own_keys, zero_keys).astype(kind)
        place[own] = index + np.searchsorted(zero_keys, own_keys).astype(kind)
        del index, own, own_keys, zero_keys
    out = np.empty(n, kind)
    out[place] = np.arange(n, dtype=kind)
    return out


def _symbols(strings: list[bytes]) -> np.ndarray:
    """The strings joined by symbols of 1; bytes are 2 or more."""
    symbols = np.frombuffer(b"\0".join(strings), np.uint8).astype(np.int16)
    symbols += 2
    symbols[np.cumsum([len(s) + 1 for s in strings])[:-1] - 1] = 1
    return symbols


def repeated_starts(strings: list[bytes], length: int = LENGTH) -> np.ndarray:
    """For each byte of the strings joined with one byte between, if its string of ``length`` occurs twice."""
    n = sum(map(len, strings)) + len(strings) - 1
    order = suffix_array(_symbols(strings))
    a, b = order[:-1], order[1:]
    # Strings that reach over the end of theirs aren't strings of the corpus.
    whole = np.zeros(n, bool)
    at = 0
    for s in strings:
        whole[at : at + max(len(s) - length + 1, 0)] = True
        at += len(s) + 1
    same = whole[a] & whole[b]
    a, b = a[same], b[same]
    del order
    # Eight bytes at a time; few pairs are equal for long.
    joined = np.frombuffer(b"\0".join(strings) + b"\0" * (length + 8), np.uint8)
    eight = joined[: n + length - 7].astype(np.uint64)
    for k in range(1, 8):
        eight <<= np.uint64(8)
        eight |= joined[k : n + length - 7 + k]
    for k in [*range(0, length - 7, 8), length - 8]:
        same = eight[a + k] == eight[b + k]
        a, b = a[same], b[same]
    found = np.zeros(n, bool)
    found[a] = found[b] = True
    return found


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _merged(begin: np.ndarray, end: np.ndarray) -> list[list[int]]:
    """Disjoint ranges that cover the same bytes as ``[begin, end)``, which come in order; ranges that touch are one."""
    reach = np.maximum.accumulate(end)
    apart = np.flatnonzero(begin[1:] > reach[:-1])
    return np.column_stack([begin[np.append(0, apart + 1)], reach[np.append(apart, len(end) - 1)]]).tolist()


FOUND = "doc_id string, text_key long, first long, last long"


def _scan(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``(h, context, doc_id, text_key, place, sides)``: the anchors of all documents."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, key, data in zip(batch["doc_id"], batch["text_key"], batch["data"]):
                data = bytes(data)
                for place, first, last, hashes in anchors_of(data, length, anchor):
                    contexts = [
                        xxhash.xxh3_64_intdigest(data[a : b + length]) for a, b in zip(first.tolist(), last.tolist())
                    ]
                    yield pd.DataFrame(
                        {
                            "h": hashes.view(np.int64),
                            "context": np.array(contexts, np.uint64).view(np.int64),
                            "doc_id": doc_id,
                            "text_key": key,
                            "place": place,
                            # How far the run reaches to the left and the right, in one number.
                            "sides": (place - first) << 16 | (last - place + (1 << 15)),
                        }
                    )

    @tidy
    def grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, rows = [], 0
        for frame in scan(batches):
            waiting.append(frame)
            rows += len(frame)
            if rows >= 50_000:
                yield pd.concat(waiting, ignore_index=True)
                waiting, rows = [], 0
        if waiting:
            yield pd.concat(waiting, ignore_index=True)

    schema = "h long, context long, doc_id string, text_key long, place long, sides long"
    return docs.mapInPandas(grouped, schema)


def _contexts(docs: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """``(h, doc_id, text_key, first, alone, data)``: the bytes of the chosen contexts."""
    lists = chosen.groupBy(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text")).agg(
        F.collect_list(F.struct("h", "place", "sides", "alone")).alias("chosen")
    )
    lists = broadcast_if_small(materialize(lists, "chosen"), F.size("chosen") + 1)
    owner = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    # A repeated row brings its contexts twice, hence distinct below.
    rows = docs.join(lists, owner).select("doc_id", "text_key", "data", F.explode("chosen").alias("c"))
    first = F.col("c.place") - F.shiftright("c.sides", 16)
    last = F.col("c.place") + F.col("c.sides").bitwiseAND(F.lit(0xFFFF)) - (1 << 15)
    return rows.select(
        "c.h", "doc_id", "text_key", first.alias("first"), "c.alone",
        F.substring(F.col("data"), (first + 1).cast("int"), (last - first + length).cast("int")).alias("data"),
    )


def _sorted_out(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of repeated strings in the contexts that occur once; contexts come in order of ``h``."""

    @tidy
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple] = []
        # Bytes waiting, and rows and bytes of them before the last anchor.
        size, last, rows, before = 0, None, 0, 0

        def flush(rows: int) -> pd.DataFrame:
            found = repeated_starts([w[4] for w in waiting[:rows]], length)
            out, at = [], 0
            for doc_id, key, first, alone, data in waiting[:rows]:
                if alone:
                    out += [(doc_id, key, first + a, first + b) for a, b in _runs(found[at : at + len(data)])]
                at += len(data) + 1
            del waiting[:rows]
            return pd.DataFrame(out, columns=["doc_id", "text_key", "first", "last"])

        for batch in batches:
            for h, *row, data in zip(*[batch[c] for c in ("h", "doc_id", "text_key", "first", "alone", "data")]):
                if h != last:
                    last, rows, before = h, len(waiting), size
                waiting.append((*row, bytes(data)))
                size += len(data)
                # What the task sorts at a time is larger only if a single anchor is.
                if size > SORT_BYTES and rows:
                    yield flush(rows)
                    size, rows, before = size - before, 0, 0
        if waiting:
            yield flush(len(waiting))

    return contexts.mapInPandas(search, FOUND)


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: every string by its fingerprint."""

    @tidy
    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h, doc_id, key, first, alone, data in batch[["h", "doc_id", "text_key", "first", "alone", "data"]].itertuples(index=False):
                data = bytes(data)
                marks = [xxhash.xxh3_128_digest(data[k : k + length]) for k in range(len(data) - length + 1)]
                at = np.arange(len(marks)) + first
                yield pd.DataFrame({"h": h, "mark": marks, "doc_id": doc_id, "text_key": key, "at": at, "alone": alone})

    marks = contexts.mapInPandas(strings, "h long, mark binary, doc_id string, text_key long, at long, alone boolean")
    marks = materialize(marks, "marks")
    again = marks.groupBy("h", "mark").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hits = marks.where("alone").join(again, ["h", "mark"], "left_semi")
    return hits.select("doc_id", "text_key", F.col("at").alias("first"), F.col("at").alias("last"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """``(of_doc, of_text, spans)``: sorted, disjoint byte ranges ``[begin, end)`` to remove, of ``docs(doc_id, text_key, data)``."""
    anchors = materialize(_scan(docs.where(F.length("data") >= length), length, anchor), "anchors")
    shared = anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    # All rows of an anchor with very many copies still meet in one task of this join; it is stored, so that grouping
    # combines copies before it moves them.
    occurring = materialize(anchors.join(shared, "h", "left_semi"), "occurring")
    place = F.struct("doc_id", "text_key", "place")
    groups = occurring.groupBy("h", "context", "sides").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    groups = materialize(groups, "contexts")

    several = groups.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1")
    chosen = groups.join(several, "h").select(
        "h", "one.*", "sides", (F.col("n") == 1).alias("alone"), (F.col("contexts") > most_contexts).alias("many")
    )
    chosen = materialize(chosen, "several")
    few = _contexts(docs, chosen.where("NOT many"), length).dropDuplicates(["h", "doc_id", "text_key", "first"])
    few = materialize(few, "few")
    total = few.agg(F.sum(F.length("data"))).first()[0] or 0
    dealt = few.repartition(max(1, -(-total // PARTITION_BYTES)), "h").sortWithinPartitions("h", "doc_id", "first")
    runs = _sorted_out(dealt, length)
    if not chosen.where("many").isEmpty():
        many = _contexts(docs, chosen.where("many"), length).dropDuplicates(["h", "doc_id", "text_key", "first"])
        runs = runs.unionByName(_counted(many, length))

    copies = groups.where("n > 1").select("h", "context", "sides")
    whole = occurring.join(copies, ["h", "context", "sides"], "left_semi")
    whole = whole.select(
        "doc_id",
        "text_key",
        (F.col("place") - F.shiftright("sides", 16)).alias("first"),
        (F.col("place") + F.col("sides").bitwiseAND(F.lit(0xFFFF)) - (1 << 15)).alias("last"),
    )
    # First and last start in one number, as places in a text take 31 bits: a worker gets arrays of numbers, not of objects.
    run = F.shiftleft("first", 32).bitwiseOR(F.col("last"))
    both = whole.unionByName(runs).groupBy(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text")).agg(
        F.sort_array(F.collect_list(run)).alias("runs")
    )

    @tidy
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [_merged(runs >> 32, (runs & 0xFFFFFFFF) + length) for runs in batch["runs"]]
            yield pd.DataFrame({"of_doc": batch["of_doc"], "of_text": batch["of_text"], "spans": spans})

    return materialize(both.mapInPandas(merge, "of_doc string, of_text long, spans array<array<long>>"), "spans")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    most_contexts: int = MOST_CONTEXTS,
) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every row: removed byte ranges and the remaining bytes in UTF-8.

    A null text is empty. Rows that repeat an id or a text are documents of their own, so that all of an equal text
    of ``length`` bytes or more goes. Shorter texts are never touched. Ids must be integers and may be null. What is
    left of a character cut in two stays as bytes. Other columns are ignored, whatever their names.
    """
    docs = docs.select(
        F.col(id_col).cast("long").cast("string").alias("doc_id"),
        F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data"),
    ).withColumn("text_key", F.xxhash64("data"))
    spans = repeated_runs(docs, length, anchor, most_contexts)
    spans = broadcast_if_small(spans, F.size("spans") + 1)
    owner = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))

    @tidy
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n_bytes = batch["data"].map(len)
            # What is kept is made and sent a slice of the batch at a time.
            for _, part in batch.groupby(((n_bytes.cumsum() - n_bytes) // CUT_BYTES).to_numpy(), sort=False):
                kept = []
                for data, spans in zip(part["data"], part["spans"]):
                    data, parts, at = bytes(data), [], 0
                    for begin, end in spans if spans is not None else ():
                        parts.append(data[at:begin])
                        at = end
                    kept.append(b"".join(parts) + data[at:])
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"], "n_bytes": n_bytes[part.index], "spans": part["spans"], "kept": kept}
                )

    joined = docs.join(spans, owner, "left").select("doc_id", "data", "spans")
    out = joined.mapInPandas(cut, "doc_id string, n_bytes long, spans array<array<long>>, kept binary")
    return out.select(F.col("doc_id").cast("long"), "n_bytes", F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"), "kept")
