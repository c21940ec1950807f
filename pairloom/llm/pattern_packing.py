"""Packing documents whole into few sequences, by patterns of lengths that fill a sequence exactly.

The lengths of all pieces are a histogram with as many bars as a sequence has tokens, which is all that the driver sees.
Patterns are two or three lengths that add up to a full sequence. Non-negative least squares finds how often to use each
so that the histogram is met, the counts are rounded, and what no pattern takes is packed by best fit, longest first.
Both steps give kinds of sequences with a number of repeats; the pieces of a length are numbered, and a piece's number
says which sequence it is in and where.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.tokens import worker_encoder
from pairloom.sources.storage import materialize

WINDOW = 1024
END = 2
# Pieces of a length that are numbered in one task, about.
SHARD_PIECES = 100_000
# Steps of the fit; what it leaves is packed all the same.
STEPS = 40
GAIN = 1e-3
# Shares of the fitted counts that are tried.
SHARES = (1.0, 0.9, 0.65, 0.5, 0.25)


def encode_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)`` of ``docs(doc_id, text)``, ids in four bytes each.

    ``tokenizer`` is the content of a tokenizer file. A null text is empty and has the end id only. The first piece takes what
    whole windows leave.
    """
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)
    names = ["piece", "start", "length", "ids_crc32"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(content.value)
        last = np.array([end], np.uint32)
        for batch in batches:
            owners, numbers, data = [], [], []
            texts = (t.as_py() or "" for t in batch.column(1))
            for k, ids in enumerate(encoder.encode(texts)):
                ids = np.concatenate([ids, last]).astype("<u4")
                first = (len(ids) - 1) % window + 1
                for piece, stop in enumerate(range(first, len(ids) + 1, window)):
                    start = max(stop - window, 0)
                    own = ids[start:stop].tobytes()
                    owners.append(k)
                    numbers.append((piece, start, stop - start, zlib.crc32(own)))
                    data.append(own)
            columns = zip(*numbers) if numbers else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owners, pa.int64())),
                    *[pa.array(c, t) for c, t in zip(columns, [pa.int32()] + [pa.int64()] * 3)],
                    pa.array(data, pa.binary()),
                ],
                ["doc_id", *names, "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def length_patterns(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths, falling, that add up to the window; the third may be 0. Only the given lengths, rising, occur."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    present[window] = present[0] = False
    lengths = np.flatnonzero(present)
    twos = lengths[(2 * lengths >= window) & present[window - lengths]]
    out = [np.stack([twos, window - twos, 0 * twos], axis=1)]
    for third in lengths[3 * lengths <= window]:
        second = lengths[(lengths >= third) & (2 * lengths <= window - third)]
        first = window - third - second
        ok = present[first]
        out.append(np.stack([first[ok], second[ok], np.full(ok.sum(), third)], axis=1))
    return np.concatenate(out).astype(np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: how often to use each pattern so that lengths come out as in the histogram.

    The active-set method, with several patterns entering at a time, none of which share a length. A length counts as
    much as its tokens: short pieces are easily packed later.
    """
    size = len(histogram)
    weight = np.arange(size, dtype=float)
    weight /= weight.max(initial=1)
    x = np.zeros(len(patterns))
    wanted = histogram * weight
    active = np.zeros(0, np.int64)

    def used(counts, rows):
        total = np.bincount(patterns[rows].ravel(), np.repeat(counts, 3), minlength=size)
        total[0] = 0
        return total * weight

    error = np.linalg.norm(wanted)
    for _ in range(steps):
        rest = wanted - used(x[active], active)
        now = np.linalg.norm(rest)
        if _ and now > (1 - GAIN) * error:
            break
        error = now
        pull = (rest * weight)[patterns].sum(axis=1)
        pull[active] = 0
        enter, taken = [], np.zeros(size, bool)
        best = np.argsort(-pull, kind="stable")
        for j in best[: 20 * size]:
            if pull[j] <= 1e-9 * max(error, 1):
                break
            if not taken[patterns[j]].any():
                taken[patterns[j]] = True
                taken[0] = False
                enter.append(j)
        if not enter:
            break
        active = np.concatenate([active, enter]).astype(np.int64)
        while len(active):
            matrix = np.zeros((size, len(active)))
            np.add.at(matrix, (patterns[active].ravel(), np.repeat(np.arange(len(active)), 3)), 1)
            matrix[0] = 0
            matrix *= weight[:, None]
            gram = matrix.T @ matrix
            gram[np.diag_indices(len(active))] += 1e-9 * max(np.trace(gram), 1e-9)
            solved = np.linalg.solve(gram, matrix.T @ wanted)
            stays = solved > 0
            if stays.all():
                break
            # All that would be negative leave at once, and may enter again.
            active = active[stays]
        x[:] = 0
        x[active] = solved[: len(active)] if len(active) else 0
    return x


def best_fit(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of pieces by length: ``(lengths, repeats)`` of equal sequences.

    Equal sequences are filled together, so the work depends on the window, not on the number of pieces.
    """
    by_room: dict[int, list[list]] = {}
    for length in range(window, 0, -1):
        left = int(histogram[length])
        while left:
            room = min((r for r in by_room if r >= length and by_room[r]), default=None)
            if room is None:
                each = window // length
                kinds, taken = [[(), left // each], [(), 1]], [each, left % each]
                left, room = 0, window
            else:
                lengths, many = by_room[room].pop()
                each = room // length
                whole = min(many, left // each)
                part = left - whole * each if whole < many and left - whole * each < each else 0
                kinds, taken = [[lengths, whole], [lengths, 1 if part else 0]], [each, part]
                left -= whole * each + part
                unused = many - whole - bool(part)
                if unused:
                    by_room.setdefault(room, []).append([lengths, unused])
            for (lengths, many), n in zip(kinds, taken):
                if many and n:
                    by_room.setdefault(room - n * length, []).append([lengths + (length,) * n, many])
    return [(lengths, many) for kinds in by_room.values() for lengths, many in kinds]


def _rounded(patterns: np.ndarray, counts: np.ndarray, left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns used as often as rounded, while there are pieces, and the rest by best fit."""
    left, kinds = left.copy(), []
    for j in np.argsort(-counts, kind="stable"):
        if counts[j] < 0.5:
            break
        lengths, times = np.unique(patterns[j][patterns[j] > 0], return_counts=True)
        many = int(min(np.rint(counts[j]), (left[lengths] // times).min()))
        if many:
            left[lengths] -= many * times
            kinds.append((tuple(int(v) for v in patterns[j] if v), many))
    return kinds + best_fit(left, window)


def plan_sequences(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences ``(lengths, repeats)`` that hold all pieces of a histogram by length.

    The fit doesn't know what best fit makes of the rest, so several shares of the counts are tried; the fewest sequences win.
    """
    left = np.asarray(histogram, np.int64).copy()
    kinds = [((window,), int(left[window]))] if left[window] else []
    left[window] = 0
    patterns = length_patterns(np.flatnonzero(left), window)
    if not len(patterns):
        return kinds + best_fit(left, window)
    counts = fit_counts(patterns, left.astype(float))
    tried = [_rounded(patterns, share * counts, left, window) for share in SHARES]
    return kinds + min(tried, key=lambda plan: sum(many for _, many in plan))


def slots(kinds: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Numbers of the pieces of a length by kind of sequence: ``length, first, sequence, offset``.

    Pieces from ``first`` on, up to the next row of the length, are in the sequences from ``sequence`` on.
    """
    rows, begun, sequence = [], {}, 0
    for lengths, many in kinds:
        offset = 0
        for length in lengths:
            first = begun.get(length, 0)
            rows.append((length, first, sequence, offset))
            begun[length] = first + many
            offset += length
        sequence += many
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"]).sort_values(["length", "first"])


def numbered_by_length(pieces: DataFrame, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with their ``number`` among those of their length, from 0, for a stored table with a unique ``place``.

    A length that many have is numbered in several tasks: within a shard of places, after the pieces of earlier shards.
    """
    total = pieces.count()
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(max(1, -(-total // shard_pieces)))))
    counts = sharded.groupBy("length", "shard").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "shard").orderBy("place"))
    joined = sharded.join(before.hint("merge"), ["length", "shard"])
    return joined.withColumn("number", F.col("before") + inside - 1).drop("shard", "before")


def pack_patterns(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``.

    Documents end with the id ``end``; null and empty ones are that id alone. Longer ones than a window are cut into
    windows, the first of which may be shorter. Rows that repeat an id or a text are packed each, ids may be null, and
    other columns are ignored, whatever their names. Sequences have no order and no padding between pieces. An empty table gives no row.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encoded = encode_pieces(narrow, tokenizer, window, end)
    pieces = materialize(encoded.withColumn("place", F.monotonically_increasing_id()), "pieces")
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # one row for each length, a window's at most
        histogram[row["length"]] = row["count"]
    table = slots(plan_sequences(histogram, window))
    # Lengths and numbers as one key; a length has under 2**48 pieces.
    keys = (table["length"].to_numpy(np.int64) << 48) + table["first"].to_numpy(np.int64)
    first, sequence, offset = (table[c].to_numpy(np.int64) for c in ("first", "sequence", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        number = number.to_numpy(np.int64)
        at = np.searchsorted(keys, (length.to_numpy(np.int64) << 48) + number, "right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + number - first[at], "offset": offset[at]})

    numbered = numbered_by_length(pieces).withColumn("at", place("length", "number"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "at.sequence_id", "at.offset")
