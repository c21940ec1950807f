"""Runs of words that repeat with a period four times or more, in each whole text.

Words become numbers, and the documents of a batch one array with a different number behind each. Two suffixes of it are
compared by a difference cover: for any two places, a few words on, both are places of the cover, and
only the suffixes at such places are sorted. The longest common extension is a short comparison up to there, then a
minimum over the common prefixes of neighbours in the sorted order, looked up in a sparse table.

For each period p, the places p apart are compared with their next ones. A run of period p holds several of these pairs in
a row, and all of it follows from the extensions of the first pair to both sides.
"""

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Residues modulo 21 between which every difference modulo 21 occurs.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
TIMES, SHORTEST = 4, 6
# Words looked at together, but for a longer document, which stands alone; pairs of places extended together.
BATCH_WORDS = 200_000
PAIRS = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _shifts() -> np.ndarray:
    """For a difference of two places and the residue of the first, the words up to places of the cover."""
    to_cover = {(d - c) % MODULUS: c for c in COVER for d in COVER}
    begin = np.array([to_cover[diff] for diff in range(MODULUS)])
    return (begin[:, None] - np.arange(MODULUS)[None, :]) % MODULUS


class Extensions:
    """Longest common extensions of places of ``x``, whose values are 1 or more.

    Suffixes at the places of the cover are sorted by their first words, then by doubling: rank pairs of neighbouring
    pieces of a length give those of twice the length, until all differ.
    """

    def __init__(self, x: np.ndarray):
        n, v = len(x), MODULUS
        self.shifts = _shifts()
        self.x = np.concatenate([x, np.zeros(2 * v + 1, x.dtype)])
        places = np.flatnonzero(np.isin(np.arange(n + 1) % v, COVER))
        m = len(places)
        # Index of a place of the cover; all behind the end have the last one, of rank 0.
        self.index = np.full(n + v + 1, m, np.int64)
        self.index[places] = np.arange(m)
        bits = max(int(x.max(initial=1)).bit_length(), 1)
        per_key = max(63 // bits, 1)
        keys = []
        for begin in range(0, v, per_key):
            key = np.zeros(m, np.int64)
            for t in range(begin, min(begin + per_key, v)):
                key = key << bits | self.x[places + t]
            keys.append(key)
        rank = np.zeros(m + 1, np.int64)
        rank[:m] = self._dense(keys)
        levels, step = [rank], v
        while rank.max(initial=0) < m:
            after = rank[self.index[np.minimum(places + step, n + v)]]
            rank = np.zeros(m + 1, np.int64)
            rank[:m] = self._dense([levels[-1][:m], after])
            levels.append(rank)
            step *= 2
        self.rank = rank - 1  # a permutation of the places of the cover
        order = np.empty(m, np.int64)
        order[self.rank[:m]] = np.arange(m)
        self._table(places[order], levels, n)

    @staticmethod
    def _dense(keys: list[np.ndarray]) -> np.ndarray:
        order = np.lexsort(keys[::-1])
        differs = np.zeros(len(order), bool)
        for key in keys:
            differs[1:] |= key[order[1:]] != key[order[:-1]]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(differs) + 1
        return out

    def _table(self, ordered: np.ndarray, levels: list[np.ndarray], n: int) -> None:
        """Common prefixes of neighbours, and their minima over 1, 2, 4, ... of them."""
        p, q = ordered[:-1].copy(), ordered[1:].copy()
        top = n + MODULUS
        for level in range(len(levels) - 1, -1, -1):
            ranks = levels[level]
            first, second = (ranks[self.index[np.minimum(i, top)]] for i in (p, q))
            same = (first == second) & (first > 0)
            p[same] += MODULUS << level
            q[same] += MODULUS << level
        common = p - ordered[:-1] + self._compare(p, q, np.full(len(p), MODULUS), n)
        self.minima = [common]
        width = 1
        while 2 * width <= len(common):
            row = self.minima[-1]
            self.minima.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, n: int) -> np.ndarray:
        """Equal words from two places on, up to ``most``, which is no more than the modulus."""
        equal = np.zeros(len(i), np.int64)
        alive = np.flatnonzero((most > 0) & (np.maximum(i, j) < n))
        for t in range(MODULUS):
            alive = alive[self.x[i[alive] + t] == self.x[j[alive] + t]]
            equal[alive] += 1
            alive = alive[most[alive] > t + 1]
            if not len(alive):
                break
        return equal

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension from each ``i`` and ``j``, which differ; both up to the array's length."""
        n = len(self.x) - 2 * MODULUS - 1
        shift = self.shifts[(j - i) % MODULUS, i % MODULUS]
        out = self._compare(i, j, shift, n)
        on = np.flatnonzero((out == shift) & (np.maximum(i, j) + shift <= n))
        a, b = (self.rank[self.index[k[on] + shift[on]]] for k in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(on), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            found[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        out[on] += found
        return out


def _pairs(x: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(period, places)`` where a run may have its first pair: the next pairs and the next words are equal, too."""
    for p in range(1, longest // TIMES + 1):
        grid = x[::p]
        same = grid[1:] == grid[:-1]
        k = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) if len(same) > 2 else ()
        if len(k):
            i = k * p
            # Three pairs lie before the end, so the words of the test do.
            i = i[(x[i + 1] == x[i + p + 1]) & (x[i + 2] == x[i + p + 2])]
            if len(i):
                yield p, i


def find_runs(x: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``(start, end, period)`` of all runs of at least four periods and six values, by start, then period.

    No run is longer than ``longest``.
    """
    n = len(x)
    forward = backward = None
    found, waiting, size = [], [], 0

    def extend():
        nonlocal forward, backward
        if forward is None:
            forward, backward = Extensions(x), Extensions(x[::-1].copy())
        i = np.concatenate([places for _, places in waiting])
        p = np.repeat([p for p, _ in waiting], [len(places) for _, places in waiting])
        on = forward.common(i, i + p)
        far = on > 2 * p
        i, p, on = i[far], p[far], on[far]
        back = backward.common(n - i, n - i - p)
        length = p + on + back
        # Less than a period back: the run's first pair.
        good = (back < p) & (length >= np.maximum(TIMES * p, SHORTEST))
        found.append(np.stack([i - back, i + p + on, p], axis=1)[good])
        waiting.clear()

    for pair in _pairs(x, longest):
        # One period of a long text may have many pairs.
        for begin in range(0, len(pair[1]), PAIRS):
            part = pair[1][begin : begin + PAIRS]
            waiting.append((pair[0], part))
            size += len(part)
            if size >= PAIRS:
                extend()
                size = 0
    if waiting:
        extend()
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    # A multiple of the period gives the same stretch.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _joined(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents behind each other, with another value after each, and where they begin."""
    lengths = np.array([len(d) for d in documents])
    starts = np.cumsum(lengths + 1) - lengths - 1
    top = max((int(d.max(initial=0)) for d in documents), default=0)
    out = np.empty(int(lengths.sum()) + len(documents), np.int64)
    out[starts + lengths] = top + 1 + np.arange(len(documents))
    for start, d in zip(starts, documents):
        out[start : start + len(d)] = d
    return out, starts


def runs_of_documents(documents: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each document, whose values are 1 or more, as rows ``(start, end, period)``."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(documents)
    if not documents:
        return out
    x, starts = _joined(documents)
    lengths = np.array([len(d) for d in documents])
    # Only documents that have any pair of equal places in a row are sorted.
    promising = np.zeros(len(documents), bool)
    for _, places in _pairs(x, int(lengths.max())):
        promising[np.searchsorted(starts, places, "right") - 1] = True
    chosen = np.flatnonzero(promising)
    if not len(chosen):
        return out
    x, starts = _joined([documents[k] for k in chosen])
    runs = find_runs(x, int(lengths[chosen].max()))
    owner = np.searchsorted(starts, runs[:, 0], "right") - 1
    borders = np.searchsorted(owner, np.arange(len(chosen) + 1))
    for k, document in enumerate(chosen):
        own = runs[borders[k] : borders[k + 1]].copy()
        own[:, :2] -= starts[k]
        out[document] = own
    return out


def _groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of texts, some texts at a time. Words are what stands between the six white space characters of ASCII."""
    group, size = [], 0
    for text in texts:
        words = (text.as_py() or b"").split()
        if group and size + len(words) > BATCH_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row: its runs ``(start, length, period)`` by start, then period, and
    the words joined by one space, of each run the first period only.

    A run is a stretch of words that repeats with its smallest period four times at least, is six words or longer, and
    can't be extended. Words stand between spaces, tabs and line ends, numbered from 0. Null and empty texts have no
    words, no runs and an empty text. Rows that repeat are looked at each; other columns are ignored, whatever their
    names. A task needs memory for its longest text, about a hundred times its words' number in bytes.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, begin = batch.column(0), 0
            for group in _groups(batch.column(1)):
                numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__)
                arrays = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in group]
                runs, texts = runs_of_documents(arrays), []
                for words, own in zip(group, runs):
                    if len(own):
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, own[:, 0] + own[:, 2], 1)
                        np.add.at(change, own[:, 1], -1)
                        words = compress(words, (np.cumsum(change)[:-1] == 0).tolist())
                    texts.append(b" ".join(words))
                rows = [[{"start": s, "length": e - s, "period": p} for s, e, p in own.tolist()] for own in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(begin, len(group)),
                        pa.array([len(a) for a in arrays], pa.int64()),
                        pa.array(rows, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                        pa.array(texts, pa.binary()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
                begin += len(group)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    out = narrow.mapInArrow(look, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
