"""Rows by their place in the files of a source: positions, first rows and slices, without sorting or storing any.

Parquet knows the index of a row in its file. Formats of lines know the block of the file that a task reads, and the
lines of a block get ascending numbers; counts per block give the rest. Both come down to running totals over a small
table, one row per file or per block, that is joined by broadcast.
"""

import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of the small table that are broadcast at a time (about 200 bytes each); more blocks of lines are joined by shuffling.
BROADCAST_FILES = 100_000
BROADCAST_BLOCKS = 1_000_000
# Wanted files that are named one by one; of more, those between the first and the last path are read.
FILES_NAMED = 1_000

ENTRY, FILE, BLOCK, LENGTH, LINE = "__entry", "__file", "__block", "__length", "__line"
MOVED = (
    "the source is cut into other blocks than when its rows were counted; leave the settings of file reading as they were, "
    "and set spark.sql.files.minPartitionNum where the number of cores changes"
)

_SLICE = re.compile(r"\s*([^\[\]+]+?)\s*(?:\[\s*(-?\d+%?)?\s*:\s*(-?\d+%?)?\s*\])?\s*")


class Slice(NamedTuple):
    """A split and the rows of it, as numbers or per cent, each of which may be negative or missing."""

    name: str
    begin: str | None
    end: str | None

    def rows(self, total: int) -> tuple[int, int]:
        """First and last-plus-one row. Numbers beyond the rows mean their end; per cent are rounded half to even."""

        def place(text: str | None, default: int) -> int:
            if text is None:
                return default
            value = int(text.rstrip("%"))
            if text.endswith("%"):
                if abs(value) > 100:
                    raise ValueError(f"{text} in a slice of {self.name!r} is beyond 100%")
                value = (value < 0) * total + round(total * value / 100)
            elif value < 0:
                value += total
            return min(max(value, 0), total)

        return place(self.begin, 0), place(self.end, total)

    def most(self) -> int | None:
        """How many rows from the beginning on are enough; None if all must be counted."""
        known = [text for text in (self.begin, self.end) if text is not None]
        if self.end is None or any("%" in text or text.startswith("-") for text in known):
            return None
        return int(self.end)


def parse_split(split: str) -> list[Slice]:
    """``name``, ``name[from:to]``, or several of these joined by ``+``."""
    found = [_SLICE.fullmatch(part) for part in split.split("+")]
    if not all(found):
        raise ValueError(f"no split expression: {split!r}")
    return [Slice(*match.groups()) for match in found]


def natural(path: str) -> list:
    """Sorts paths with the numbers in them as numbers."""
    return [int(part) if k % 2 else part for k, part in enumerate(re.split(r"(\d+)", path))]


class Part(NamedTuple):
    """A file, or a block of one, with its rows and the number of its first line in the scan."""

    entry: int
    file: str
    block: int
    length: int
    rows: int
    line: int


class Source:
    """Paths of one format. Entries are ``(split, path)``; the order is theirs, then that of the files."""

    def __init__(self, spark: SparkSession, file_format: str, entries: Sequence[tuple[str, str]], schema: T.StructType | str | None):
        self.spark, self.format, self.entries, self.schema = spark, file_format, entries, schema
        self.indexed = file_format == "parquet"
        self.keys = [ENTRY, FILE] if self.indexed else [ENTRY, FILE, BLOCK, LENGTH]
        self.frames = [self._read(entry) for entry in range(len(self.entries))]
        self.columns = self.frames[0].columns

    def _read(self, entry: int) -> DataFrame:
        reader = self.spark.read.format(self.format)
        if self.format == "json":
            reader = reader.option("mode", "FAILFAST")
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.entries[entry][1])

    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.frames)

    def _scan(self, files: list[tuple[int, str]] | None) -> DataFrame:
        """All rows with their place. With ``files``, others may be left out; the condition stands below the numbering of
        lines, so that the scan itself leaves them out."""
        wanted: dict[int, list[str]] = defaultdict(list)
        for entry, file in files or ():
            wanted[entry].append(file)
        frames = []
        for entry, frame in enumerate(self.frames):
            path = F.col("_metadata.file_path")
            if files is not None:
                if not wanted[entry]:
                    continue
                named = sorted(set(wanted[entry]))
                frame = frame.where(path.isin(named) if len(named) <= FILES_NAMED else path.between(named[0], named[-1]))
            place = [F.lit(entry).alias(ENTRY), path.alias(FILE)]
            if self.indexed:
                place.append(F.col("_metadata.row_index").alias(LINE))
            else:
                place += [F.col("_metadata.file_block_start").alias(BLOCK), F.col("_metadata.file_block_length").alias(LENGTH)]
                place.append(F.monotonically_increasing_id().alias(LINE))
            frames.append(frame.select("*", *place))
        return reduce(DataFrame.unionByName, frames) if frames else self._scan(None).limit(0)

    def files(self) -> list[tuple[int, str]]:
        """All files in order."""
        listed = []
        for entry, frame in enumerate(self.frames):
            # Local paths have three slashes here and one in the scan.
            paths = sorted((re.sub(r"^(\w+):///", r"\1:/", path) for path in frame.inputFiles()), key=natural)
            seen = frame.select("_metadata.file_path").first()
            if seen is not None and seen["file_path"] not in set(paths):
                raise RuntimeError(f"the files of {self.entries[entry][1]} are listed by other names than {seen['file_path']}")
            listed += [(entry, path) for path in paths]
        return listed

    def _counted(self, files: list[tuple[int, str]] | None) -> list[Part]:
        """Parts of the scan that have rows, in order. Counting reads the footers of parquet files, and the lines of others."""
        rows = self._scan(files)
        found = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows"), F.min(LINE).alias("line")).collect()
        parts = [Part(r[ENTRY], r[FILE], *((0, 0) if self.indexed else (r[BLOCK], r[LENGTH])), r["rows"], r["line"]) for r in found]
        return sorted(parts, key=lambda p: (p.entry, natural(p.file), p.block))

    def _enough(self, needed: dict[str, int | None]) -> tuple[list[Part], list[tuple[int, str]] | None]:
        """Counts up to the rows that are needed of each split, and the files that were counted; None for all."""
        if all(n is None for n in needed.values()):
            return self._counted(None), None
        parts: list[Part] = []
        left, seen = dict(needed), []
        files = self.files()
        todo = {name: [f for f in files if self.entries[f[0]][0] == name] for name in needed}
        step = 1
        while any(todo.values()):
            batch = []
            for name in needed:
                take = len(todo[name]) if left[name] is None else step if left[name] > 0 else 0
                batch += todo[name][:take]
                todo[name] = todo[name][take:] if take else []
            found = [p for p in self._counted(batch) if (p.entry, p.file) in set(batch)] if batch else []
            for part in found:
                name = self.entries[part.entry][0]
                if left[name] is not None:
                    left[name] -= part.rows
            parts, seen, step = parts + found, seen + batch, 4 * step
        return sorted(parts, key=lambda p: (p.entry, natural(p.file), p.block)), seen

    def numbered(self, slices: Sequence[Slice], out: str, *, start: int = 0, limit: int | None = None) -> DataFrame:
        """The rows of the slices, one after the other, with dense numbers from ``start``; ``limit`` keeps the first ones.

        Rows of overlapping slices come once for each.
        """
        needed: dict[str, int | None] = {}
        for part in slices:
            most = part.most()
            if most is None and limit is not None and part.begin is None and part.end is None:
                most = limit
            if part.name in needed:
                known = needed[part.name]
                most = None if most is None or known is None else max(most, known)
            needed[part.name] = most
        parts, counted = self._enough(needed)
        totals: dict[str, int] = defaultdict(int)
        for part in parts:
            totals[self.entries[part.entry][0]] += part.rows
        left = sum(totals.values()) * len(slices) if limit is None else limit
        # Rows of a split from ``begin`` on get the numbers from ``first`` on.
        wanted: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        first = start
        for part in slices:
            begin, end = part.rows(totals[part.name])
            end = min(end, begin + left)
            if begin < end:
                wanted[part.name].append((begin, end, first))
                first, left = first + end - begin, left - (end - begin)
        pieces = self._pieces(parts, wanted)
        files = sorted({(p.entry, p.file) for p, *_ in pieces}, key=lambda f: (f[0], natural(f[1])))
        everything = counted is None and len(files) == len({(p.entry, p.file) for p in parts})
        if self.indexed:
            return self._placed_rows(pieces, None if everything else files, out)
        read = parts
        if not everything:
            # Other files make other numbers of lines: what is read is counted, behind the rows of the files before.
            read = self._counted(files) if files else []
            new, merged = defaultdict(list), []
            for part in read:
                new[part.entry, part.file].append(part)
            for part in parts:
                merged += new.pop((part.entry, part.file), []) if (part.entry, part.file) in files else [part]
            pieces = self._pieces(merged, wanted)
        return self._placed_lines(pieces, read, None if everything else files, out)

    def lines(self, file: str = "file", line: str = "line") -> DataFrame:
        """The rows of a format of lines with their file and their number in it, from 1."""
        parts = self._counted(None)
        begun: dict[tuple[int, str], int] = defaultdict(lambda: 1)
        pieces = []
        for part in parts:
            pieces.append((part, 0, part.rows, begun[part.entry, part.file]))
            begun[part.entry, part.file] += part.rows
        return self._placed_lines(pieces, parts, None, line, F.col(FILE).alias(file))

    def _pieces(self, parts: list[Part], wanted: dict) -> list[tuple[Part, int, int, int]]:
        """``(part, low, high, number)``: rows of a part from low to high get numbers from ``number`` on."""
        begun: dict[str, int] = defaultdict(int)
        pieces = []
        for part in parts:
            name = self.entries[part.entry][0]
            before = begun[name]
            begun[name] += part.rows
            for begin, end, first in wanted[name]:
                low, high = max(begin - before, 0), min(end - before, part.rows)
                if low < high:
                    pieces.append((part, low, high, first + before + low - begin))
        return pieces

    def _placed_rows(self, pieces: list[tuple[Part, int, int, int]], files: list[tuple[int, str]] | None, out: str) -> DataFrame:
        frames = []
        pieces = sorted(pieces, key=lambda p: (p[0].entry, p[0].file))
        for at in range(0, max(len(pieces), 1), BROADCAST_FILES):
            batch = pieces[at : at + BROADCAST_FILES]
            only = files if len(batch) == len(pieces) else [(p.entry, p.file) for p, *_ in batch]
            table = [(p.entry, p.file, low, high, number) for p, low, high, number in batch]
            small = self.spark.createDataFrame(table, f"{ENTRY} int, {FILE} string, __low long, __high long, __number long")
            frames.append(self._cut(self._scan(only).join(F.broadcast(small), self.keys), F.col(LINE), out))
        return reduce(DataFrame.unionByName, frames)

    def _placed_lines(
        self, pieces: list[tuple[Part, int, int, int]], read: list[Part], files: list[tuple[int, str]] | None, out: str, *more: Column
    ) -> DataFrame:
        table = [(*part, low, high, number) for part, low, high, number in pieces]
        # All blocks that are read, so that one which wasn't counted is noticed.
        known = {row[:4] for row in table}
        table += [(*part, 0, 0, 0) for part in read if part[:4] not in known]
        schema = f"{ENTRY} int, {FILE} string, {BLOCK} long, {LENGTH} long, __rows long, __first long, __low long, __high long, __number long"
        small = self.spark.createDataFrame(table, schema)
        joined = self._scan(files).join(F.broadcast(small) if len(table) <= BROADCAST_BLOCKS else small, self.keys, "left")
        index = F.col(LINE) - F.col("__first")
        moved = F.col("__rows").isNull() | (index < 0) | (index >= F.col("__rows"))
        return self._cut(joined, F.when(moved, F.raise_error(F.lit(MOVED)).cast("long")).otherwise(index), out, *more)

    def _cut(self, joined: DataFrame, index: Column, out: str, *more: Column) -> DataFrame:
        # Null bounds are compared, too: else the join would drop rows of unknown blocks before they are noticed.
        low, high = (F.coalesce(F.col(c), F.lit(0)) for c in ("__low", "__high"))
        inside = joined.where((index >= low) & (index < high))
        source = [F.col(c) for c in self.columns if c != out]
        return inside.select(*source, *more, (F.col("__number") + index - F.col("__low")).alias(out))
