"""Seeded shuffle and exact splits."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.sequence import bucketed_positions

RATIO_TOLERANCE = 1e-9
# Hex digits of the shuffle key that are counted per pass: 16**4 groups at most.
_DIGITS = 4
_KEY_LENGTH, _TIED_LENGTH = 32, 64
# Sorts after every hex digit.
_AFTER_ALL_KEYS = "g"
# A group this small is read to the driver to take the exact boundary from it.
_SMALL_GROUP = 1024


def shuffle_key(seed: int, id_field: str = "id", tie: str | None = None) -> Column:
    """The order of the shuffle: a hash of seed and id, the same on every run.

    Rows of equal ids, null ones too, need ``tie``, a column that tells them apart.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_field).cast("string"), F.lit("null"))))
    return key if tie is None else F.concat(key, F.md5(tie))


def shuffle_positions(df: DataFrame, seed: int, *, id_field: str = "id", out: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the seeded permutation."""
    keyed = df.withColumn("_key", shuffle_key(seed, id_field))
    bucket = F.conv(F.substring("_key", 1, _DIGITS), 16, 10)
    return bucketed_positions(keyed, bucket, 16**_DIGITS, ["_key", id_field], out).drop("_key")


def validate_ratios(split_ratio: Mapping[str, float]) -> None:
    if len(split_ratio) < 2:
        raise ValueError("split_ratio must define at least two splits")
    if min(split_ratio.values()) < 0:
        raise ValueError("split_ratio values must be >= 0")
    if abs(sum(split_ratio.values()) - 1.0) > RATIO_TOLERANCE:
        raise ValueError("split_ratio must sum to 1.0")


def split_bounds(total: int, split_ratio: Mapping[str, float]) -> dict[str, tuple[int, int]]:
    """First and last-plus-one position of each split.

    An inner boundary is the cumulative ratio of the total, rounded half to even; the
    last split ends at the total.
    """
    names = list(split_ratio)
    ends, share = [], 0.0
    for name in names[:-1]:
        share += split_ratio[name]
        ends.append(round(total * share))
    ends.append(total)
    return dict(zip(names, zip([0, *ends], ends)))


def split_counts(total: int, split_ratio: Mapping[str, float]) -> dict[str, int]:
    return {name: end - begin for name, (begin, end) in split_bounds(total, split_ratio).items()}


def boundary_keys(
    df: DataFrame, seed: int, ranks: set[int], *, id_field: str = "id", tie: str | None = None
) -> dict[int, str]:
    """The shuffle key of the row at each 1-based rank, found without sorting.

    Keys are counted by their first digits, and only the groups that hold a wanted
    rank are counted again by the next digits, until a group is small enough to read.
    Reads the id column only; the driver sees group counts and small groups.
    """
    keys = df.select(shuffle_key(seed, id_field, tie).alias("key"))
    length = _KEY_LENGTH if tie is None else _TIED_LENGTH
    found: dict[int, str] = {}
    # Per rank still wanted: the digits known so far and the rows in earlier groups.
    open_ranks = {rank: ("", 0) for rank in ranks}
    width = 0
    while open_ranks:
        if width == length:
            raise ValueError(f"column {id_field!r} has repeated values; a split needs unique ids")
        inside = keys
        if width:
            inside = keys.where(F.substring("key", 1, width).isin(*{prefix for prefix, _ in open_ranks.values()}))
        width += _DIGITS
        groups = inside.groupBy(F.substring("key", 1, width).alias("prefix")).count().orderBy("prefix").collect()
        small: dict[str, list[tuple[int, int]]] = {}
        still_open = {}
        for rank, (prefix, before) in open_ranks.items():
            for group in groups:
                if not group["prefix"].startswith(prefix):
                    continue
                if before + group["count"] >= rank:
                    break
                before += group["count"]
            if group["count"] <= _SMALL_GROUP:
                small.setdefault(group["prefix"], []).append((rank, before))
            else:
                still_open[rank] = (group["prefix"], before)
        if small:
            rows = keys.where(F.substring("key", 1, width).isin(*small)).orderBy("key").collect()
            for prefix, wanted in small.items():
                members = [row["key"] for row in rows if row["key"].startswith(prefix)]
                for rank, before in wanted:
                    found[rank] = members[rank - before - 1]
                    if members.count(found[rank]) > 1:
                        raise ValueError(f"column {id_field!r} has repeated values; a split needs unique ids")
        open_ranks = still_open
    return found


def split_ranges(
    df: DataFrame,
    split_ratio: Mapping[str, float],
    seed: int,
    *,
    id_field: str = "id",
    total: int | None = None,
    tie: str | None = None,
) -> dict[str, tuple[str, str]]:
    """Per split that has rows, the key of the last row before it and of its last row.

    Splits are contiguous slices of the seeded permutation. The first split begins
    after the empty string, the last one ends with a string above all keys.
    """
    validate_ratios(split_ratio)
    total = df.count() if total is None else total
    bounds = {name: end for name, (begin, end) in split_bounds(total, split_ratio).items() if begin < end}
    names = list(bounds)
    keys = boundary_keys(df, seed, {bounds[name] for name in names[:-1]}, id_field=id_field, tie=tie)
    ends = [keys[bounds[name]] for name in names[:-1]] + [_AFTER_ALL_KEYS]
    return dict(zip(names, zip(["", *ends], ends)))


def split_dataframe(
    df: DataFrame, split_ratio: Mapping[str, float], seed: int, *, id_field: str = "id"
) -> DataFrame:
    """Add the column ``split``: the name of the split of each row, with exact sizes."""
    key, name = F.col("_key"), F.lit(None).cast("string")
    for split, (_, end) in reversed(split_ranges(df, split_ratio, seed, id_field=id_field).items()):
        name = F.when(key <= end, split).otherwise(name)
    return df.withColumn("_key", shuffle_key(seed, id_field)).withColumn("split", name).drop("_key")


def in_split_order(
    df: DataFrame,
    seed: int,
    ranges: Mapping[str, tuple[str, str]],
    parts: Mapping[str, int],
    *,
    id_field: str = "id",
    tie: str | None = None,
) -> DataFrame:
    """All rows in the order of the permutation, with the number of their split as ``_split``, in one shuffle.

    Each split has its ``parts`` partitions. Keys are uniform, so equal key ranges make equal partitions. A range
    partitioning would read the data a second time to sample what is known here.
    """
    key = F.col("_key")
    leading = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    split, part = F.lit(None).cast("int"), F.lit(None).cast("int")
    base = sum(parts[name] for name in ranges)
    for k, (name, (low, high)) in reversed(list(enumerate(ranges.items()))):
        first = int(low[:8] or "0", 16)
        last = (1 << 32) - 1 if high == _AFTER_ALL_KEYS else int(high[:8], 16)
        base -= parts[name]
        inside = F.floor((leading - first) * parts[name] / (last - first + 1)).cast("int")
        split = F.when(key <= high, F.lit(k)).otherwise(split)
        part = F.when(key <= high, inside + base).otherwise(part)
    keyed = df.withColumn("_key", shuffle_key(seed, id_field, tie)).withColumn("_split", split)
    dealt = keyed.repartitionById(max(sum(parts[name] for name in ranges), 1), part)
    return dealt.sortWithinPartitions("_split", "_key").drop("_key")
