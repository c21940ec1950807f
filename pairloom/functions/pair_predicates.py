"""Pair predicates: two string columns in, a boolean column out. True means flawed."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def bad_length_ratio(first: Column, second: Column, *, min: float, max: float) -> Column:
    """An empty side, or a length ratio outside the closed interval ``[min, max]``."""
    n, m = F.length(first), F.length(second)
    ratio = n / F.greatest(m, F.lit(1))
    return (n == 0) | (m == 0) | (ratio < min) | (ratio > max)


def are_equal(first: Column, second: Column) -> Column:
    return F.lower(first) == F.lower(second)


def hash_fraction(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the key of the row."""
    # The purpose keeps equal seeds from rejecting the first keys of a seeded permutation.
    digest = F.md5(F.concat(F.lit(f"reject:{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def reject_with_probability(
    first: Column, second: Column, *, prob: float, seed: int | None = 0, id_col: str = "id"
) -> Column:
    """Reject a share ``prob`` of the rows.

    The draw is a hash of seed and row id: the same rows are rejected after a retry,
    in another partitioning, and among copies of one text each row draws for itself.
    ``seed=None`` gives an unseeded draw; write its result before using it twice.
    """
    draw = F.rand() if seed is None else hash_fraction(seed, F.col(id_col))
    return draw < prob
