"""The first rows in an order, for any number of them, without sorting the rest."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that are read to the driver to take the last wanted one from; keys sampled and tried as borders in a pass.
KEYS_READ = 10_000
KEYS_SAMPLED = 1_000
BORDERS = 32

_PRINTED_ORDER = re.compile(r"Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>", re.DOTALL)


def order_keys(df: DataFrame, order_by: Sequence) -> list[tuple[Column, bool, bool]]:
    """``(column, descending, nulls last)`` of names, columns and sort orders such as ``F.desc("x")``."""
    keys = []
    for item in order_by:
        if isinstance(item, str):
            keys.append((F.col(item), False, False))
            continue
        # A sort order can't be taken apart by public names other than its printed form.
        found = _PRINTED_ORDER.fullmatch(str(item))
        if found is None:
            keys.append((item, False, False))
        else:
            name = found[1]
            keys.append((F.col(f"`{name}`") if name in df.columns else F.expr(name), found[2] == "DESC", found[3] == "LAST"))
    return keys


def _sorted(column: Column, descending: bool, nulls_last: bool) -> Column:
    if descending:
        return column.desc_nulls_last() if nulls_last else column.desc_nulls_first()
    return column.asc_nulls_last() if nulls_last else column.asc_nulls_first()


def up_to(keys: Sequence[tuple[Column, bool, bool]], border: Sequence) -> Column:
    """Whether a row's key is the border or comes before it."""
    result = F.lit(True)
    for (column, descending, nulls_last), value in reversed(list(zip(keys, border))):
        if value is None:
            before = column.isNotNull() if nulls_last else F.lit(False)
            equal = column.isNull()
        else:
            before = (column > F.lit(value)) if descending else (column < F.lit(value))
            before = F.coalesce(before, F.lit(not nulls_last))
            equal = column.eqNullSafe(F.lit(value))
        result = before | (equal & result)
    return result


def first_in_order(df: DataFrame, order_by: Sequence, n: int, *, keys_read: int = KEYS_READ) -> DataFrame:
    """The ``n`` first rows in the order of ``order_by``, whose values must be unique together: ``df`` behind a comparison.

    Only the order columns are read for it, a few times: some keys of a range divide it, the rows up to each are
    counted, and the range that holds the wanted rank is divided again, until its keys can be read.
    """
    if n <= 0:
        return df.limit(0)
    own = order_keys(df, order_by)
    names = [f"k{i}" for i in range(len(own))]
    narrow = df.select(*[key[0].alias(name) for key, name in zip(own, names)])
    keys = [(F.col(name), *key[1:]) for key, name in zip(own, names)]
    order = [_sorted(*key) for key in keys]
    inside = narrow.count()
    if inside <= n:
        return df
    # Rows before the range, and the keys around it.
    before, lower, upper = 0, None, None
    seed = 0
    while True:
        part = narrow
        if upper is not None:
            part = part.where(up_to(keys, upper))
        if lower is not None:
            part = part.where(~up_to(keys, lower))
        if inside <= keys_read:
            break
        seed += 1
        sampled = part.sample(min(1.0, KEYS_SAMPLED / inside), seed).orderBy(*order).collect()
        borders = list(dict.fromkeys(tuple(row) for row in sampled[:: max(1, len(sampled) // BORDERS)]))
        if not borders:
            continue
        counts = part.agg(*[F.count_if(up_to(keys, border)) for border in borders]).first()
        was = inside
        # The range ends at the first border that the wanted row doesn't come after.
        at = next((k for k, count in enumerate(counts) if before + count >= n), len(borders))
        if at < len(borders):
            upper, inside = borders[at], counts[at]
        if at:
            lower, before, inside = borders[at - 1], before + counts[at - 1], inside - counts[at - 1]
        if inside == was and len(borders) == 1 and upper == borders[0]:
            raise ValueError("the order columns have one key for many rows; they must be unique together")
    last = part.orderBy(*order).limit(n - before).collect()[-1]
    return df.where(up_to(own, tuple(last)))
