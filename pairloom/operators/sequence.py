"""Dense positions: 0, 1, 2, ... in a given order, without a global sort in one task."""

import json
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.first_rows import order_keys
from pairloom.sources.storage import materialize

# Positions inside one partition take the low 33 bits of the generated id.
_ROW_BITS = 33


def dense_sequence(
    df: DataFrame,
    order_by: Sequence,
    out: str,
    *,
    start: int = 0,
    keep: Sequence[str] | None = None,
    unique: bool = False,
    compression: str | None = None,
) -> DataFrame:
    """Number the rows in the order of ``order_by``; rows of equal values must be interchangeable.

    The rows are range-partitioned and sorted on all order columns, so a frequent value
    of the first column is still split, and the columns in ``keep`` are written to the
    shared folder with partition number and position inside the partition. What reaches
    the driver is one row count per partition; their running totals go back as a
    literal array. With ``unique``, equal values are an error: they lie next to each other in one
    partition, so hashes of neighbours are compared. ``compression`` of the stored rows is the session's if not given.
    """
    columns = [F.col(name) for name in keep or df.columns]
    place = F.monotonically_increasing_id().alias("_place")
    # Hashes pass over nulls, so these have a value of their own.
    keys = [part for key, _, _ in order_keys(df, order_by) for part in (key, key.isNull())]
    key = [F.xxhash64(*keys).alias("_key")] if unique else []
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    stored = materialize(ordered.select(*columns, place, *key), "sequence", compression)
    partition = F.shiftright("_place", _ROW_BITS).cast("int")
    if unique:
        neighbours = Window.partitionBy(partition).orderBy("_place")
        repeated = stored.select("_key", F.lag("_key").over(neighbours).alias("_before")).where("_key = _before")
        if not repeated.isEmpty():
            raise ValueError("the order columns have repeated values; they must be unique together")
    counted = stored.groupBy(partition.alias("partition")).agg(F.count(F.lit(1)).alias("rows")).collect()
    sizes = {row["partition"]: row["rows"] for row in counted}
    offsets = running_totals([sizes.get(number, 0) for number in range(max(sizes, default=0) + 1)], start)
    position = F.element_at(offsets, partition + 1) + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored.select(*columns, position.alias(out))


def running_totals(counts: Sequence[int], start: int = 0) -> Column:
    """The rows before each group, as a literal array."""
    totals = list(accumulate(counts, initial=start))[: max(len(counts), 1)]
    # One text instead of a literal for each number; Spark folds it to an array.
    return F.from_json(F.lit(json.dumps(totals)), "array<bigint>")


def bucketed_positions(
    df: DataFrame, bucket: Column, buckets: int, order_by: Sequence, out: str, *, start: int = 0
) -> DataFrame:
    """Number the rows in the order of ``(bucket, *order_by)``; nothing is stored.

    ``bucket`` is a number below ``buckets`` that keeps the order and cuts the rows into even groups. Rows before a
    bucket come from the bucket counts, which pass the driver, positions inside it from a window over the bucket.
    """
    rows = df.withColumn("_bucket", bucket.cast("int"))
    counted = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows")).collect()
    sizes = {row["_bucket"]: row["rows"] for row in counted}
    offsets = running_totals([sizes.get(number, 0) for number in range(buckets)], start)
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    return rows.withColumn(out, F.element_at(offsets, F.col("_bucket") + 1) + inside - 1).drop("_bucket")
