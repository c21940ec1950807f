"""The stages as a stream: new pairs become training rows as they arrive.

Changes, flaws, encoding and projection look at one row at a time, so the batch plan
serves a stream unchanged and keeps no state. Ids, splits and report positions need
the whole table; a stream brings its ids along, and gives no reports.
"""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions.codecs import Codec
from pairloom.plans.preprocess import training_plan


def prepare_stream(pairs: DataFrame, codec: Codec, **options) -> DataFrame:
    """Training rows of a stream of pairs with ids; options as for ``training_plan``."""
    return training_plan(pairs, codec, **options)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available to a parquet dataset, exactly once across restarts."""
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
