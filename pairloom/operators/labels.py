"""Arrays of the labels whose conditions hold."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separates labels while they are joined; labels are printable, so none contains it.
_SEPARATOR = "\x1f"


def with_labels(df: DataFrame, conditions: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """Add, per column name, the array of the labels of the true conditions, in order.

    Joining the labels and splitting the string stays inside generated code, where
    removing nulls from an array would call an interpreted lambda. The string has a
    projection of its own, so the conditions are evaluated once.
    """
    joined = {
        name: F.concat_ws(_SEPARATOR, *(F.when(condition, F.lit(label)) for label, condition in pairs))
        for name, pairs in conditions.items()
    }
    none = F.array().cast("array<string>")
    arrays = {name: F.when(F.col(name) == "", none).otherwise(F.split(name, _SEPARATOR)) for name in conditions}
    return df.withColumns(joined).withColumns(arrays)
