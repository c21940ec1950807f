"""What several operators share: word splitting, word shingles and columns that are computed once."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Java and RE2 both read this as "anything but letters and digits".
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is evaluated once per row.

    Spark merges neighbouring projections, and would evaluate the column again at each use in a
    lambda. It doesn't merge through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _windows(tokens: Column, size: int) -> Column:
    """The first word of each shingle."""
    return F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (size - 1), F.lit(0)))


def shingles(tokens: Column, size: int = SHINGLE_WORDS) -> Column:
    """Every run of ``size`` words, joined by spaces, repeated ones too; none if there are fewer words."""
    return F.transform(_windows(tokens, size), lambda w, i: F.array_join(F.slice(tokens, i + 1, F.lit(size)), " "))


def shingle_hashes(hashes: Column, size: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of the shingles, from the words' hashes."""
    return F.transform(
        _windows(hashes, size), lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)])
    )


def with_shingle_hashes(df: DataFrame, text: str, name: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with the distinct shingle hashes of a text column."""
    hashed = once(df, "__hashes", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    return hashed.withColumn(name, F.array_distinct(shingle_hashes(F.col("__hashes"), size))).drop("__hashes")


def with_shingles(df: DataFrame, text: str, name: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with the distinct shingles of a text column."""
    split = once(df, "__words", words(F.col(text)))
    return split.withColumn(name, F.array_distinct(shingles(F.col("__words"), size))).drop("__words")


def set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by their place, and these names by the own ones, so that no helper column clashes."""
    names = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


# A table of so many entries, some tens of bytes each, may be sent to every executor.
SMALL = 1_000_000


def broadcast_if_small(df: DataFrame, entries: Column | None = None, most: int = SMALL) -> DataFrame:
    """``df`` marked for broadcasting if a count of its rows, or the sum of ``entries``, allows it.

    Else it stays as it is and joins by shuffling. ``df`` is read for the count: pass a stored table.
    """
    total = df.agg(F.sum(entries) if entries is not None else F.count("*")).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
