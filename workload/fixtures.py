"""Sentence pairs derived from the ``documents`` table.

The given documents hold no URL, control character or typographic quote, so most
operators would never fire on them. Every document is therefore kept whole, and about a
third of them get a decoration, chosen by ``doc_id``. No document is left out. The SQL is
portable: the same text defines the tables in Spark and in the checking database.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GREEK = ("abcdefghijklmnopqrstuvwxyz", "αβψδεφγηιξκλμνοπθρστυωχχυζ")


def decorated(text: str, case: str) -> str:
    """SQL for a text with decoration number ``case``."""
    cases = {
        0: f"concat('  ', {text})",
        1: f"concat({text}, '  \t ')",
        2: f"concat('\u0001 ', {text})",
        3: f"concat({text}, '\u001fx')",
        4: f"concat({text}, ' see https://ex.org/a')",
        5: f"concat({text}, ' mail a.b@ex.org')",
        6: f"concat({text}, ' Ende.Der')",
        7: f"concat('„', {text}, '“')",
        8: f"concat({text}, '\u200b')",
        9: f"concat({text}, ' (open')",
        10: f"concat({text}, ' don’t')",
        11: f"concat({text}, ' say \"hi')",
        12: f"repeat(' ', CAST(length({text}) AS INT))",
        14: f"translate({text}, '{GREEK[0]}', '{GREEK[1]}')",
        16: f"concat({text}, ' minute’  s')",
        17: f"concat({text}, ' a\u0085b \u007f')",
    }
    return f"CASE {case} " + " ".join(f"WHEN {k} THEN {sql}" for k, sql in cases.items()) + f" ELSE {text} END"


TEXTS = f"SELECT doc_id AS id, {decorated('text', 'doc_id % 40')} AS text FROM documents"

# Each document with the next one; the last one stands with itself. Decorations are
# shifted between the sides. In case 15 both sides are equal.
_NEXT = "coalesce(b.text, a.text)"
_SIDES = f"""SELECT a.doc_id AS id,
  {decorated('a.text', 'a.doc_id % 40')} AS de,
  CASE a.doc_id % 40 WHEN 15 THEN a.text ELSE {decorated(_NEXT, '((a.doc_id + 10) % 40)')} END AS en"""
PAIRS = f"{_SIDES}\nFROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1"
# Ids of a block share all bits but these.
_BLOCK_BITS = 6


def read_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """Read a table; spread it over the cores if it comes in fewer pieces than cores.

    Only a small input (one file, one row group) is ever moved: a large one has more
    pieces than there are cores.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, text``"""
    return spark.sql(TEXTS.replace("FROM documents", "FROM {documents}"), documents=documents(spark, sf_dir))


def with_next(docs: DataFrame, ordered: bool = False) -> DataFrame:
    """The left join of ``PAIRS`` with one shuffle of the texts: ``a`` and ``b``, null or a struct, as columns.

    Blocks of neighbouring ids are dealt out, the first document of each to the block before, too. ``ordered`` deals
    them out by ranges, so that the rows lie in the order of their ids.
    """
    block = F.shiftright("doc_id", _BLOCK_BITS)
    first = F.col("doc_id").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)) == 0
    own = F.struct(block.alias("block"), F.lit(True).alias("own"))
    before = F.struct((block - 1).alias("block"), F.lit(False).alias("own"))
    places = F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))).alias("place")
    dealt = docs.select("doc_id", "text", places).select("doc_id", "text", "place.*")
    dealt = dealt.repartitionByRange("block") if ordered else dealt.repartition("block")
    # Equal ids follow several times, null ones never, as in the join.
    following = Window.partitionBy("block").orderBy("doc_id").rangeBetween(1, 1)
    found = F.collect_list(F.when(F.col("doc_id").isNotNull(), F.struct("text"))).over(following)
    rows = dealt.withColumn("b", found).sortWithinPartitions("block", "doc_id").where("own")
    return rows.select(F.struct("doc_id", "text").alias("a"), F.explode_outer("b").alias("b"))


def flat_pairs(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """``id, de, en``; ``ordered`` rows lie in the order of their ids."""
    return spark.sql(f"{_SIDES} FROM {{joined}}", joined=with_next(documents(spark, sf_dir), ordered))


def pairs(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """``id, translation``"""
    return flat_pairs(spark, sf_dir, ordered).select("id", F.struct("de", "en").alias("translation"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages as one-sided pairs: ``id, translation.html``, nothing added."""
    rows = read_table(spark, sf_dir, "pages", "page_id")
    return rows.select(F.col("page_id").alias("id"), F.struct("html").alias("translation"))
