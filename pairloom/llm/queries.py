"""One query per operator of this subpackage, over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import once, table
from pairloom.llm.decontaminate import find_leaks
from pairloom.llm.language import identify
from pairloom.llm.licences import SIGNS, scan_licences
from pairloom.llm.line_dedup import dedup_lines
from pairloom.llm.near_dedup import near_classes
from pairloom.llm.packing import pack
from pairloom.llm.pattern_packing import pack_patterns
from pairloom.llm.periodic import collapse_runs
from pairloom.llm.prefix_trie import prefix_trie, share_beginnings
from pairloom.llm.repeats import remove_repeats
from pairloom.llm.resample import resample
from pairloom.llm.tokens import tokenizer_file
from pairloom.llm.topk import top_k
from pairloom.llm.warc import round_trip


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: each gets one by source, language and block of ids.

    Every second document with a word of licences stands for the licence file of a directory: of its block, its language or its source.
    """
    docs = table(spark, sf_dir, "documents")
    holds = F.col("text").rlike(SIGNS) & (F.col("doc_id") % 2 == 0)
    up = F.when(holds, F.col("doc_id") % 3).otherwise(0)
    block = F.floor(F.col("doc_id") / 100).cast("string")
    parts = [F.coalesce("source", F.lit("-")), F.when(up < 2, F.coalesce("lang", F.lit("-"))), F.when(up < 1, block), F.col("doc_id").cast("string")]
    path = F.concat(F.lit("/"), F.concat_ws("/", *parts))
    found = scan_licences(docs.select(path.alias("path"), "text", holds.alias("holds")), licence_file=F.col("holds"))
    doc_id = F.substring_index("path", "/", -1).cast("long").alias("doc_id")
    return found.select(doc_id, "path", "own_licence", "score", "inherited_licence", "inherited_from", "licence")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op10_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_patterns(table(spark, sf_dir, "documents"), tokenizer_file())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``, where a tenth of the texts repeats some words from a place on, both by a hash of the id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    white = r"[\x20\x09-\x0D]+"
    words = F.array_remove(F.split(F.when(h % 10 == 0, F.col("text")), white), "")
    split = once(docs, "__words", words)
    g, n = F.floor(h / 10), F.size("__words").cast("long")
    # try_mod: a text without words has no place to repeat from.
    begin = F.try_mod(g, n)
    placed = once(split, "__at", F.struct(begin.alias("a"), (F.lit(1) + F.floor((n - begin) / (g % 8 + 3))).alias("p")))
    a, p = F.col("__at.a"), F.col("__at.p")
    source = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
    changed = F.array_join(F.transform(source, lambda i: F.get("__words", i.cast("int"))), " ")
    text = F.when((h % 10 == 0) & (n > 0), changed).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = collapse_runs(with_planted_periods(docs))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt, ids = share_beginnings(table(spark, sf_dir, "conversations"))
    return prefix_trie(rebuilt, ids)


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_language": op4_language,
    "op5_warc": op5_warc,
    "op6_licences": op6_licences,
    "op7_line_dedup": op7_line_dedup,
    "op8_repeats": op8_repeats,
    "op9_near_dedup": op9_near_dedup,
    "op10_resample": op10_resample,
    "op11_pattern_packing": op11_pattern_packing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}
