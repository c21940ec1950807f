"""Line dedup by a deletion-neighbourhood join. Only DataFrame functions.

Lines are compared as their lower-case words, which are what stands between spaces. A line goes if
an earlier line, by ``(doc_id, line number)`` over all documents, has the same words, or if both have
at least ``near_words`` words and one inserted, deleted or replaced word makes them equal. Nothing
else matters: an earlier line that itself goes still counts. Blank lines always stay.

How near lines are found, without comparing all pairs:

1. Two lines one edit apart agree in their first or last words up to the middle. A line whose
   two halves no other line shares has no partner, and takes no further part.
2. Each remaining distinct line emits its deletion variants, hashed, with the place of the deleted
   word. Variants equal at the same place belong to lines that differ in that word alone,
   and a variant equal to a whole line is an insertion. Of each group only the earliest line
   matters, so the links are as many as the variants at most, however large the group.
3. Every link is verified on the words.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import broadcast_if_small, once, set_aside
from pairloom.sources.storage import materialize

NEAR_WORDS = 8
# A variant's hash is a xor over its words; running xors are built in pieces of so many words,
# so that a line of a million words doesn't copy its prefix for every word.
PIECE = 128


def _normal(line: Column) -> Column:
    """Lower case, single spaces between words and none around them."""
    low = F.trim(F.lower(line))
    return F.when(F.contains(low, F.lit("  ")), F.regexp_replace(low, " +", " ")).otherwise(low)


def _half_keys(normal: str, n: str) -> Column:
    """Hashes of the outer words up to near the middle of a normal line of ``n`` words.

    A line of n words may be the longer of a pair of n words or the shorter beside one of n + 1.
    Lengths are rounded down to multiples of four, so that both mostly give the same keys.
    """
    keys = []
    for longer in (n, f"({n} + 1)"):
        middle = f"int(floor(({longer} - 1) / 2))"
        half = f"if({middle} < 4, {middle}, {middle} - {middle} % 4)"
        keys.append(f"xxhash64('head', substring_index({normal}, ' ', {half}))")
        keys.append(f"xxhash64('tail', substring_index({normal}, ' ', -({half})))")
    return F.array_distinct(F.expr(f"array({', '.join(keys)})"))


def _running_xor(values: Column, base: Column) -> Column:
    """For each value, ``base`` and all values before it, xored."""
    start = F.struct(base.alias("now"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        values,
        start,
        lambda state, v: F.struct(
            state["now"].bitwiseXOR(v).alias("now"), F.array_append(state["out"], state["now"]).alias("out")
        ),
        lambda state: state["out"],
    )


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b))


def _with_variants(lines: DataFrame) -> DataFrame:
    """Adds ``whole``, the hash of all words, and ``variants``, one hash per deleted word."""
    # A word's hash depends on its place; behind a deleted word, places move down by one.
    df = once(lines, "own", F.transform("tokens", lambda w, k: F.xxhash64(w, k)))
    df = once(df, "moved", F.transform("tokens", lambda w, k: F.xxhash64(w, k - 1)))
    df = once(df, "both", F.zip_with("own", "moved", lambda a, b: a.bitwiseXOR(b)))
    starts = F.sequence(F.lit(0), F.size("both") - 1, F.lit(PIECE))
    df = once(df, "pieces", F.transform(starts, lambda s: F.slice("both", s + 1, F.lit(PIECE))))
    df = once(df, "bases", _running_xor(F.transform("pieces", _xor), F.lit(0).cast("bigint")))
    df = once(df, "before", F.flatten(F.zip_with("pieces", "bases", _running_xor)))
    df = once(df, "all_moved", _xor(F.col("moved")))
    rest = F.zip_with("moved", "before", lambda m, b: m.bitwiseXOR(b))
    variants = F.transform(rest, lambda r: F.col("all_moved").bitwiseXOR(r))
    return df.withColumn("whole", _xor(F.col("own"))).withColumn("variants", variants).drop(
        "own", "moved", "both", "pieces", "bases", "before", "all_moved"
    )


def _without(tokens: Column, place: Column) -> Column:
    return F.concat(F.slice(tokens, F.lit(1), place), F.slice(tokens, place + 2, F.size(tokens)))


PLACE = ("doc_id", "line_no", "text_key")


def _same_text(doc: str, key: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col("text_key") == F.col(key))


def near_lines(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``line_key`` of the distinct lines that have an earlier line one edit away."""
    long_lines = keys.where(F.size("halves") > 0)
    halves = long_lines.select(
        F.explode("halves").alias("half"), F.xxhash64("line_key").alias("short_key"), F.struct(*PLACE).alias("at")
    )
    shared = halves.groupBy("half").agg(F.min("short_key").alias("a"), F.max("short_key").alias("b"))
    shared = shared.where(F.col("a") != F.col("b")).select("half")
    firsts = halves.join(shared, "half", "left_semi").groupBy("short_key").agg(F.min("at").alias("at"))

    # The words of the remaining lines, from the document of their first occurrence.
    places = firsts.groupBy(F.col("at.doc_id").alias("of_doc"), F.col("at.text_key").alias("of_text")).agg(
        F.collect_list("at.line_no").alias("numbers")
    )
    places = broadcast_if_small(materialize(places, "places"), F.size("numbers") + 1)
    owners = docs.join(places, _same_text("of_doc", "of_text")).select(
        "doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"), "numbers"
    )
    found = owners.where(F.array_contains("numbers", F.col("line_no"))).select(
        F.struct(*PLACE).alias("at"), _normal(F.col("line")).alias("normal")
    )
    # One row for each line, also if a document row is repeated.
    lines = materialize(found.dropDuplicates(["normal"]), "lines")

    split = lines.select("at", F.split("normal", " ").alias("tokens"))
    hashed = _with_variants(split.withColumn("n", F.size("tokens"))).drop("tokens")
    dropped = hashed.select(F.posexplode("variants").alias("place", "variant"), "n", "at")
    groups = dropped.groupBy("variant", "place", "n").agg(F.min("at").alias("hub"), F.max("at").alias("last"))
    groups = groups.where(F.col("hub") != F.col("last")).select("variant", "place", "n", "hub")
    # A whole line is the target of lines of one word more, at whatever place.
    wholes = hashed.select(
        F.col("whole").alias("variant"), F.lit(None).cast("int").alias("place"), F.col("n") + 1, F.col("at").alias("hub")
    )
    targets = groups.unionByName(wholes.toDF("variant", "place", "n", "hub"))
    targets = targets.toDF("variant", "of_place", "of_n", "hub")
    met = dropped.join(targets, "variant").where(
        (F.col("n") == F.col("of_n")) & F.coalesce(F.col("place") == F.col("of_place"), F.lit(True))
    )
    links = met.where(F.col("at") != F.col("hub")).select(
        F.greatest("at", "hub").alias("at"), F.least("at", "hub").alias("hub"), "place"
    )
    own = lines.select("at", "normal", F.split("normal", " ").alias("a"))
    other = lines.select(F.col("at").alias("hub"), F.split("normal", " ").alias("b"))
    checked = links.distinct().join(own, "at").join(other, "hub")
    shorter_a, shorter_b = _without(F.col("a"), F.col("place")), _without(F.col("b"), F.col("place"))
    same = (
        F.when(F.size("a") == F.size("b"), shorter_a == shorter_b)
        .when(F.size("a") > F.size("b"), shorter_a == F.col("b"))
        .otherwise(shorter_b == F.col("a"))
    )
    return checked.where(same).select(_line_key("normal").alias("line_key")).distinct()


def _line_key(normal: str) -> Column:
    return F.unhex(F.md5(normal))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = NEAR_WORDS
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and ``n_lines`` and ``n_removed``.

    All rows and columns stay; an input column called ``n_lines`` or ``n_removed`` is replaced. A null
    text stays null and has no lines; an empty text is one blank line. Rows with the same id and
    text are one document, and are changed alike. Null ids come first.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed") or c in (id_col, text_col)]
    docs, own = set_aside(docs.select(*keep))
    id_col, text_col = own[id_col], own[text_col]
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    narrow = narrow.where(F.col("text").isNotNull()).withColumn("text_key", F.xxhash64("text"))
    split = narrow.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    split = once(split, "normal", _normal(F.col("line"))).where("normal != ''")
    split = once(split, "n", F.length("normal") - F.length(F.replace("normal", F.lit(" "), F.lit(""))) + 1)
    halves = F.when(F.col("n") >= near_words, _half_keys("normal", "n")).otherwise(F.array().cast("array<bigint>"))
    keys = split.select(*PLACE, _line_key("normal").alias("line_key"), halves.alias("halves"))
    keys = materialize(keys, "keys")

    near = near_lines(narrow, keys).withColumn("near", F.lit(True))
    at = F.struct(*PLACE)
    firsts = keys.groupBy("line_key").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    repeated = firsts.where(F.col("first") != F.col("last")).select("line_key", "first")
    decided = repeated.join(near, "line_key", "full")
    goes = F.coalesce(F.col("near"), F.lit(False)) | (at != F.col("first"))
    gone = keys.select("line_key", *PLACE).join(decided, "line_key").where(goes)
    gone = gone.groupBy(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__text")).agg(
        F.array_sort(F.collect_set("line_no")).alias("__gone")
    )
    gone = broadcast_if_small(materialize(gone, "gone"), F.size("__gone") + 1)

    text = F.col(text_col)
    same = F.col(id_col).eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__text"))
    joined = docs.join(gone, same, "left")
    # A flag for each line, built from the gaps between the removed ones in linear time.
    before = lambda k: F.coalesce(F.get(F.col("__gone"), k - 1), F.lit(-1))
    flags = F.flatten(
        F.transform(
            "__gone",
            lambda g, k: F.concat(F.array_repeat(F.lit(True), g - before(k) - 1), F.array(F.lit(False))),
        )
    )
    joined = once(joined, "__stays", flags)
    kept = F.filter(F.split(text, "\n"), lambda _, i: F.coalesce(F.get(F.col("__stays"), i), F.lit(True)))
    cleaned = F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[cleaned.alias(c) if own[c] == text_col else F.col(own[c]).alias(c) for c in keep],
        F.coalesce(F.array_size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
