"""The trie of conversations that begin with the same turns, by digests of blocks of turns.

A node is a distinct beginning of ``depth`` turns; its members are the conversations that begin so. Turns are cut
into blocks of a fixed length, and conversations are grouped by the digest of all blocks up to and with each block, so
a long beginning that many share costs one group per block. A block that is the only continuation of what stands
before it has the same members at each of its turns, which are read off it. Only where different blocks follow the
same beginning are the turn boundaries inside them grouped, too, and these are groups of blocks, not of conversations.

Digests of a beginning are the exclusive or of two 64-bit hashes of each turn with its number, so they add up in any
order: totals of superblocks first, then blocks in one, and no conversation, however long, is in one task.

What holds for a whole subtree is a sum over members. The smallest member of a node owns it; a conversation that owns a
node owns all it has further down, so each owns one piece of its way, and each node lies in one piece.
"""

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.sequence import dense_sequence
from pairloom.sources.storage import materialize

# Turns of a block, and blocks of a superblock.
BLOCK = 4
SUPERBLOCK = 4096
# Ids joined to one text when conversations that end at a node are listed.
LISTED = 10_000
WORD = r"[^\x20\x09-\x0D]+"

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NODE = ["depth", "a", "b"]


def turn_digest(role: Column, text: Column) -> Column:
    """The digest of a turn; it also orders turns of equal number."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def with_positions(turns: DataFrame, order_by: Sequence[str], out: str = "pos") -> DataFrame:
    """``turns`` with their number in the conversation, from 1. All rows are sorted together, so none need be in one task."""
    numbered = dense_sequence(turns, ["conv_id", *order_by], "__number")
    first = numbered.groupBy("conv_id").agg(F.min("__number").alias("__first"))
    return numbered.join(first, "conv_id").withColumn(out, F.col("__number") - F.col("__first") + 1).drop("__number", "__first")


def share_beginnings(conversations: DataFrame, every: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Conversations ``(conv_id, pos, role, text)`` that go on from the beginning of others, and all their ids.

    Conversation ``c`` begins with the first ``h`` turns of ``c - c % every`` instead of its own, ``h`` being the
    remainder of its id's CRC by ``most + 1``. Turns are ordered by ``turn``, nulls first, equal ones by their digest. Null
    roles and texts are empty, rows without an id take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"), turn_digest(role, text).alias("digest")
    )
    turns = materialize(with_positions(turns, ["turn", "digest"]).select("conv_id", "pos", "role", "text"), "turns")
    shared = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h")
    ids = turns.groupBy("conv_id").count().select("conv_id", shared, (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") <= most)).withColumnRenamed("conv_id", "base")
    # At most ``most`` rows for each conversation.
    begin = ids.join(heads, "base").where(F.col("pos") <= F.col("h")).select(turns.columns)
    own = turns.where(F.col("pos") > shared)
    return begin.unionByName(own), ids.select("conv_id")


def _earlier(name: str, window: Window, combine=F.bit_xor) -> Column:
    return F.coalesce(combine(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def turn_blocks(turns: DataFrame, size: int = BLOCK, superblock: int = SUPERBLOCK) -> tuple[DataFrame, DataFrame]:
    """Blocks with the digest and words of all that stands before, and the way of each conversation.

    Blocks are ``(conv_id, block, a0, b0, words0, a, b, turns)``: before it, up to its end, and its turns ``(pos, a, b,
    words)``. Ways are ``(conv_id, depth, a, b, words)``.
    """
    hashed = turns.select(
        "conv_id", "pos", "words", F.xxhash64("pos", "digest").alias("a"), F.xxhash64("digest", "pos").alias("b"),
        F.floor((F.col("pos") - 1) / size).alias("block"),
    )
    turn = F.struct("pos", "a", "b", "words")
    blocks = hashed.groupBy("conv_id", "block").agg(
        F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.sum("words").alias("w"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    blocks = materialize(blocks.withColumn("super", F.floor(F.col("block") / superblock)), "blocks")
    totals = blocks.groupBy("conv_id", "super").agg(
        F.bit_xor("xa").alias("ta"), F.bit_xor("xb").alias("tb"), F.sum("w").alias("tw"), F.sum(F.size("turns")).alias("n")
    )
    ways = totals.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("ta").alias("a"), F.bit_xor("tb").alias("b"), F.sum("tw").alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy("super")
    before = totals.select(
        "conv_id", "super", _earlier("ta", order).alias("ta"), _earlier("tb", order).alias("tb"), _earlier("tw", order, F.sum).alias("tw")
    )
    inside = Window.partitionBy("conv_id", "super").orderBy("block")
    placed = blocks.join(before, ["conv_id", "super"]).select(
        "conv_id", "block", "turns", "xa", "xb",
        F.col("ta").bitwiseXOR(_earlier("xa", inside)).alias("a0"),
        F.col("tb").bitwiseXOR(_earlier("xb", inside)).alias("b0"),
        (F.col("tw") + _earlier("w", inside, F.sum)).alias("words0"),
    )
    after = [F.col("a0").bitwiseXOR(F.col("xa")).alias("a"), F.col("b0").bitwiseXOR(F.col("xb")).alias("b")]
    return placed.select("conv_id", "block", "a0", "b0", "words0", *after, "turns"), ways


def _nodes(blocks: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Nodes ``(depth, a, b, a0, b0, words0, words, owner, n, n_end, *sums)``, one digest before and one with the last turn.

    ``blocks`` are those of one conversation for each distinct way, with ``n`` conversations that go it, ``length`` its
    length, ``owner`` a struct that begins with the conversation's id, and further values to add up.
    """
    add = ["n", *sums]
    ends = F.when(F.col("length") == F.element_at("turns", -1)["pos"], F.col("n")).otherwise(0)
    any_of = [F.any_value(c).alias(c) for c in ("a0", "b0", "words0", "turns")]
    total = [F.min("owner").alias("owner"), *[F.sum(c).alias(c) for c in add]]
    groups = materialize(blocks.groupBy("block", "a", "b").agg(*any_of, *total, F.sum(ends).alias("n_end")), "groups")
    # Blocks that alone follow what stands before them; the join is by the block, so a beginning with many isn't hot.
    alone = groups.groupBy("block", "a0", "b0").agg(F.count("*").alias("many"), F.any_value("a").alias("a"), F.any_value("b").alias("b"))
    alone = alone.where("many = 1").select("block", "a", "b", F.lit(True).alias("alone"))
    marked = materialize(groups.join(alone, ["block", "a", "b"], "left").drop("a", "b"), "marked")

    def turn_boundary(turn: Column, i: Column) -> Column:
        earlier = F.slice("turns", 1, i)
        xor = lambda name: F.aggregate(earlier, F.col(f"{name}0"), lambda x, t: x.bitwiseXOR(t[name]))
        words = F.aggregate(earlier, F.col("words0"), lambda x, t: x + t["words"])
        last = i == F.size("turns") - 1
        return F.struct(
            turn["pos"].alias("depth"),
            xor("a").bitwiseXOR(turn["a"]).alias("a"), xor("b").bitwiseXOR(turn["b"]).alias("b"),
            xor("a").alias("a0"), xor("b").alias("b0"), words.alias("words0"), turn["words"].alias("words"),
            F.when(last, F.col("n_end")).otherwise(0).alias("n_end"),
        )

    def cut(rows: DataFrame) -> DataFrame:
        inner = rows.select(F.explode(F.transform("turns", turn_boundary)).alias("node"), "owner", *add)
        return inner.select("node.*", "owner", *add)

    refined = cut(marked.where("alone IS NULL")).groupBy(*NODE).agg(
        *[F.any_value(c).alias(c) for c in ("a0", "b0", "words0", "words")], F.sum("n_end").alias("n_end"), *total
    )
    return cut(marked.where("alone")).unionByName(refined)


def _listed_ends(ways: DataFrame) -> DataFrame:
    """``(depth, a, b, ends_sha256)``: the digest of the ascending ids of the conversations that end at a node.

    Sorted ids are joined to texts of bounded length, wherever a partition ends, and only these come together by
    node, to be hashed one after the other.
    """
    order = [*NODE, "conv_id"]
    ids = ways.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, listed, out = None, None, [], []

        def close():
            out.append((*key, first, ",".join(listed)))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in order]
            for depth, a, b, conv in zip(*columns):
                if key != (depth, a, b) or len(listed) >= LISTED:
                    if key:
                        close()
                    key, first, listed = (depth, a, b), conv, []
                listed.append(str(conv))
            yield _batch(out, first=pa.int64(), ids=pa.string())
            out.clear()
        if key:
            close()
            yield _batch(out, first=pa.int64(), ids=pa.string())

    texts = ids.mapInArrow(join_ids, "depth long, a long, b long, first long, ids string")
    texts = texts.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for batch in batches:
            for depth, a, b, listed in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if key != (depth, a, b):
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (depth, a, b), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(listed.encode())
            yield _batch(out, ends_sha256=pa.string())
            out.clear()
        if key:
            yield _batch([(*key, sha.hexdigest())], ends_sha256=pa.string())

    return texts.mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def _batch(rows: list[tuple], **more: pa.DataType) -> pa.RecordBatch:
    schema = pa.schema([*[(c, pa.int64()) for c in NODE], *more.items()])
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def prefix_trie(turns: DataFrame, members: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of ``turns(conv_id, pos, role, text)``, with the columns ``COLUMNS``.

    ``conv_id`` is the node's smallest member; with ``depth`` it names the node, ``parent_conv_id`` the parent's (null for
    the root). ``n_convs`` are the members, ``n_children`` the children, ``n_leaves`` the childless nodes of the subtree,
    ``saved_tokens`` the words that a cache of shared beginnings saves in it, ``ends_sha256`` the digest of the ids of
    the members that end here. Turns are ordered by ``pos``, nulls first, equal ones by their digest; null roles and texts
    are empty. ``members(conv_id)`` may name conversations without turns, which end at the root. Rows without an id take no
    part, repeated ids of members count once, further columns are ignored, and without conversations there is no node.
    """
    spark = turns.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    known = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("pos").alias("at"), turn_digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    blocks, ways = turn_blocks(with_positions(known, ["at", "digest"]), block)
    zero = F.lit(0).cast("long")
    if members is not None:
        ids = members.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long")).distinct()
        empty = ids.join(ways, "conv_id", "left_anti").select("conv_id", *[zero.alias(c) for c in ("depth", "a", "b", "words")])
        ways = ways.unionByName(empty)
    ways = materialize(ways, "ways")
    # Equal conversations are one way from here on.
    distinct = ways.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.any_value("words").alias("total"))
    distinct = materialize(distinct.withColumnRenamed("depth", "length").drop("a", "b"), "distinct")
    blocks = materialize(blocks.join(distinct, "conv_id"), "way_blocks")

    first = _nodes(blocks.withColumn("owner", F.struct("conv_id")), [])
    leaf = F.max_by(F.col("n") == F.col("n_end"), "depth").cast("long")
    owned = first.groupBy(F.col("owner.conv_id").alias("conv_id")).agg(
        F.min("depth").alias("from"), F.sum("words").alias("own"), leaf.alias("leaf")
    )
    owned = materialize(owned, "owned")
    valued = blocks.join(owned, "conv_id", "left").select(
        "*", F.struct("conv_id", "from", "own", "total").alias("owner"),
        (F.col("n") * F.col("total")).alias("all_words"), F.coalesce("own", zero).alias("own_words"), F.coalesce("leaf", zero).alias("leaves"),
    )
    nodes = materialize(_nodes(valued, ["all_words", "own_words", "leaves"]), "nodes")

    # Words of members from here on, less those of the nodes, each of which is read once.
    owner, before = F.col("owner"), F.col("words0")
    saved = F.col("all_words") - F.col("n") * before - (F.col("own_words") - owner["own"] + owner["total"] - before)
    every = ways.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).first()
    below = nodes.agg(F.sum(F.when(F.col("depth") == owner["from"], 1)), F.sum((F.col("n") - 1) * F.col("words"))).first()
    leaves = owned.agg(F.sum("leaf")).first()[0] or 1
    plain = nodes.select(
        *NODE, "a0", "b0", F.col("owner.conv_id").alias("conv_id"), F.col("owner.from").alias("from"), F.col("n").alias("n_convs"),
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
    )
    top = (0, 0, 0, None, None, every["conv_id"], 0, every["n"], leaves, below[1] or 0)
    root = spark.createDataFrame([top] if every["n"] else [], plain.schema)
    plain = plain.unionByName(root)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("a0").alias("a"), F.col("b0").alias("b")).agg(F.count("*").alias("n_children"))
    ends = _listed_ends(ways)
    # A parent has the same owner, but where the owner's piece begins. Many such pieces may hang on one node: that join is
    # skewed on its left side only, which Spark splits.
    up = plain.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("a0"), F.col("b").alias("b0"), F.col("conv_id").alias("parent_conv_id"))
    begins = F.col("depth") == F.col("from")
    attached = plain.where(begins & (F.col("depth") > 0)).join(up, ["depth", "a0", "b0"])
    inside = plain.where(~begins).withColumn("parent_conv_id", F.col("conv_id"))
    none = plain.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    placed = attached.unionByName(inside).unionByName(none)
    out = placed.join(children, NODE, "left").join(ends, NODE, "left")
    out = out.withColumn("n_children", F.coalesce("n_children", zero)).withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return out.select(*COLUMNS)
