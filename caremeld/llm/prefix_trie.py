"""The trie of conversations that begin alike, by digests of fixed-length blocks of turns.

Turns are reduced to digests where they are read; no text is shuffled. The digest of a prefix is the exclusive or of its turns'
digests, each of which covers its place, so prefixes of blocks come from block digests alone. Conversations are grouped by
successive block digests first. Where all members of a prefix go on with the same block, every turn inside it has the
same members, and nothing more is grouped. Only inside blocks where siblings diverge are turn boundaries looked at, once for
every different block and not for every conversation.

A node's smallest member stands for it. The nodes a conversation stands for lie below one another, so sums over subtrees are
sums over members of what each stands for, less what lies above the node; they are taken by the same two steps.

Rows without a conversation id are left out; null roles and texts count as empty. Turns come in the order of ``turn``, null
first, ties by role and then by the digest of the text; repeated rows are turns of their own. An empty table has no
node; other columns are left out. Members of a node are counted before they are shuffled; long conversations and long
lists of members are spread by range, and a list is hashed from joined pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremeld.llm.shared import col, stored
from caremeld.operators.surrogate import assign_surrogate_id

#: Turns of a block.
BLOCK = 4
#: Members whose ids are joined into one piece before a list is hashed.
PIECE = 1024
EMPTY = hashlib.sha256(b"").hexdigest()


def described(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, position from 0, said, n_chars) for every turn: its place, a digest of role and text, and the text's length."""
    speaker, words = F.coalesce(col(role).cast("string"), F.lit("")), F.coalesce(col(text), F.lit(""))
    turns = conversations.where(col(id).isNotNull()).select(
        col(id).cast("long").alias("conv_id"),
        col(turn).isNotNull().alias("has_turn"),
        col(turn).alias("turn"),
        speaker.alias("role"),
        F.sha2(F.concat(F.length(speaker).cast("string"), F.lit(":"), speaker, words).cast("binary"), 256).alias("said"),
        F.length(words).cast("long").alias("n_chars"),
    )
    placed = assign_surrogate_id(turns, "place", ["conv_id", "has_turn", "turn", "role", "said"], drop=("has_turn", "turn", "role"))
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return stored(placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("position"), "said", "n_chars"), "turns")


def with_shared_beginnings(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """``described`` turns of conversations that begin as another one does, and all conversation ids.

    Conversation c gets the first h turns of c - c % ``every`` (as many as there are) for its own first h, where h is the
    unsigned crc32 of c's decimal digits modulo ``most``.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % most
    convs = stored(turns.groupBy("conv_id").agg(F.count("*").alias("size")), "conversations")
    wanted = convs.select("conv_id", (c - c % every).alias("base"), h.alias("h"))
    bases = convs.select(c.alias("base"), F.col("size").alias("base_size"))
    wanted = stored(wanted.join(bases, "base", "left").withColumn("got", F.least("h", F.coalesce("base_size", F.lit(0)))), "beginnings")
    heads = turns.where((c % every == 0) & (F.col("position") < most)).withColumnRenamed("conv_id", "base")
    given = wanted.join(heads, "base").where("position < h").select("conv_id", "position", "said", "n_chars")
    own = turns.where(F.col("position") >= h).join(wanted.select("conv_id", "h", "got"), "conv_id")
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("got")).alias("position"), "said", "n_chars")
    return stored(given.unionByName(own), "rebuilt"), convs.select("conv_id")


def tagged(turns: DataFrame, block: int) -> DataFrame:
    """Turns with their block's number ``k`` and two digests ``a``, ``b`` of 60 bits of what was said in which place."""
    digest = F.sha2(F.concat_ws(":", F.col("position").cast("string"), "said").cast("binary"), 256)
    parts = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "a"), (16, "b"))]
    return turns.select("conv_id", "position", "n_chars", F.expr(f"position div {block}").alias("k"), *parts)


def chained(turns: DataFrame) -> DataFrame:
    """(conv_id, k, m, pa, pb, ka, kb, last): the turns of every block, the digests of the prefix before and through it."""
    blocks = turns.groupBy("conv_id", "k").agg(F.count("*").alias("m"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    order = Window.partitionBy("conv_id").orderBy("k")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    through = blocks.select(
        "conv_id", "k", "m", "a", "b", F.bit_xor("a").over(so_far).alias("ka"), F.bit_xor("b").over(so_far).alias("kb"),
        F.lead("k").over(order).isNull().alias("last"),
    )
    return through.select("conv_id", "k", "m", F.col("ka").bitwiseXOR(F.col("a")).alias("pa"), F.col("kb").bitwiseXOR(F.col("b")).alias("pb"), "ka", "kb", "last")


def refined(chains: DataFrame, turns: DataFrame) -> DataFrame:
    """The turns of every different block, with its members counted.

    (k, ka, kb) name the block; ``alone`` says that no sibling diverges from it. (depth, a, b) name a turn's node and
    (depth - 1, qa, qb) its parent; ``n`` conversations have the block, the smallest is ``conv_id``.
    """
    name = ["k", "ka", "kb"]
    variants = stored(chains.groupBy(*name, "pa", "pb").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "blocks")
    parents = variants.groupBy("k", "pa", "pb").agg(F.count("*").alias("ways"), F.min("ka").alias("ka"), F.min("kb").alias("kb"))
    alone = parents.where("ways = 1").select(*name, F.lit(True).alias("alone"))
    marked = variants.join(alone, name, "left").withColumn("alone", F.coalesce("alone", F.lit(False)))
    found = marked.join(turns, ["conv_id", "k"])
    so_far = Window.partitionBy(*name).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    found = found.select(
        *name, "alone", "n", "conv_id", "n_chars", (F.col("position") + 1).alias("depth"), F.col("a").alias("ta"), F.col("b").alias("tb"),
        F.bit_xor("a").over(so_far).bitwiseXOR(F.col("pa")).alias("a"), F.bit_xor("b").over(so_far).bitwiseXOR(F.col("pb")).alias("b"),
    )
    return found.withColumns({"qa": F.col("a").bitwiseXOR(F.col("ta")), "qb": F.col("b").bitwiseXOR(F.col("tb"))}).drop("ta", "tb")


NODE = ["depth", "a", "b"]


def nodes_of(boundaries: DataFrame, members: DataFrame) -> DataFrame:
    """(depth, a, b, qa, qb, n_chars, n_convs, conv_id) of every node, the root included."""
    columns = [*NODE, "qa", "qb", "n_chars"]
    straight = boundaries.where("alone").select(*columns, F.col("n").alias("n_convs"), "conv_id")
    diverging = boundaries.where("not alone").groupBy(*columns).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    none = [F.lit(0).cast("long").alias(c) for c in NODE], [F.lit(None).cast("long").alias(c) for c in ("qa", "qb")]
    whole = members.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = whole.select(*none[0], *none[1], F.lit(0).cast("long").alias("n_chars"), "n_convs", "conv_id")
    return straight.unionByName(diverging).unionByName(root)


def subtree_sums(chains: DataFrame, boundaries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, a, b, leaves, saved): sums over the members of each node of what they stand for."""
    stands = nodes.groupBy("conv_id").agg(F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("own").alias("saved"))
    stands = stored(stands, "stands-for")
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    name = ["k", "ka", "kb"]
    by_block = chains.select("conv_id", *name).join(stands, "conv_id").groupBy(*name).agg(*sums)
    by_turn = boundaries.select(*name, "alone", *NODE).join(by_block, name)
    straight = by_turn.where("alone").select(*NODE, "leaves", "saved")
    diverging = by_turn.where("not alone").groupBy(*NODE).agg(*sums)
    root = stands.agg(*sums).select(*[F.lit(0).cast("long").alias(c) for c in NODE], "leaves", "saved").where("leaves is not null")
    return straight.unionByName(diverging).unionByName(root)


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of rows (depth, a, b, conv_id): the hash of a node's ids in order, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(NODE, node)) | {"first": ids[0], "ids": ",".join(map(str, ids))}], piece_schema)

        for batch in batches:
            for *now, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (now != node or len(ids) == PIECE):
                    yield closed()
                    ids = []
                node = now
                ids.append(conv_id)
        if ids:
            yield closed()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        for batch in batches:
            done = []
            for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now != node:
                    if node:
                        done.append(dict(zip(NODE, node)) | {"ends_sha256": state.hexdigest()})
                    node, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist(done, hash_schema)
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip(NODE, node)) | {"ends_sha256": state.hexdigest()}], hash_schema)

    long = [(c, pa.int64()) for c in NODE]
    piece_schema, hash_schema = pa.schema([*long, ("first", pa.int64()), ("ids", pa.string())]), pa.schema([*long, ("ends_sha256", pa.string())])
    ordered = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    joined = ordered.mapInArrow(pieces, "depth long, a long, b long, first long, ids string")
    together = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return together.mapInArrow(hashes, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of ``described`` turns: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``members`` (conv_id) are all conversations, those without a turn as well, each once. A node is named by its smallest
    member and its depth. ``saved_tokens`` sums, over the subtree, what sharing saves: all members but one times the
    characters of a node's last text.
    """
    tags = stored(tagged(turns, block), "tagged")
    chains = stored(chained(tags), "chains")
    boundaries = stored(refined(chains, tags), "boundaries")
    nodes = stored(nodes_of(boundaries, members), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("qa"), F.col("b").alias("qb"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("qa").alias("a"), F.col("qb").alias("b"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), NODE, "left")
    counted = counted.withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0)), "own": (F.col("n_convs") - 1) * F.col("n_chars")}
    )
    counted = stored(counted.join(above, ["depth", "qa", "qb"], "left"), "counted")
    higher = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    ended = chains.where("last").select((F.col("k") * block + F.col("m")).alias("depth"), F.col("ka").alias("a"), F.col("kb").alias("b"), "conv_id")
    silent = members.join(chains.select("conv_id").distinct(), "conv_id", "left_anti")
    ended = ended.unionByName(silent.select(*[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id"))
    result = (
        counted.withColumn("higher", F.coalesce(F.sum("own").over(higher), F.lit(0)))
        .join(subtree_sums(chains, boundaries, counted), NODE)
        .join(hashed_ends(stored(ended, "ends")), NODE, "left")
    )
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("saved") - F.col("higher")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
