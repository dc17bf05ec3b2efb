"""A trie of conversation prefixes, by fixed-length block hashing.

Turns are cut into blocks of BLOCK. The digest of a prefix is the XOR of 128-bit
hashes of its turns with their places, so digests of whole blocks add up along a
conversation without reading it in one task. Conversations are grouped by their block
digests first: what shares a block from the start on is one row from there on. Single
turns are looked at once for each different block, and compared only below a
prefix after which blocks differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import contained, materialize

# Turns in a block, and blocks in a stretch along which digests are added in one task.
BLOCK, STRETCH = 4, 1024
# Tasks among which the blocks after one prefix are dealt.
SALTS = 64

_NODE = ["depth", "high", "low"]
_EMPTY = hashlib.sha256(b"").hexdigest()
# Ids that one row carries on their way into a node's hash.
_IDS = 4096


# Spark numbers the rows of a task from its index shifted by so many bits.
_TASK_BITS = 33


def number_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, role, text, digest, size), and conversations (conv_id, n).

    ``place`` counts the turns of a conversation from 1 by turn, null first, then role
    and text; ``size`` is the text's code points. Null roles and texts are empty, rows
    without a conversation are left out, repeated rows are turns of their own. Ranges of
    the order go to tasks and are counted there, so no conversation, however long, is
    one task's. Other columns are ignored.
    """
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        # Rows alike in all four are exchangeable; this only spreads them.
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    apart = F.concat_ws(":", F.char_length("role").cast("string"), "role", "text")
    dealt = dealt.select(
        "conv_id",
        "role",
        "text",
        F.sha2(apart, 256).alias("digest"),
        F.char_length("text").cast("long").alias("size"),
        F.monotonically_increasing_id().alias("seat"),
    )
    dealt = materialize(dealt, "turn-ranges").withColumn("part", F.shiftright("seat", _TASK_BITS))
    counts = dealt.groupBy("conv_id", "part").agg(F.min("seat").alias("first"), F.count("*").alias("n"))
    counts = materialize(counts, "turn-counts")
    # A row per task that a conversation spans.
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbered = dealt.join(starts, ["conv_id", "part"]).select(
        "conv_id",
        (F.col("before") + F.col("seat") - F.col("first") + 1).alias("place"),
        "role",
        "text",
        "digest",
        "size",
    )
    return numbered, counts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def lend_heads(
    turns: DataFrame, conversations: DataFrame, family: int = 100, heads: int = 6
) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations in which each begins like the first of its family.

    Conversation c takes the first h turns of c - c % ``family`` (all if there are fewer,
    none if it is absent), then its own turns after its first h, with h the unsigned
    crc32 of c in decimal modulo ``heads``. One without turns left has n = 0.
    """
    known = conversations.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    first = conversations.filter(F.col("conv_id") % family == 0).toDF("base", "base_n")
    known = known.join(first, "base", "left").select(
        "conv_id", "base", "h", "n", F.least("h", F.coalesce("base_n", F.lit(0))).alias("lent")
    )
    known = materialize(known, "heads")
    lent = turns.filter((F.col("conv_id") % family == 0) & (F.col("place") < heads))
    lent = lent.withColumnRenamed("conv_id", "base").join(known.select("conv_id", "base", "h"), "base")
    lent = lent.filter("place <= h").select(*turns.columns)
    own = turns.join(known.select("conv_id", "h", "lent"), "conv_id").filter("place > h")
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("lent")).select(*turns.columns)
    sizes = known.select("conv_id", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return lent.union(own), sizes


def _prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation and block: the prefix digests before and after it, and its turns."""
    hashed = turns.select(
        "conv_id",
        "place",
        "size",
        *(F.xxhash64(F.lit(i), "place", "digest").alias(c) for i, c in enumerate(("high", "low"))),
    ).withColumn("block", F.expr(f"(place - 1) div {BLOCK}L"))
    blocks = hashed.groupBy("conv_id", "block").agg(
        F.bit_xor("high").alias("high"),
        F.bit_xor("low").alias("low"),
        # At most BLOCK turns.
        F.sort_array(F.collect_list(F.struct("place", "high", "low", "size"))).alias("turns"),
    )
    blocks = blocks.withColumn("stretch", F.expr(f"block div {STRETCH}L"))
    blocks = materialize(blocks, "turn-blocks")
    key = ["conv_id", "stretch"]
    inside = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy(*key).agg(F.bit_xor("high").alias("high"), F.bit_xor("low").alias("low"))
    sums = sums.select(
        *key, *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in ("high", "low"))
    )
    run = blocks.select(
        *key, "block", "turns", "high", "low", *(F.bit_xor(c).over(inside).alias(f"{c}_run") for c in ("high", "low"))
    ).join(sums, key)
    after = {c: F.col(f"{c}_run").bitwiseXOR(F.col(f"{c}_start")) for c in ("high", "low")}
    return run.select(
        "conv_id",
        "block",
        "turns",
        *(after[c].bitwiseXOR(F.col(c)).alias(f"{c}_before") for c in ("high", "low")),
        *(after[c].alias(c) for c in ("high", "low")),
    )


def _turn_nodes(edges: DataFrame) -> DataFrame:
    """Each turn of each block as a node: its digest, its parent's, and the block's members."""

    def upto(column: str, count):
        begun = F.col(f"{column}_before")
        return F.aggregate(F.slice("turns", 1, count), begun, lambda sum_, t: sum_.bitwiseXOR(t[column]))

    def node(i):
        # Slices begin at 1, so nothing before the first turn is a slice of length 0.
        return F.struct(
            F.element_at("turns", i)["place"].alias("depth"),
            *(upto(c, i).alias(c) for c in ("high", "low")),
            *(upto(c, i - 1).alias(f"{c}_parent") for c in ("high", "low")),
            F.element_at("turns", i)["size"].alias("size"),
        )

    every = F.transform(F.sequence(F.lit(1), F.size("turns")), node)
    return edges.select(F.inline(every), "n_convs", "conv_id")


@contained("prefix-trie")
def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of (role, text) turns, from the empty one at depth 0.

    Takes what ``number_turns`` gives. Columns: conv_id (the smallest member), depth,
    parent_conv_id (its parent's conv_id; null at the root), n_convs (conversations that
    begin with it), n_children, n_leaves and saved_tokens (over its subtree, itself
    included: childless nodes, and (n_convs - 1) times the code points of a node's last
    text), ends_sha256 (of the ids of the conversations that end there, ascending and
    comma-joined), and high and low, its digest.

    Conversations without turns are members of the root. No conversations give no rows.
    Equal turns are told by SHA-256 and prefixes by 128 bits; texts themselves do not
    move. Sums over subtrees take as many rounds as the longest conversation's length
    has binary digits; no task holds a subtree or all members of a node.
    """
    prefixes = materialize(_prefixes(turns, conversations), "prefixes")
    parent = ["block", "high_before", "low_before"]
    edges = prefixes.groupBy(*parent, "high", "low").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")
    )
    edges = materialize(edges, "blocks")
    forks = edges.groupBy(*parent).agg(F.count("*").alias("ways")).filter("ways > 1")
    # All conversations may fork at one prefix: what follows it is dealt over SALTS tasks.
    forks = forks.select(*parent, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = edges.withColumn("salt", F.pmod("high", F.lit(SALTS)).cast("int"))
    together = _turn_nodes(salted.join(forks, [*parent, "salt"], "left_anti"))
    apart = _turn_nodes(salted.join(forks, [*parent, "salt"], "left_semi")).groupBy(*_NODE).agg(
        F.first("high_parent").alias("high_parent"),
        F.first("low_parent").alias("low_parent"),
        F.first("size").alias("size"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
    )
    whole = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = whole.filter("n_convs > 0").select(
        *(F.lit(0).cast("long").alias(c) for c in _NODE),
        *(F.lit(None).cast("long").alias(c) for c in ("high_parent", "low_parent")),
        F.lit(0).cast("long").alias("size"),
        "n_convs",
        "conv_id",
    )
    nodes = materialize(root.unionByName(together).unionByName(apart), "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("high_parent").alias("high"), F.col("low_parent").alias("low")]
    children = nodes.filter("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").fillna(0, ["n_children"])
    nodes = materialize(nodes, "nodes")

    smallest = nodes.select(*_NODE, F.col("conv_id").alias("parent_conv_id")).filter("n_children > 0")
    smallest = smallest.select(
        (F.col("depth") + 1).alias("depth"), F.col("high").alias("high_parent"), F.col("low").alias("low_parent"),
        "parent_conv_id",
    )
    sums = _subtree_sums(nodes)
    ends = _ends(prefixes, conversations)
    return (
        nodes.join(smallest, ["depth", "high_parent", "low_parent"], "left")
        .join(sums, _NODE)
        .join(ends, _NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
            "high",
            "low",
        )
    )


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of every node, by doubling the distance that sums travel.

    After a round a node holds the sums of all its descendants nearer than ``step``
    and knows its ancestor at that distance.
    """
    top = ["depth_top", "high_top", "low_top"]
    state = nodes.select(
        *_NODE,
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        (F.col("depth") - 1).alias("depth_top"),
        F.col("high_parent").alias("high_top"),
        F.col("low_parent").alias("low_top"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        sent = state.filter(F.col("depth") >= step).groupBy(*top)
        sent = sent.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        sent = sent.toDF(*_NODE, "more_leaves", "more_saved")
        # Above 2 * step the ancestor's ancestor is known by its row; at 2 * step it is the root.
        further = state.filter(F.col("depth") > step).select(*_NODE, *top).toDF(*top, *(f"{c}_next" for c in top))
        climbing = state.select(*_NODE, *top).filter(F.col("depth") > 2 * step)
        climbing = climbing.join(further, top).select(*_NODE, *(F.col(f"{c}_next").alias(c) for c in top))
        zero = [F.lit(0).cast("long").alias(c) for c in top]
        climbing = climbing.union(state.filter(F.col("depth") == 2 * step).select(*_NODE, *zero))
        held = state.select(*_NODE, "n_leaves", "saved_tokens").join(sent, _NODE, "left").select(
            *_NODE,
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        )
        state = materialize(held.join(climbing, _NODE, "left"), "subtree-sums")
        step *= 2
    return state.select(*_NODE, "n_leaves", "saved_tokens")


def _ends(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node; nodes with such only.

    Sorted ranges of ids become strings of up to _IDS ids in parallel; a node's strings
    then pass through one hash in order, of which a task holds nothing but the state.
    """
    last = prefixes.select(
        "conv_id", F.element_at("turns", -1)["place"].alias("depth"), "high", "low"
    ).join(conversations.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"])
    bare = conversations.filter("n = 0").select("conv_id", *(F.lit(0).cast("long").alias(c) for c in _NODE))
    ids = last.select("conv_id", *_NODE).union(bare.select("conv_id", *_NODE))
    order = [*_NODE, "conv_id"]
    strings = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    strings = strings.mapInArrow(_join_ids, "depth long, high long, low long, first_id long, ids string")
    dealt = strings.repartition(*_NODE).sortWithinPartitions(*_NODE, "first_id")
    return dealt.mapInArrow(_hash_ids, "depth long, high long, low long, ends_sha256 string")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, node, first, ids = [], None, None, []
        for *own, conv_id in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv_id"))):
            if own != node or len(ids) == _IDS:
                if ids:
                    found.append((*node, first, ",".join(ids)))
                node, first, ids = own, conv_id, []
            ids.append(str(conv_id))
        if ids:
            found.append((*node, first, ",".join(ids)))
        if found:
            kinds = [pa.int64()] * 4 + [pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*_NODE, "first_id", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(found: list) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [*_NODE, "ends_sha256"]
        )

    node, state = None, hashlib.sha256()
    for batch in batches:
        found = []
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
            if own == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                found.append((*node, state.hexdigest()))
            node, state = own, hashlib.sha256(ids.encode())
        yield rows(found)
    if node is not None:
        yield rows([(*node, state.hexdigest())])


def node_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of their last turn; null at the root."""
    last = turns.select("conv_id", F.col("place").alias("depth"), "role", "text")
    return nodes.join(last, ["conv_id", "depth"], "left")
