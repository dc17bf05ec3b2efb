"""Near-duplicate texts by bottom-k sketches of word shingles.

One hash function orders all shingles; a sketch keeps the k smallest values of
a text. Of these the index keeps the lowest INDEXED, rarest first, so that a
passage that many texts share fills long lists only for texts made of little
else. Each list joins its members to its most central one, the union sketch
decides which of these pairs are worth a look, and the full shingle sets confirm.
What is not yet in one component is then compared within each list, in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.graph import components
from reviewmill.llm.rows import column, keep_one, mark
from reviewmill.llm.texts import shingles, slices
from reviewmill.session import contained, materialize

WIDTH = 5
# Values in a sketch, 32 bits each. A text with fewer shingles is held whole.
SKETCH = 256
# An estimate may miss the true similarity by so many standard deviations.
DEVIATIONS = 5.0
# Lowest values of a sketch that the index looks at, and how many of them, the
# rarest, it lists. Of the lowest 24 values of their union a pair at 0.85 shares
# 20 give or take 1.8; sharing 12 or more makes the 13 rarest meet.
INDEXED, LISTED = 24, 13
# A value in more texts than this counts as frequent: the rarest come first.
FREQUENT = 16
# Lists up to this long are compared by a join, longer ones in blocks of BLOCK.
SHORT, BLOCK = 64, 1024

# Pairs of one text that meet in one task; a text in more pairs is sent to several.
TOGETHER = 256
# A shared value goes into a dense product if more rows than this have it.
DENSE = 64

_SKETCHED = "doc_id long, mark string, n_shingles long, digest string, sketch array<int>"


def _sketch(width: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, bounds = shingles(part.column("text"), width)
                digests, sizes, kept, lengths = [], [], [], []
                for start, end in zip(bounds[:-1], bounds[1:]):
                    own = np.unique(values[start:end])
                    sizes.append(len(own))
                    digests.append(_set_digest(own))
                    kept.append(own[:size])
                    lengths.append(min(size, len(own)))
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                flat = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("mark"),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(_signed(flat))),
                    ],
                    ["doc_id", "mark", "n_shingles", "digest", "sketch"],
                )

    return run


def _signed(values: np.ndarray) -> np.ndarray:
    """The upper halves, as integers that Spark orders alike."""
    return ((values >> np.uint64(32)).astype(np.uint32) ^ np.uint32(1 << 31)).view(np.int32)


def _set_digest(values: np.ndarray) -> str | None:
    """Tells different sets apart (128 bits); null for the empty set."""
    return hashlib.md5(values.tobytes()).hexdigest() if len(values) else None


def _postings(classes: DataFrame) -> DataFrame:
    """(value, node, hot): the rarest of each sketch's lowest values.

    ``hot`` counts the frequent values of the text; the text with the most is the
    most central of a list.
    """
    low = classes.select("node", F.explode(F.slice("sketch", 1, INDEXED)).alias("value"))
    frequent = low.groupBy("value").agg(F.count("*").alias("df")).filter(F.col("df") > FREQUENT)
    ranked = low.join(frequent, "value", "left").groupBy("node").agg(
        F.sort_array(
            F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "value"))
        ).alias("values"),
        F.count("df").alias("hot"),
    )
    return ranked.select(
        "node", "hot", F.explode(F.slice("values", 1, LISTED)).alias("one")
    ).select(F.col("one.value").alias("value"), "node", "hot")


def _stars(postings: DataFrame) -> DataFrame:
    """Each member of a list with the most central one; one row per member."""
    centres = (
        postings.groupBy("value")
        .agg(F.max(F.struct("hot", F.bitwise_not("node").alias("rank"))).alias("best"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("value", F.bitwise_not("best.rank").alias("centre"))
    )
    return (
        postings.join(centres, "value")
        .filter("node <> centre")
        .select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
        .distinct()
    )


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column as views of its numbers; null counts as empty."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())
    return np.split(column.flatten().to_numpy(), ends[:-1]) if len(ends) else []


def _estimates(threshold: float):
    """Passes pairs whose union sketch reaches the threshold, less what may be chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Never as Python numbers, of which a batch would take hundreds of MB.
            left, right = _lists(batch.column("left_sketch")), _lists(batch.column("right_sketch"))
            both = [batch.column(f"{c}_n_shingles").to_numpy() for c in ("left", "right")]
            limits = threshold - slack(both[0] + both[1], threshold)
            good = [estimate(x, y) >= limit for x, y, limit in zip(left, right, limits)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def slack(both_sizes, threshold: float):
    """How far below the truth an estimate may be, from the sum of both sizes.

    The sketch is a sample without replacement of the union, so the error goes
    to nothing as the sketch nears the whole union; two values may share 32 bits.
    """
    union = both_sizes / (1 + threshold)
    unseen = np.maximum(0.0, 1 - SKETCH / np.maximum(union, 1))
    return DEVIATIONS * np.sqrt(threshold * (1 - threshold) / SKETCH * unseen) + 1 / SKETCH


def estimate(left: np.ndarray, right: np.ndarray) -> float:
    """Similarity of two sets from their sorted sketches: the share of common
    values among the lowest of the union. Exact if both sketches are whole sets."""
    union = np.union1d(left, right)
    if len(left) == SKETCH or len(right) == SKETCH:
        union = union[:SKETCH]
    common = np.intersect1d(left, right)
    return np.count_nonzero(common <= union[-1]) / len(union) if len(union) else 0.0


def _attach(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored pairs (a, b) with the columns of both nodes' ``rows``, as left_* and right_*.

    The row of a text in many pairs is sent to a task for each TOGETHER of them, so one that
    is compared with a third of all others is no task's alone. The other rows are dealt
    once, those in no pair not at all.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = rows.join(needed, "node", "left_semi")
    joined = pairs
    for side, other, prefix in (("a", "b", "left"), ("b", "a", "right")):
        names = {"node": side} | {c: f"{prefix}_{c}" for c in rows.columns if c != "node"}
        ways = F.ceil(F.count("*") / TOGETHER).cast("int").alias("ways")
        # Few rows; stored, so that Spark knows and moves nothing else for these joins.
        hot = materialize(pairs.groupBy(side).agg(ways).filter("ways > 1"), "hot-texts")
        if hot.isEmpty():
            joined = joined.join(some.withColumnsRenamed(names), side)
            continue
        split = rows.withColumnsRenamed(names).join(hot, side)
        split = split.select("*", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("salt")).drop("ways")
        salted = joined.join(hot, side).withColumn("salt", F.pmod(F.xxhash64(other), "ways").cast("int")).drop("ways")
        few = joined.join(hot, side, "left_anti").join(some.withColumnsRenamed(names), side)
        joined = few.unionByName(salted.join(split, [side, "salt"]).drop("salt"))
    return joined


def _promising(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    both = _attach(pairs, classes.select("node", "sketch", "n_shingles"))
    return both.mapInArrow(_estimates(threshold), "a long, b long")


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                sets = []
                for name in ("left_text", "right_text"):
                    values, bounds = shingles(part.column(name), width)
                    sets.append([np.unique(values[s:e]) for s, e in zip(bounds[:-1], bounds[1:])])
                for x, y in zip(*sets):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def confirm_links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets of shingles; texts by node."""
    return _attach(pairs, texts).mapInArrow(_confirm(width, percent), "a long, b long")


def _open_lists(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the lists that still hold more than one component.

    The largest component of a list needs no comparison within itself, so only each
    other member (``open``) meets all members, in blocks of BLOCK rows.
    """
    placed = postings.join(labels, "node", "left").select(
        "value", "node", F.coalesce("component", "node").alias("component")
    )
    sizes = placed.groupBy("value", "component").agg(F.count("*").alias("n"))
    lists = sizes.groupBy("value").agg(
        F.sum("n").alias("members"),
        F.count("*").alias("parts"),
        F.max(F.struct("n", "component")).alias("largest"),
    )
    lists = lists.filter("parts > 1").select(
        "value",
        F.col("largest.component").alias("main"),
        "members",
        F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("members") - F.col("largest.n")) / BLOCK).cast("int").alias("open_blocks"),
    )
    return placed.join(lists, "value").select(
        "value",
        "node",
        "component",
        (F.col("component") != F.col("main")).alias("open"),
        "members",
        "blocks",
        "open_blocks",
    )


def _short_pairs(members: DataFrame) -> DataFrame:
    """Pairs of different components within short lists."""
    short = members.filter(F.col("members") <= SHORT).select("value", "node", "component", "open")
    left = short.filter("open").toDF("value", "left", "left_home", "left_open")
    right = short.toDF("value", "right", "right_home", "right_open")
    found = left.join(right, "value").filter("left_home <> right_home")
    return found.select(
        F.greatest("left", "right").alias("a"), F.least("left", "right").alias("b")
    ).distinct()


def _long_pairs(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Likewise for long lists: blocks of open members meet blocks of all members.

    A member is sent once for each block of open members, an open one also once for
    each block of members: with few open ones, each member moves once.
    """
    long = members.filter(F.col("members") > SHORT)

    def dealt(rows: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("node", "value"), F.col(f"{own}s")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
        return rows.select("value", block, every, "node", "component", F.lit(asks).alias("asks"))

    parts = dealt(long, "block", "open_block", False).unionByName(
        dealt(long.filter("open"), "open_block", "block", True)
    )
    parts = parts.join(classes.select("node", "sketch", "n_shingles"), "node")
    found = parts.groupBy("value", "block", "open_block").applyInPandas(_compare(threshold), "a long, b long")
    return found.distinct()


def common_values(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each of the ``left`` sets shares with each of the ``right`` ones.

    Values that few rows have are counted pair by pair, the others by a product of
    marks in slabs of columns, so memory follows the result, not the number of values.
    """
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    here = owner < len(left)
    n_values = int(codes.max()) + 1 if len(codes) else 0
    ask, told = np.bincount(codes[here], minlength=n_values), np.bincount(codes[~here], minlength=n_values)
    shared = np.zeros(len(left) * len(right), np.int32)
    dense = np.maximum(ask, told) > DENSE
    dense &= (ask > 0) & (told > 0)
    sparse = (ask > 0) & (told > 0) & ~dense

    def entries(side: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine = np.flatnonzero(side & wanted[codes])
        mine = mine[np.argsort(codes[mine], kind="stable")]
        return owner[mine] - (0 if side is here else len(left)), codes[mine]

    rows, own = entries(here, sparse)
    columns, their = entries(~here, sparse)
    starts = np.searchsorted(their, own)
    counts = told[own]
    ends = np.cumsum(counts)
    first = 0
    while first < len(rows):
        # So many pairs at a time.
        stop = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 20), "right")))
        some = counts[first:stop]
        before = np.cumsum(some) - some
        at = np.repeat(starts[first:stop] - before, some) + np.arange(some.sum())
        places = np.repeat(rows[first:stop], some) * len(right) + columns[at]
        np.add.at(shared, places, 1)
        first = stop
    shared = shared.reshape(len(left), len(right))
    number = np.cumsum(dense) - 1
    rows, own = entries(here, dense)
    columns, their = entries(~here, dense)
    for low in range(0, int(dense.sum()), 1024):
        marks = []
        for count, at, value in ((len(left), rows, number[own]), (len(right), columns, number[their])):
            slab = np.zeros((count, 1024), np.float32)
            inside = (value >= low) & (value < low + 1024)
            slab[at[inside], value[inside] - low] = 1
            marks.append(slab)
        shared += (marks[0] @ marks[1].T).astype(np.int32)
    return shared


def _compare(threshold: float):
    """Pairs of an asking row and another of a different component that may be similar."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        asks = part["asks"].to_numpy(bool)
        ids, home, sizes = (part[c].to_numpy() for c in ("node", "component", "n_shingles"))
        sketches = [np.asarray(s) for s in part["sketch"]]
        found = set()
        others = np.flatnonzero(~asks)
        rows = np.flatnonzero(asks)
        for first in range(0, len(rows) if len(others) else 0, 256):
            some = rows[first : first + 256]
            shared = common_values([sketches[i] for i in some], [sketches[i] for i in others])
            both = sizes[some][:, None] + sizes[others][None, :]
            larger = np.maximum(sizes[some][:, None], sizes[others][None, :])
            # Common values lie below the lower of both limits, so they stand for
            # as many more as the larger set has values to one of its sketch.
            common = shared * np.maximum(1.0, larger / SKETCH)
            similar = common / np.maximum(both - common, 1)
            maybe = similar >= threshold - 2 * slack(both, threshold)
            maybe &= home[some][:, None] != home[others][None, :]
            for i, j in zip(*np.nonzero(maybe)):
                left, right = some[i], others[j]
                chance = slack(sizes[left] + sizes[right], threshold)
                if estimate(sketches[left], sketches[right]) >= threshold - chance:
                    found.add((max(ids[left], ids[right]), min(ids[left], ids[right])))
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    width: int = WIDTH,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but ``[\\x20\\x09-\\x0D]``, A-Z lower-cased. Two texts
    are linked if 100 * common >= percent * union over their sets of ``width``-word
    shingles; a text with fewer words has the whole sequence as its one shingle.
    ``component_id`` is the smallest id reachable by links, itself included; ``kept``
    says whether it is the row's own.

    Null and empty texts, and texts without words, have no shingles and link with
    nothing. Equal sets are one node, whatever their number. Every text of an id
    that repeats is compared, and the id reaches what any of its texts does. A text without an
    id links like others; its component is null if no id is in it. An empty table gives
    no rows; other columns are ignored. Very long texts are shingled whole, one at a time.

    Each list of the index costs one row per member in the first pass. Texts
    move only if they share a listed value with another one.
    """
    found = _groups(docs, id_col, text_col, percent, width)
    component = F.col("component_id")
    found = found.select(
        "doc_id", "n_shingles", component, F.col("doc_id").eqNullSafe(component).alias("kept")
    )
    homes = found.filter("doc_id IS NOT NULL AND component_id IS NOT NULL").select("doc_id", "component_id")
    ids = homes.groupBy("doc_id").agg(F.min("component_id").alias("least"), F.max("component_id").alias("most"))
    if ids.filter("least <> most").isEmpty():
        return found
    # An id that repeats ties the components of its texts.
    tied = materialize(components(homes, "doc_id", "component_id").toDF("component_id", "tied"), "tied-ids")
    joined = found.join(tied, "component_id", "left")
    component = F.coalesce("tied", "component_id")
    kept = F.col("doc_id").eqNullSafe(component).alias("kept")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept)


@contained("near-groups")
def _groups(docs: DataFrame, id_col: str, text_col: str, percent: int, width: int) -> DataFrame:
    """Per row doc_id, mark, n_shingles, component_id, and ``stays``: whether its mark is that
    of its component's first row. Ids that repeat are not tied."""
    threshold = percent / 100
    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"),
        column(text_col).alias("text"),
        mark(id_col, text_col).alias("mark"),
    )
    sketched = materialize(rows.mapInArrow(_sketch(width, SKETCH), _SKETCHED), "sketches")
    sets = sketched.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("first"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"),
    )
    # Nodes are numbered in the order of their first rows, so the smallest has the smallest id.
    order = ["first", "digest"]
    sets = sets.repartitionByRange(*order).sortWithinPartitions(*order)
    sets = sets.withColumn("node", F.monotonically_increasing_id())
    classes = materialize(sets.select("node", "digest", "first.doc_id", "first.mark", "n_shingles", "sketch"), "classes")
    postings = materialize(_postings(classes), "postings")
    shared = postings.groupBy("value").count().filter("count > 1").select("value")
    met = postings.join(shared, "value", "left_semi").select("node").distinct()
    # Only texts that share a listed value with another one are ever compared.
    met = materialize(classes.select("node", "mark").join(met, "node"), "met")
    texts = rows.select("mark", "text").join(met, "mark").select("node", "text")
    again = sketched.groupBy("mark").count().filter("count > 1").join(met, "mark", "left_semi")
    if not again.isEmpty():
        # Rows that repeat id and text are one node's, so one of them is enough.
        texts = texts.dropDuplicates(["node"])
    texts = materialize(texts, "met-texts")

    stars = materialize(_stars(postings), "stars")
    stars = materialize(_promising(stars, classes, threshold), "star-pairs")
    links = materialize(confirm_links(stars, texts, width, percent), "star-links")
    labels = materialize(components(links, "a", "b").toDF("node", "component"), "labels")

    members = materialize(_open_lists(postings, labels), "open-lists")
    short = materialize(_short_pairs(members), "short-pairs")
    rest = _promising(short, classes, threshold)
    rest = rest.union(_long_pairs(members, classes, threshold)).distinct()
    rest = materialize(rest.join(stars, ["a", "b"], "left_anti"), "open-pairs")
    more = materialize(confirm_links(rest, texts, width, percent), "open-links")
    labels = materialize(components(links.union(more), "a", "b").toDF("node", "component"), "labels")

    roots = classes.select(F.col("node").alias("component"), F.col("doc_id").alias("root_id"), F.col("mark").alias("root"))
    named = classes.select("digest", "node").join(labels, "node", "left")
    named = named.select("digest", F.coalesce("component", "node").alias("component")).join(roots, "component")
    placed = sketched.drop("sketch").join(materialize(named.drop("component"), "homes"), "digest", "left")
    return placed.select(
        "doc_id",
        "mark",
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("root_id")).alias("component_id"),
        F.coalesce(F.col("mark") == F.col("root"), F.lit(True)).alias("stays"),
    )


def keep_near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    width: int = WIDTH,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of linked
    texts, whatever its id, the one with the smallest id if there is one."""
    groups = _groups(docs, id_col, text_col, percent, width).filter("n_shingles > 0").select("mark", "stays")
    groups = materialize(groups, "near-copies")
    alike = groups.filter("stays").groupBy("mark").count().filter("count > 1").select("mark")
    return keep_one(docs, id_col, text_col, groups.filter("NOT stays").select("mark"), alike)
