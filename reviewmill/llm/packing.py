"""Best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.texts import slices
from reviewmill.llm.tokens import ENCODED_BYTES, encoder
from reviewmill.session import materialize

_PIECE = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, part int, place long"
)


def _pieces(vocabulary: str, space_led: bool, end_id: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, space_led).encode
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for some in slices(batch, "text", ENCODED_BYTES):
                rows = []
                for doc_id, own in zip(some.column("doc_id").to_pylist(), encode(some.column("text"))):
                    ids = np.append(own, np.uint32(end_id)).astype("<u4")
                    start, piece = 0, 0
                    while start < len(ids):
                        length = (len(ids) - start) % size or size
                        crc = zlib.crc32(ids[start : start + length])
                        rows.append((doc_id, piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                        start, piece = start + length, piece + 1
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                names = "doc_id piece start length ids_crc32 part place".split()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names
                )

    return cut


def plan_bins(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Patterns (how many sequences, their lengths) that use up ``counts`` by length.

    Best-two-fit: a sequence takes the longest document that still fits until
    none does. Then its smallest document is given back if two unpacked
    ones fill the gap so expanded more tightly; of all such pairs the tightest
    is taken. Every sequence that comes out alike is planned at once, so the
    work follows the number of distinct lengths, not of documents.
    """
    left = np.zeros(size + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return plan
        used: dict[int, int] = {}
        gap = size
        top = len(lengths) - 1
        while gap and top >= 0:
            top = min(top, int(np.searchsorted(lengths, gap, "right")) - 1)
            if top < 0:
                break
            length = int(lengths[top])
            take = min(gap // length, int(left[length]))
            used[length] = take
            gap -= take * length
            top -= 1
        if gap and len(used) + max(used.values()) > 2:
            smallest = min(used)
            best = _tightest_pair(left, lengths, used, gap + smallest)
            if best and sum(best) > smallest:
                used[smallest] -= 1
                for length in best:
                    used[length] = used.get(length, 0) + 1
        used = {length: n for length, n in used.items() if n}
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= times * n
        plan.append((times, [x for length in sorted(used, reverse=True) for x in [length] * used[length]]))


def _tightest_pair(left, lengths, used: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum within ``room``."""
    free = left[lengths].copy()
    for length, n in used.items():
        free[np.searchsorted(lengths, length)] -= n
    some = lengths[free > 0]
    twice = {int(x) for x in lengths[free > 1]}
    best, pair = 0, None
    low, high = 0, len(some) - 1
    while low <= high:
        a, b = int(some[low]), int(some[high])
        if a + b > room or (low == high and a not in twice):
            high -= 1
            continue
        if a + b > best:
            best, pair = a + b, (a, b)
        low += 1
    return pair


def pack(
    docs: DataFrame,
    vocabulary: str,
    space_led: bool,
    end_id: int,
    size: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each document is its ids and the end id. One longer than ``size`` is cut
    into pieces of ``size``; the first may be shorter. Null and empty texts are
    the end id alone; rows that repeat an id, or have none, are packed like others.
    An empty table gives no rows.

    Ids never leave the task that makes them. The plan is made on the driver
    from the number of pieces of each length, at most ``size`` numbers at any
    volume. A piece finds its place by its rank among those of its length.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_pieces(vocabulary, space_led, end_id, size), _PIECE)
    pieces = materialize(found, "pieces")
    per_part = materialize(pieces.groupBy("length", "part").count(), "piece-counts")
    counts = {r[0]: r[1] for r in per_part.groupBy("length").agg(F.sum("count")).collect()}

    slots, first_sequence, given = [], 0, dict.fromkeys(counts, 0)
    for times, lengths in plan_bins(counts, size):
        offset = 0
        for length in dict.fromkeys(lengths):
            n = lengths.count(length)
            slots.append((length, given[length], n, first_sequence, offset))
            given[length] += times * n
            offset += n * length
        first_sequence += times
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per length and input task; only counts are summed here.
    ranks = per_part.select(
        "length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    ranked = pieces.join(ranks, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank")
    )
    return ranked.mapInArrow(
        _seats(sorted(slots)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def _seats(slots: list[tuple[int, int, int, int, int]]):
    """Places for pieces; ``slots`` has length, first rank, pieces a sequence,
    first sequence and offset, and is as long as the plan."""
    length, first, each, sequence, at = np.array(slots or [(0,) * 5], np.int64).T
    keys = (length << 48) + first

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {n: batch.column(n) for n in batch.schema.names}
            lengths = own["length"].to_numpy().astype(np.int64)
            ranks = own["rank"].to_numpy()
            slot = np.searchsorted(keys, (lengths << 48) + ranks, "right") - 1
            inside = ranks - first[slot]
            places = {
                "length": lengths,
                "sequence_id": sequence[slot] + inside // each[slot],
                "offset": at[slot] + inside % each[slot] * lengths,
            }
            names = "doc_id piece start length ids_crc32 sequence_id offset".split()
            columns = [pa.array(places[n]) if n in places else own[n] for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return seat
