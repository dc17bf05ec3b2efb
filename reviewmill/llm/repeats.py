"""Removal of repeated byte strings by column-wise suffix ordering.

A string of LENGTH bytes has one anchor: its K-byte substring with the least hash,
the leftmost of equals. Equal strings have equal anchors at equal offsets, so only
strings around equal anchors need comparing, and most anchors occur once.
Around anchors that occur again, the surroundings form a collection that is
ordered column by column from the right: each round puts one more symbol in
front of every member, updating the order of the collection (its Burrows-
Wheeler transform for that column) and the common prefixes of neighbours.
Runs of common prefixes of LENGTH symbols are equal strings; all but the earliest
are removed. An anchor with more than MEMBERS different surroundings is split:
each string around it is dealt by its own digest, so no task gets all members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.texts import flat, mix, prefix_sums, range_hashes, slices, window_hashes
from reviewmill.session import materialize

LENGTH = 100
K = 32
SPAN = LENGTH - K  # an anchor's place in its string is 0 to SPAN
# Text bytes for each bucket of anchors or of documents.
BUCKET_BYTES = 8 << 20
# Members of one anchor that are ordered in one task; buckets with more than CROWDED
# anchors are searched for larger ones before they are dealt.
MEMBERS, CROWDED = 8192, 1 << 20
# Strings of split anchors for each of their buckets.
BUCKET_STRINGS = 1 << 19
# Low bits of a key hold a place in a slice of texts, the high bits the hash.
_PLACE_BITS = 28
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)

_ANCHOR = np.dtype([("hash", "<u4"), ("region", "<u8"), ("doc", "<i8"), ("twin", "<i4"), ("low", "<i4"), ("high", "<i4"), ("at", "u1")])
_RANGE = np.dtype([("doc", "<i8"), ("twin", "<i4"), ("low", "<i4"), ("high", "<i4")])
_REQUEST = np.dtype([("hash", "<u4"), ("doc", "<i8"), ("twin", "<i4"), ("low", "<i4"), ("high", "<i4"), ("at", "u1"), ("bucket", "<i4")])
_STRING = np.dtype([("digest", "<u8"), ("check", "<u8"), ("doc", "<i8"), ("twin", "<i4"), ("low", "<i4")])


def _packed(records: np.ndarray) -> bytes:
    """Field after field, which compresses better than row after row."""
    return b"".join(np.ascontiguousarray(records[n]).tobytes() for n in records.dtype.names)


def _unpacked(blobs, dtype: np.dtype) -> np.ndarray:
    parts = []
    for blob in blobs:
        count, start = len(blob) // dtype.itemsize, 0
        part = np.empty(count, dtype)
        for name in dtype.names:
            kind = dtype[name]
            part[name] = np.frombuffer(blob, kind, count, start)
            start += count * kind.itemsize
        parts.append(part)
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _dealt(records: np.ndarray, buckets: np.ndarray):
    """(bucket, packed records) for each bucket that has any."""
    order = np.argsort(buckets, kind="stable")
    records, buckets = records[order], buckets[order]
    firsts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else []
    for first, last in zip(firsts, [*firsts[1:], len(buckets)]):
        yield int(buckets[first]), _packed(records[first:last])


def _doc_bucket(records: np.ndarray, count: int) -> np.ndarray:
    return (mix(records["doc"].astype(np.uint64)) % np.uint64(count)).astype(np.int64)


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of all anchors with the first and last start of the strings they serve."""
    nothing = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return nothing, nothing, nothing, np.zeros(0, np.uint64), nothing
    if len(data) > 1 << _PLACE_BITS:
        raise ValueError("a text of more than 256 MB")
    sums = prefix_sums(data)
    hashes = window_hashes(sums, K)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least, width = keys, 1
    while 2 * width <= SPAN + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    # Strings may not cross from one text to the next.
    inside = np.zeros(len(data) + 1, np.int8)
    long = bounds[1:] - bounds[:-1] >= LENGTH
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, bounds[1:][long] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[: len(least)])
    places = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = places[1:] != places[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    at, low, high = places[first], starts[first], starts[last]
    regions = mix(range_hashes(sums, low, high + LENGTH) + (at - low).astype(np.uint64))
    return at, low, high, hashes[at], regions


def _find_anchors(buckets: int):
    """Anchors by bucket; copies of a region within one slice are settled at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = flat(part.column("text"))
                at, low, high, hashes, regions = anchors(data, bounds)
                text = np.searchsorted(bounds, low, "right") - 1
                keys = part.column("key").to_numpy(zero_copy_only=False)
                twins = part.column("twin").to_numpy(zero_copy_only=False)
                found = np.empty(len(at), _ANCHOR)
                found["hash"] = (hashes >> np.uint64(32)).astype(np.uint32)
                found["region"], found["at"] = regions, at - low
                found["doc"], found["twin"] = keys[text], twins[text]
                found["low"], found["high"] = low - bounds[text], high - bounds[text]
                order = np.lexsort((found["low"], found["twin"], found["doc"], found["region"]))
                found, hashes = found[order], hashes[order]
                again = np.zeros(len(found), bool)
                again[1:] = found["region"][1:] == found["region"][:-1]
                rows = [("anchors", b, x) for b, x in _dealt(found[~again], (hashes[~again] % np.uint64(buckets)).astype(np.int64))]
                gone = np.empty(int(again.sum()), _RANGE)
                for name in _RANGE.names:
                    gone[name] = found[name][again]
                rows += [("gone", b, x) for b, x in _dealt(gone, _doc_bucket(gone, buckets))]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(("kind", "bucket", "packed"), r)) for r in rows], _PACKED)

    return run


_PACKED = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("packed", pa.binary())])
_PACKED_DDL = "kind string, bucket int, packed binary"


def _requests(found: np.ndarray, bucket: int) -> np.ndarray:
    asked = np.empty(len(found), _REQUEST)
    for name in _REQUEST.names:
        asked[name] = bucket if name == "bucket" else found[name]
    return asked


def _count_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
            hashes, counts = np.unique(_unpacked([blob], _ANCHOR)["hash"], return_counts=True)
            columns = [np.full(len(hashes), bucket, np.int64), hashes.astype(np.int64), counts.astype(np.int64)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["bucket", "hash", "members"])


def _large_anchors(found: DataFrame, members: int, crowded: int) -> dict[int, np.ndarray]:
    """Hashes with more than ``members`` members, by bucket, where a bucket is crowded."""
    weight = F.sum(F.octet_length("packed")) / _ANCHOR.itemsize
    full = [r[0] for r in found.groupBy("bucket").agg(weight.alias("n")).filter(F.col("n") > crowded).collect()]
    if not full:
        return {}
    counts = found.filter(F.col("bucket").isin(full)).select("bucket", "packed")
    counts = counts.mapInArrow(_count_members, "bucket long, hash long, members long")
    large = counts.groupBy("bucket", "hash").agg(F.sum("members").alias("n")).filter(F.col("n") > members)
    return {int(b): x["hash"].to_numpy(np.uint32) for b, x in large.select("bucket", "hash").toPandas().groupby("bucket")}


def _part(large: dict[int, np.ndarray], buckets: int, split: bool):
    """Requests for the members of large anchors, or the anchors without these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
                if bucket not in large:
                    rows += [] if split else [("anchors", bucket, blob)]
                    continue
                found = _unpacked([blob], _ANCHOR)
                own = np.isin(found["hash"], large[bucket])
                if split:
                    asked = _requests(found[own], bucket)
                    rows += [("split", b, x) for b, x in _dealt(asked, _doc_bucket(asked, buckets))]
                elif not own.all():
                    rows.append(("anchors", bucket, _packed(found[~own])))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(("kind", "bucket", "packed"), r)) for r in rows], _PACKED)

    return run


def _settle(buckets: int, members: int = MEMBERS):
    """Which regions occurred before as a whole, and which need a closer look."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = int(rows["bucket"].iat[0])
        a = _unpacked(rows["packed"], _ANCHOR)
        a = a[np.lexsort((a["low"], a["twin"], a["doc"], a["region"], a["hash"]))]
        same_hash = np.concatenate([[False], a["hash"][1:] == a["hash"][:-1]])
        again = same_hash & np.concatenate([[False], a["region"][1:] == a["region"][:-1]])
        # The first of each region, where its anchor has other regions too.
        group = np.cumsum(~same_hash) - 1
        regions = np.bincount(group, ~again)
        look = ~again & (regions[group] > 1)
        gone = np.empty(int(again.sum()), _RANGE)
        for name in _RANGE.names:
            gone[name] = a[name][again]
        large = regions[group] > members
        out = [("gone", b, x) for b, x in _dealt(gone, _doc_bucket(gone, buckets))]
        for kind, chosen in (("asked", look & ~large), ("split", look & large)):
            asked = _requests(a[chosen], own)
            out += [(kind, b, x) for b, x in _dealt(asked, _doc_bucket(asked, buckets))]
        return pd.DataFrame(out, columns=["kind", "bucket", "packed"])

    return run


def _surroundings(buckets: int, strings: int):
    """The bytes of every region asked for, one row per bucket of anchors; of split
    anchors the strings, one row per bucket of strings."""

    def run(texts: pd.DataFrame, requests: pd.DataFrame) -> pd.DataFrame:
        out = []
        columns = ["kind", "bucket", "packed", "bytes"]
        if not len(requests) or not len(texts):
            return pd.DataFrame(out, columns=columns)
        place = {(k, t): x for k, t, x in zip(texts["key"], texts["twin"], texts["text"])}
        encoded: dict[tuple[int, int], bytes] = {}

        def text_of(r) -> bytes:
            key = (int(r["doc"]), int(r["twin"]))
            if key not in encoded:
                encoded[key] = place[key].encode()
            return encoded[key]

        asked = _unpacked(requests["packed"][requests["kind"] == "asked"], _REQUEST)
        asked = asked[np.lexsort((asked["low"], asked["twin"], asked["doc"], asked["bucket"]))]
        bounds = np.flatnonzero(np.concatenate([[True], asked["bucket"][1:] != asked["bucket"][:-1]])) if len(asked) else []
        for first, last in zip(bounds, [*bounds[1:], len(asked)]):
            part = asked[first:last]
            pieces = [text_of(r)[r["low"] : r["high"] + LENGTH] for r in part]
            out.append(("asked", int(part["bucket"][0]), _packed(part), b"".join(pieces)))
        split = _unpacked(requests["packed"][requests["kind"] == "split"], _REQUEST)
        if len(split):
            found, gone = _earliest(_strings(split, text_of))
            dealt = (mix(found["digest"]) % np.uint64(strings)).astype(np.int64) + buckets
            out += [("strings", b, x, b"") for b, x in _dealt(found, dealt)]
            out += [("gone", b, x, b"") for b, x in _dealt(gone, _doc_bucket(gone, buckets))]
        return pd.DataFrame(out, columns=columns)

    return run


def _strings(split: np.ndarray, text_of) -> np.ndarray:
    """Every string that the anchors serve, by a digest of 128 bits."""
    digests = bytearray()
    for r in split:
        text = text_of(r)
        for low in range(r["low"], r["high"] + 1):
            digests += hashlib.blake2b(text[low : low + LENGTH], digest_size=16).digest()
    counts = (split["high"] - split["low"] + 1).astype(np.int64)
    out = np.empty(int(counts.sum()), _STRING)
    out["digest"], out["check"] = np.frombuffer(digests, "<u8").reshape(-1, 2).T
    out["doc"], out["twin"] = np.repeat(split["doc"], counts), np.repeat(split["twin"], counts)
    inner = np.arange(len(out)) - np.repeat(np.cumsum(counts) - counts, counts)
    out["low"] = np.repeat(split["low"], counts) + inner
    return out


def _earliest(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of each string, and the ranges of all others."""
    found = found[np.lexsort((found["low"], found["twin"], found["doc"], found["check"], found["digest"]))]
    again = np.zeros(len(found), bool)
    again[1:] = (found["digest"][1:] == found["digest"][:-1]) & (found["check"][1:] == found["check"][:-1])
    later = found[again]
    later = later[np.lexsort((later["low"], later["twin"], later["doc"]))]
    new = np.ones(len(later), bool)
    new[1:] = (
        (later["doc"][1:] != later["doc"][:-1])
        | (later["twin"][1:] != later["twin"][:-1])
        | (later["low"][1:] != later["low"][:-1] + 1)
    )
    first = np.flatnonzero(new)
    gone = np.empty(len(first), _RANGE)
    gone["doc"], gone["twin"], gone["low"] = later["doc"][first], later["twin"][first], later["low"][first]
    gone["high"] = later["low"][np.concatenate([first[1:], [len(later)]]) - 1] if len(first) else 0
    return found[~again], gone


def column_orders(table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Orders a collection column by column, from the last to the first.

    ``table`` has a member per row and a symbol per column; symbols above 255
    equal nothing. Yields (column, order, common): members in the order of
    what begins at that column, and how many symbols each shares with its predecessor.
    """
    members, columns = table.shape
    order = np.arange(members)
    common = np.zeros(members, np.int32)
    for column in range(columns - 1, -1, -1):
        symbols = table[order, column]
        moved = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[moved]
        fresh = np.zeros(members, np.int32)
        same = np.flatnonzero((sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] < 256)) + 1
        # Two members with a new symbol in common share it and the least that
        # lay between them before.
        fresh[same] = 1 + _least_between(common, moved[same - 1] + 1, moved[same] + 1)
        order, common = order[moved], fresh
        yield column, order, common


def _least_between(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The minimum of values[first:stop] for many non-empty ranges."""
    if not len(first):
        return np.zeros(0, values.dtype)
    level = np.frexp((stop - first).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    table = values
    for step in range(int(level.max()) + 1):
        if step:
            half = 1 << (step - 1)
            table = np.minimum(table[:-half], table[half:])
        here = level == step
        out[here] = np.minimum(table[first[here]], table[stop[here] - (1 << step)])
    return out


def _compare(buckets: int):
    """Strings of the regions of one bucket, or of one bucket of strings, that occurred before."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        passed = [("gone", int(b), x) for k, b, x in zip(rows["kind"], rows["bucket"], rows["packed"]) if k == "gone"]
        strings = _unpacked(rows["packed"][rows["kind"] == "strings"], _STRING)
        rows = rows[rows["kind"] == "asked"]
        asked = _unpacked(rows["packed"], _REQUEST)
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        sizes = (asked["high"] - asked["low"] + LENGTH).astype(np.int64)
        ends = np.cumsum(sizes)
        out = []
        order = np.argsort(asked["hash"], kind="stable")
        # Members around one anchor stay together; pieces of some thousand members.
        hashes = asked["hash"][order]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(order) else []
        cuts = [0] if len(order) else []
        for s in starts[1:]:
            if s - cuts[-1] >= 8192:
                cuts.append(int(s))
        for first, last in zip(cuts, [*cuts[1:], len(order)]):
            part = order[first:last]
            out.append(_repeated(asked[part], data, (ends - sizes)[part], sizes[part]))
        out.append(_earliest(strings)[1])
        gone = np.concatenate(out)
        return pd.DataFrame(
            passed + [("gone", b, x) for b, x in _dealt(gone, _doc_bucket(gone, buckets))],
            columns=["kind", "bucket", "packed"],
        )

    return run


def _repeated(asked: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    members = len(asked)
    table = np.full((members, SPAN + LENGTH), 256, np.uint16)
    shift = SPAN - asked["at"].astype(np.int64)
    row = np.repeat(np.arange(members), sizes)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[row, inner + np.repeat(shift, sizes)] = data[inner + np.repeat(starts, sizes)]
    age = np.empty(members, np.int64)
    age[np.lexsort((asked["low"], asked["twin"], asked["doc"]))] = np.arange(members)
    gone = np.zeros((members, SPAN + 2), bool)
    for column, order, common in column_orders(table):
        if column > SPAN:
            continue
        run = np.flatnonzero(common < LENGTH)
        oldest = np.minimum.reduceat(age[order], run)
        lengths = np.diff(np.concatenate([run, [members]]))
        later = age[order] > np.repeat(oldest, lengths)
        gone[order[later], column] = True
    edges = np.diff(gone.astype(np.int8), axis=1, prepend=0)
    who, first = np.nonzero(edges == 1)
    _, stop = np.nonzero(edges == -1)
    out = np.empty(len(who), _RANGE)
    out["doc"], out["twin"] = asked["doc"][who], asked["twin"][who]
    base = asked["low"][who].astype(np.int64) - shift[who]
    out["low"], out["high"] = base + first, base + stop - 1
    return out


def _remove(texts: pd.DataFrame, removed: pd.DataFrame) -> pd.DataFrame:
    """The result row of every text of a bucket."""
    gone = _unpacked(removed["packed"], _RANGE)
    gone = gone[np.lexsort((gone["low"], gone["twin"], gone["doc"]))]
    owners: dict[tuple[int, int], list] = {}
    new = np.ones(len(gone), bool)
    new[1:] = (gone["doc"][1:] != gone["doc"][:-1]) | (gone["twin"][1:] != gone["twin"][:-1])
    firsts = np.flatnonzero(new)
    for first, last in zip(firsts, [*firsts[1:], len(gone)]):
        owners[(int(gone["doc"][first]), int(gone["twin"][first]))] = (first, last)
    out = []
    for doc_id, key, twin, copies, text in zip(
        texts["doc_id"], texts["key"], texts["twin"], texts["copies"], texts["text"]
    ):
        data = text.encode()
        kept, spans, n_removed = data, 0, 0
        if (key, twin) in owners:
            first, last = owners[(key, twin)]
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, gone["low"][first:last], 1)
            np.add.at(edge, gone["high"][first:last] + LENGTH, -1)
            cover = np.cumsum(edge[:-1]) > 0
            n_removed = int(cover.sum())
            spans = int(np.count_nonzero(cover[1:] & ~cover[:-1])) + int(cover[0])
            kept = np.frombuffer(data, np.uint8)[~cover].tobytes()
        digest = hashlib.sha256(kept).hexdigest()
        out += [(doc_id, len(data), n_removed, spans, digest)] * int(copies)
    frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return frame.astype({"doc_id": "Int64"})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte is removed that is covered by a string of LENGTH bytes which also starts
    earlier: in a smaller id, or earlier in the same text. Strings are judged on
    the input; matches do not cross texts. The digest is of what remains.

    Null counts as empty; texts below LENGTH bytes stay whole. Rows that repeat an id
    with different texts are ordered among themselves by a hash of the text,
    rows that repeat both are one document with as many result rows. Rows
    without an id come before all others. An empty table gives no rows.

    Tasks get buckets of anchors or documents in packed form, dealt by hash, of
    about BUCKET_BYTES of text each. Copies of a region are settled where
    they are found, so a passage in a third of all texts reaches a bucket once
    per slice of texts. Around its edges the texts differ: anchors with more than MEMBERS
    different regions are split into their strings, dealt by a digest of 128 bits, of which
    each bucket of documents sends its earliest only.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    size = rows.agg(
        F.sum(F.octet_length("text")), F.count("*"), F.count_distinct("key"), F.count("doc_id")
    ).first()
    if size[1] == size[2] and size[1] == size[3]:
        rows = rows.withColumn("copies", F.lit(1).cast("long")).withColumn("twin", F.lit(0))
    else:
        rows = rows.groupBy("doc_id", "key", "text").agg(F.count("*").alias("copies"))
        twins = Window.partitionBy("key").orderBy(F.xxhash64("text"), "text")
        rows = rows.withColumn("twin", F.row_number().over(twins) - 1)
        rows = materialize(rows, "repeat-rows")
    buckets = max(16, (size[0] or 0) // BUCKET_BYTES + 1)

    found = rows.select("key", "twin", "text").mapInArrow(_find_anchors(buckets), _PACKED_DDL)
    found = materialize(found, "anchors")
    anchored = found.filter("kind = 'anchors'")
    large = _large_anchors(anchored, MEMBERS, CROWDED)
    small = anchored.mapInArrow(_part(large, buckets, False), _PACKED_DDL) if large else anchored
    settled = small.groupBy("bucket").applyInPandas(_settle(buckets, MEMBERS), _PACKED_DDL)
    settled = materialize(settled, "settled")
    asked = settled.filter("kind IN ('asked', 'split')")
    if large:
        asked = asked.union(anchored.mapInArrow(_part(large, buckets, True), _PACKED_DDL))
    split = asked.filter("kind = 'split'").agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    strings = split // _REQUEST.itemsize * (SPAN + 1) // BUCKET_STRINGS + 1

    texts = rows.mapInArrow(_bucketed(buckets), "doc_id long, key long, twin int, copies long, text string, bucket int")
    regions = (
        texts.groupBy("bucket")
        .cogroup(asked.groupBy("bucket"))
        .applyInPandas(_surroundings(buckets, strings), "kind string, bucket int, packed binary, bytes binary")
    )
    compared = materialize(
        regions.groupBy("bucket").applyInPandas(_compare(buckets), _PACKED_DDL), "compared"
    )
    gone = (
        found.filter("kind = 'gone'")
        .union(settled.filter("kind = 'gone'"))
        .union(compared)
        .select("bucket", "packed")
    )
    return (
        texts.groupBy("bucket")
        .cogroup(gone.groupBy("bucket"))
        .applyInPandas(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )


def _bucketed(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            own = (mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("doc_id", "key", "twin", "copies", "text")], pa.array(own)],
                ["doc_id", "key", "twin", "copies", "text", "bucket"],
            )

    return run
