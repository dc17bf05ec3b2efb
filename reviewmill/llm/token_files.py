"""Token files: concatenated ids with Elias-Fano coded document boundaries.

A file is Parquet with one row per block: ids as little-endian 16- or 32-bit
integers, and two Elias-Fano sequences (low bits packed, high bits in unary, every
256th set bit sampled for select): the boundaries of its documents, and their
ascending ids less the first one. Readers take any boundary or id, or a run, by select. A
block holds whole documents, BLOCK_IDS ids or one longer document. The folder
also has a small ``parts`` table with the ids before each part, so offsets in
the whole file need no 64-bit table of documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm.texts import slices
from reviewmill.llm.tokens import ENCODED_BYTES, encoder

BLOCK_IDS = 1 << 20
SAMPLE = 256
# Values that a reader of all documents selects at once.
_RUN = 16 * SAMPLE

_CODE = "struct<count: int, width: int, low: binary, high: binary, samples: binary>"
# ``nameless`` documents without an id come first in a block.
BLOCK = (
    "part int, block int, first_id long, n_ids long, n_docs int, id_bytes int, ids binary, "
    f"bounds {_CODE}, nameless int, first_doc long, docs {_CODE}"
)
_DOCUMENT = "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(largest / length) bits a value."""

    def __init__(self, count: int, width: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.width = count, width
        self._low, self._high, self._samples = low, high, np.frombuffer(samples, "<u4")

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        count = len(values)
        per = int(values[-1]) // count if count else 0
        width = max(0, per.bit_length() - 1)
        shifts = np.arange(width, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
        bits = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        bits[ones] = 1
        return cls(
            count,
            width,
            np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(bits, bitorder="little").tobytes(),
            ones[::SAMPLE].astype("<u4").tobytes(),
        )

    def parts(self) -> tuple[bytes, bytes, bytes]:
        return self._low, self._high, self._samples.tobytes()

    def _low_bits(self, first: int, count: int) -> np.ndarray:
        if not self.width:
            return np.zeros(count, np.uint64)
        start, stop = first * self.width, (first + count) * self.width
        raw = np.frombuffer(self._low, np.uint8)[start // 8 : (stop + 7) // 8]
        bits = np.unpackbits(raw, bitorder="little")[start % 8 :][: stop - start]
        return bits.reshape(count, self.width).astype(np.uint64) @ (np.uint64(1) << np.arange(self.width, dtype=np.uint64))

    def select(self, i: int) -> int:
        """The i-th value: only bits between two sampled ones are looked at."""
        near, before = divmod(i, SAMPLE)
        place = int(self._samples[near])
        stop = int(self._samples[near + 1]) // 8 + 1 if near + 1 < len(self._samples) else None
        high = np.frombuffer(self._high, np.uint8)[place // 8 : stop]
        counts = np.cumsum(np.bitwise_count(high), dtype=np.int64)
        target = before + int(bin(int(high[0]) & ((1 << place % 8) - 1)).count("1"))
        byte = int(np.searchsorted(counts, target, "right"))
        inside = target - (int(counts[byte - 1]) if byte else 0)
        bit = int(np.flatnonzero(np.unpackbits(high[byte : byte + 1], bitorder="little"))[inside])
        one = place // 8 * 8 + byte * 8 + bit
        return (one - i << self.width) | int(self._low_bits(i, 1)[0])

    def span(self, first: int, count: int) -> np.ndarray:
        """The values from the first-th on: only bits from its sampled one to that after the last."""
        if not count:
            return np.zeros(0, np.uint64)
        near, after = first // SAMPLE, (first + count - 1) // SAMPLE + 1
        byte = int(self._samples[near]) // 8
        stop = int(self._samples[after]) // 8 + 1 if after < len(self._samples) else None
        bits = np.unpackbits(np.frombuffer(self._high, np.uint8)[byte:stop], bitorder="little")
        bits[: int(self._samples[near]) % 8] = 0
        ones = np.flatnonzero(bits)[first - near * SAMPLE :][:count] + byte * 8
        upper = (ones - np.arange(first, first + count)).astype(np.uint64) << np.uint64(self.width)
        return upper | self._low_bits(first, count)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self._high, np.uint8), bitorder="little"))
        upper = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.width)
        return upper | self._low_bits(0, self.count)

    def row(self) -> dict:
        low, high, samples = self.parts()
        return {"count": self.count, "width": self.width, "low": low, "high": high, "samples": samples}


def _block_row(part: int, block: int, first: int, docs: list, ids: list) -> dict:
    joined = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    narrow = not len(joined) or int(joined.max()) < 1 << 16
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    named = [d for d in docs if d is not None]
    # Differences of 64-bit ids need not fit into 64 signed bits.
    steps = np.array([d - named[0] for d in named], np.uint64)
    return {
        "part": part,
        "block": block,
        "first_id": first,
        "n_ids": len(joined),
        "n_docs": len(docs),
        "id_bytes": 2 if narrow else 4,
        "ids": joined.astype("<u2" if narrow else "<u4").tobytes(),
        "bounds": EliasFano.build(bounds).row(),
        "nameless": len(docs) - len(named),
        "first_doc": named[0] if named else None,
        "docs": EliasFano.build(steps).row(),
    }


def _blocks(vocabulary: str, space_led: bool, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, space_led).encode
        part = TaskContext.get().partitionId()
        docs, ids, held, block, done = [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block_row(part, block, done, docs, ids)], _BLOCK_ARROW)

        for batch in batches:
            for piece in slices(batch, "text", ENCODED_BYTES):
                found = encode(piece.column("text"))
                for doc_id, own in zip(piece.column("doc_id").to_pylist(), found):
                    if docs and held + len(own) + 1 > BLOCK_IDS:
                        yield row()
                        docs, ids, held, block, done = [], [], 0, block + 1, done + held
                    docs.append(doc_id)
                    ids.append(np.append(own, np.uint32(end_id)))
                    held += len(own) + 1
        if docs:
            yield row()

    return write


_CODE_ARROW = pa.struct(
    [("count", pa.int32()), ("width", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())]
)
_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("n_docs", pa.int32()),
        ("id_bytes", pa.int32()),
        ("ids", pa.binary()),
        ("bounds", _CODE_ARROW),
        ("nameless", pa.int32()),
        ("first_doc", pa.int64()),
        ("docs", _CODE_ARROW),
    ]
)


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    space_led: bool,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Writes all texts, in ascending id order, as token files below ``path``.

    Ranges of ids go to tasks, so no task sees more than its share, and the
    order of parts is the order of ids. Null and empty texts give the end id
    alone. Rows that repeat an id are documents of their own, one after the
    other; null ids come first. An empty table gives a readable, empty file. A very long
    text is a block of its own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    blocks = ranged.mapInArrow(_blocks(vocabulary, space_led, end_id), BLOCK)
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    totals = spark.read.schema(BLOCK).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids"))
    # One row per range partition, whatever the data.
    before, starts = 0, []
    for part, count in sorted(map(tuple, totals.collect())):
        starts.append((part, before))
        before += count
    spark.createDataFrame(starts, "part int, start long").coalesce(1).write.parquet(f"{path}/parts")


def _spans(code: EliasFano, count: int) -> np.ndarray:
    """The first values, a run of them at each select."""
    runs = [code.span(i, min(_RUN, count - i)) for i in range(0, count, _RUN)]
    return np.concatenate(runs) if runs else np.zeros(0, np.uint64)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in batch.to_pylist():
            bounds, docs = EliasFano(**b["bounds"]), EliasFano(**b["docs"])
            edges = _spans(bounds, b["n_docs"] + 1).astype(np.int64)
            steps = _spans(docs, b["n_docs"] - b["nameless"]).tolist()
            doc_ids = [None] * b["nameless"] + [b["first_doc"] + step for step in steps]
            ids = np.frombuffer(b["ids"], f"<u{b['id_bytes']}").astype("<u4")
            crcs = [zlib.crc32(ids[s:e]) for s, e in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "part": pa.array([b["part"]] * b["n_docs"], pa.int32()),
                    "local_start": pa.array(edges[:-1] + b["first_id"], pa.int64()),
                    "n_tokens": pa.array(np.diff(edges), pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    return (
        blocks.mapInArrow(_documents, _DOCUMENT)
        .join(F.broadcast(parts), "part")  # a row per range partition
        .select("doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )
