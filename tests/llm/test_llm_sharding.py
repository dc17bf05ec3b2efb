import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reviewmill.llm.sharding import shard_documents, write_shards


def dealt(frame, shards=4, **options):
    found = shard_documents(frame, shards, **options).select(
        "doc.doc_id", "doc.text", "doc.source", "size", "text_crc32", "shard", "slot"
    )
    return [tuple(r) for r in found.collect()]


def check(found, shards, expected):
    """Counts one apart, gapless slots, the law's sizes, and each row as often as it came."""
    counts = Counter(shard for *_, shard, _ in found)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(expected)
    for shard in range(shards):
        assert sorted(slot for *_, s, slot in found if s == shard) == list(range(counts[shard]))
    assert Counter((i, t, s) for i, t, s, *_ in found) == Counter(expected)
    for _, text, _, size, crc, _, _ in found:
        own = (text or "").encode()
        assert (size, crc) == (len(own) + 1, zlib.crc32(own))


def test_every_shard_has_the_mixture(docs):
    # One source with most rows, one with a seventh, one with a row a shard.
    source = lambda i: "hot" if i % 10 < 8 else ("warm" if i % 10 == 8 else f"rare{i % 3}")
    frame = docs([f"text {i}" for i in range(1000)], source)
    found = dealt(frame, 8)
    check(found, 8, [(i, f"text {i}", source(i)) for i in range(1000)])
    totals = Counter(s for _, _, s, *_ in found)
    for shard in range(8):
        own = Counter(s for _, _, s, _, _, k, _ in found if k == shard)
        for name, total in totals.items():
            assert abs(own[name] - total / 8) <= 2
    # The order inside a source is shuffled, and the seed decides.
    places = {i: (k, slot) for i, _, _, _, _, k, slot in found}
    hot = [places[i] for i in range(1000) if source(i) == "hot"]
    assert hot != sorted(hot)
    assert places != {i: (k, slot) for i, _, _, _, _, k, slot in dealt(frame, 8, seed=8)}


def test_order_is_by_fraction(docs):
    """Against the method done by hand."""
    frame = docs([f"t{i}" for i in range(37)], lambda i: "a" if i < 30 else "b")
    found = dealt(frame, 5)
    order = [s for *_, s, _, _, k, slot in sorted(found, key=lambda r: r[-2:])]
    line = sorted([((2 * i + 1) / 60, "a") for i in range(30)] + [((2 * i + 1) / 14, "b") for i in range(7)])
    assert order == [s for _, s in line]


def test_odd_rows(docs):
    texts = [(1, "x"), (1, "x"), (1, "x"), (1, "y"), (None, None), (None, None), (2, ""), (3, "long " * 40000)]
    frame = docs(texts, lambda i: None if i == 3 else "s")
    found = dealt(frame, 3)
    check(found, 3, [(i, t, None if n == 3 else "s") for n, (i, t) in enumerate(texts)])


def test_one_row_many_times(docs):
    frame = docs([(7, "same")] * 500 + [(i, f"t{i}") for i in range(100, 120)], lambda i: "s")
    check(dealt(frame, 16), 16, [(7, "same", "s")] * 500 + [(i, f"t{i}", "s") for i in range(100, 120)])


def test_fewer_rows_than_shards_and_none(docs):
    check(dealt(docs(["a", "b"]), 16), 16, [(0, "a", "s0"), (1, "b", "s1")])
    assert dealt(docs(["a"]).limit(0), 16) == []


def test_clashing_columns(crowded):
    frame = crowded(["a", "b", "a"])
    for name in ("at", "row", "copies", "copy", "before", "members", "fraction", "one", "all", "bucket", "doc"):
        frame = frame.withColumn(name, F.lit("x"))
    frame = frame.withColumn("shard", F.lit(9)).withColumn("slot", F.lit(9)).withColumn("unnamed", F.lit(9))
    check(dealt(frame, 2), 2, [(0, "a", "s0"), (1, "b", "s1"), (2, "a", "s0")])


@pytest.mark.parametrize("shards", [1, 3])
def test_written_shards(spark, docs, tmp_path, shards):
    texts = [f"t{i}" for i in range(50)] + [None]
    write_shards(docs(texts), str(tmp_path / "out"), shards)
    found = defaultdict(list)
    for row in spark.read.parquet(str(tmp_path / "out")).collect():
        found[row.shard].append((row.slot, row.doc.text))
    assert [len(found[s]) for s in range(shards)] == [51 * (s + 1) // shards - 51 * s // shards for s in range(shards)]
    assert sorted(repr(t) for own in found.values() for _, t in own) == sorted(map(repr, texts))
    assert all([slot for slot, _ in sorted(own)] == list(range(len(own))) for own in found.values())
