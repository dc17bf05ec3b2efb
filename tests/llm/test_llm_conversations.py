import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import conversations as C

TURN = "conv_id long, turn long, role string, text string"


def brute(conversations):
    """Rows of the trie from {conv_id: [(role, text), ...]}, by dictionaries of prefixes."""
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        own = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        below = [sums[k] for k in children.get(prefix, [])]
        sums[prefix] = (sum(a for a, _ in below) or 1, own + sum(b for _, b in below))
    return sorted(
        (
            min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children.get(p, [])), *sums[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, own in members.items()
    )


def grouped(rows):
    found = {}
    for c, _, role, text in sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""),
    ):
        found.setdefault(c, []).append((role or "", text or ""))
    return found


def lent(conversations):
    found = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = conversations.get(c - c % 100, [])[:h] + own[h:]
    return found


def trie(frame, lend=False):
    turns, convs = C.number_turns(frame)
    found = C.prefix_trie(*C.lend_heads(turns, convs)) if lend else C.prefix_trie(turns, convs)
    return sorted(map(tuple, found.drop("high", "low").collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, TURN).repartition(5)


@pytest.mark.parametrize("block", [1, 3, 4])
@pytest.mark.parametrize("lend", [False, True])
def test_against_brute_force(spark, monkeypatch, block, lend):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "STRETCH", 2)
    rng = random.Random(block)
    rows = []
    for c in range(130):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c * 7, turn, rng.choice("ua"), rng.choice(["x", "yé", "zzz"]) if turn % 4 else "same"))
    rng.shuffle(rows)
    found = grouped(rows)
    assert trie(table(spark, rows), lend) == brute(lent(found) if lend else found)


def test_hot_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(C, "STRETCH", 8)
    # One conversation holds most rows, a group of equal ones many of the rest.
    rows = [(5, i, "u", f"t{i % 3}") for i in range(700)]
    rows += [(c, i, "u", f"t{i}") for c in range(10, 60) for i in range(3)]
    rows += [(70, i, "u", f"t{i % 3}") for i in range(650)]
    assert trie(table(spark, rows)) == brute(grouped(rows))


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 2, "u", "b"), (1, 2, "a", "b"), (1, 2, "a", "b"), (2, None, "", ""),
        (None, 1, "u", "lost"), (3, 1, "u", "long " * 30000), (3, None, "u", "x"), (-101, 0, "u", "x"), (-101, 1, "u", "y"),
    ]
    assert trie(table(spark, rows)) == brute(grouped(rows))
    # Role and text are told apart wherever the border lies.
    near = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "a:", "bc"), (4, 0, "a", ":bc")]
    assert trie(table(spark, near)) == brute(grouped(near))


def test_nothing_and_turnless(spark):
    assert trie(table(spark, []).limit(0)) == []
    # All turns of a conversation may be behind a head that nobody lends.
    rows = [(c, 0, "u", "x") for c in range(101, 140)]
    found = lent(grouped(rows))
    assert any(not turns for turns in found.values())
    assert trie(table(spark, rows), lend=True) == brute(found)


def test_clashing_columns_and_texts(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "a", "b"), (2, 0, "u", "a"), (2, 1, "a", "c")]
    frame = table(spark, rows)
    for name in ("place", "digest", "size", "seat", "part", "copy", "n", "high", "low", "depth", "block"):
        frame = frame.withColumn(name, F.lit("x"))
    turns, convs = C.number_turns(frame)
    found = C.node_texts(C.prefix_trie(turns, convs), turns)
    assert sorted((r.depth, r.text or "", r.n_convs) for r in found.collect()) == [
        (0, "", 2), (1, "a", 2), (2, "b", 1), (2, "c", 1),
    ]


def test_many_ids_in_one_hash(spark, monkeypatch):
    monkeypatch.setattr(C, "_IDS", 7)
    rows = [(c, 0, "u", "x" if c % 3 else "y") for c in range(200)]
    assert trie(table(spark, rows)) == brute(grouped(rows))
