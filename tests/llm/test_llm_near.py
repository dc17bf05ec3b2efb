import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from reviewmill.llm import near_copies as N
from reviewmill.llm.graph import components
from reviewmill.llm.texts import shingles

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(pairs, percent):
    sets = {i: shingle_set(t) for i, t in pairs}
    home = {i: i for i in sets}

    def root(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                home[y] = x
    return sorted(((i, len(s), root(i), root(i) == i) for i, s in sets.items()), key=repr)


def vary(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family(seed, members=70, length=120):
    """Near copies with a passage that they share with other texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    passage = [f"p{i}" for i in range(30)]
    out = [vary(rng, base, rng.randrange(6)) for _ in range(members)]
    out += [" ".join(passage + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(60))]) for _ in range(50)]
    return list(enumerate(out))


@pytest.mark.parametrize(("percent", "short"), [(85, 64), (80, 4)])
def test_same_components_as_all_pairs(docs, rows, monkeypatch, percent, short):
    """Both ways of comparing what the first pass leaves open, in small blocks."""
    monkeypatch.setattr(N, "SHORT", short)
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "FREQUENT", 4)
    monkeypatch.setattr(N, "TOGETHER", 8)
    pairs = family(percent)
    assert rows(N.near_groups(docs(pairs), percent=percent)) == brute(pairs, percent)


def test_real_texts(docs, rows, prose):
    assert rows(N.near_groups(docs(prose))) == brute(prose, 85)


def test_odd_rows(docs, crowded, rows):
    pairs = [
        (5, "A b c"), (3, "a B\tc"), (1, None), (2, ""), (4, " \n"), (6, "a b c d e"), (7, "A B C D E f"),
        (8, "long " * 30_000), (9, "long " * 20_000), (10, "a b c"),
    ]
    assert rows(N.near_groups(docs(pairs))) == brute(pairs, 85)
    assert rows(N.near_groups(crowded(pairs))) == brute(pairs, 85)
    assert N.near_groups(docs([])).count() == 0
    twice = [(1, "z"), (1, "a b c"), (1, None), (2, "z"), (3, "A B c"), (None, "a b c"), (None, None), (4, "q"), (None, "x")]
    expected = [(1, 1, 1, True)] * 2 + [(1, 0, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, 4, True)]
    expected += [(None, 1, 1, False), (None, 0, None, True), (None, 1, None, True)]
    assert rows(N.near_groups(docs(twice))) == sorted(expected, key=repr)


def test_copies_are_one_node(docs, rows):
    got = N.near_groups(docs(["the very same words here now"] * 300))
    assert rows(got.groupBy("component_id").count()) == [(0, 300)]


def test_keep_near(docs, rows):
    kept = N.keep_near(docs([(2, "a b c"), (1, "A B C"), (3, None), (4, None)]), percent=80)
    assert rows(kept, "doc_id") == [(1,), (3,), (4,)]


def test_every_text_of_an_id_is_judged(docs, rows):
    """A clean text is not dropped with a copy under its id; copies go without one as well."""
    same = [(1, "one copy here"), (5, "one copy here"), (5, "a clean text"), (None, "One copy HERE"), (None, "other")]
    assert rows(N.keep_near(docs(same)), "doc_id", "text") == [(1, "one copy here"), (5, "a clean text"), (None, "other")]
    bare = [(None, "x y"), (None, "x y"), (None, "X y"), (None, "z"), (7, "w"), (7, "w"), (None, ""), (None, "")]
    kept = rows(N.keep_near(docs(bare)), "doc_id", "text")
    assert len(kept) == 5 and sum((t or "").lower() == "x y" for _, t in kept) == 1
    assert (7, "w") in kept and kept.count((None, "")) == 2


@pytest.mark.parametrize("shares", [2, 40, 600])
def test_common_values(shares):
    rng = np.random.default_rng(shares)
    sets = [np.unique(rng.integers(0, 120_000 // shares, 256)) for _ in range(300)]
    got = N.common_values(sets[:100], sets[100:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[100:]] for a in sets[:100]]


def test_memory_of_one_block():
    """2,048 rows whose values are each shared by two rows."""
    import tracemalloc

    pairs = [np.arange(i * 256, (i + 1) * 256) for i in range(1024)]
    tracemalloc.start()
    for first in range(0, 1024, 256):
        N.common_values(pairs[first : first + 256], pairs)
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()


def test_shingles_depend_on_the_text_alone():
    texts = ["a b c d e f", "", "b", None, "a b c d e", "x y  z"]
    together, bounds = shingles(pa.array(texts), 5)
    for i, text in enumerate(texts):
        alone, _ = shingles(pa.array([text], pa.string()), 5)
        assert np.array_equal(together[bounds[i] : bounds[i + 1]], alone)
    assert list(np.diff(bounds)) == [2, 0, 1, 0, 1, 1]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, rows, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(300, 360)] + [(500, 500), (None, 3)]
    home = {}
    for a, b in edges:
        if a is not None and a != b:
            home.setdefault(a, a)
            home.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            if a is not None and a != b:
                home[a] = home[b] = min(home[a], home[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    assert rows(components(frame, "a", "b")) == sorted(home.items(), key=repr)
    assert components(frame.limit(0), "a", "b").count() == 0


def traced_peak(work):
    """MB that ``work`` holds at most beyond what was there before, and its result."""
    tracemalloc.start()
    try:
        found = work()
        return tracemalloc.get_traced_memory()[1] / 1e6, found
    finally:
        tracemalloc.stop()


def test_estimates_take_little_memory():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(-(2**31), 2**31, int(n), dtype=np.int32)) for n in rng.integers(1, 257, 3000)]
    others = [s if i % 3 else np.unique(s // 2) for i, s in enumerate(sets)]

    def lists(found):
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, np.concatenate(found))

    sizes = [pa.array([len(s) for s in x], pa.int64()) for x in (sets, others)]
    ids = pa.array(np.arange(len(sets)))
    names = ["a", "b", "left_sketch", "left_n_shingles", "right_sketch", "right_n_shingles"]
    batch = pa.RecordBatch.from_arrays([ids, ids, lists(sets), sizes[0], lists(others), sizes[1]], names)
    # Also a batch that is a part of another one, and an empty one.
    batches = [batch.slice(0, 1000), batch.slice(1000), batch.slice(0, 0)]
    N.estimate(sets[0], others[0])
    peak, found = traced_peak(lambda: [b.column("a").to_pylist() for b in N._estimates(0.8)(iter(batches))])
    wanted = [
        i for i, (x, y) in enumerate(zip(sets, others))
        if N.estimate(x, y) >= 0.8 - N.slack(len(x) + len(y), 0.8)
    ]
    assert sum(found, []) == wanted and 0 < len(wanted) < len(sets)
    assert peak < 5


def test_sketches_take_little_memory():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts), pa.array(texts)], ["doc_id", "mark", "text"])
    peak, found = traced_peak(lambda: sum(b.num_rows for b in N._sketch(5, N.SKETCH)(iter([batch]))))
    assert found == 2000
    assert peak < 60
