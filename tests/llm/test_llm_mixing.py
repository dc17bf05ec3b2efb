import math
import random

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import mixing as M


def corpus(docs, sizes, seed=2):
    rng = random.Random(seed)
    names, texts = [], []
    for source, count in sizes.items():
        for _ in range(count):
            names.append(source)
            texts.append("w " * rng.randrange(0, 12))
    return docs(texts, source=lambda i: names[i])


def shares(got):
    out = {}
    for r in got:
        out[r.source] = out.get(r.source, 0) + r.tokens
    return out


@pytest.mark.parametrize(
    ("entropy", "repeats", "budget"), [(0.95, None, None), (0.99, 2.0, None), (None, 1.3, 9000), (None, None, None), (1.0, None, 500)]
)
def test_weights_and_targets(docs, entropy, repeats, budget):
    sizes = {"big": 600, "mid": 200, "low": 60, None: 30}
    frame = corpus(docs, sizes)
    tokens = {r.source: r.t for r in frame.groupBy("source").agg(F.sum(M.word_count(F.col("text"))).alias("t")).collect()}
    got = M.mix_sources(frame, budget, entropy, repeats).collect()
    whole = budget or sum(tokens.values())

    def weights(x):
        z = sum(t**x for t in tokens.values())
        return {s: t**x / z for s, t in tokens.items()}

    def flat(w):
        return -sum(p * math.log(p) for p in w.values())

    # Brute force: the best exponent on a fine grid.
    grid = [i / 20_000 for i in range(20_001)]
    best = 1.0
    if entropy is not None:
        best = max((x for x in grid if flat(weights(x)) >= entropy * math.log(len(tokens)) - 1e-9), default=0.0)
    if repeats is not None:
        most = lambda x: max(weights(x)[s] * whole / tokens[s] for s in tokens)
        best = max(best, min((x for x in grid if most(x) <= repeats), default=1.0))
    wanted = weights(best)
    for r in got:
        assert r.weight == pytest.approx(wanted[r.source], abs=2e-4)
    spent = shares(got)
    for source, share in wanted.items():
        assert abs(spent[source] - share * whole) <= 12 + 2e-4 * whole
    # Each pass has a document once at most, and passes before the last are whole.
    seen = [(r.doc_id, r["pass"]) for r in got]
    assert len(seen) == len(set(seen))
    for source in tokens:
        passes = {}
        for r in got:
            if r.source == source and r.tokens:
                passes.setdefault(r["pass"], set()).add(r.doc_id)
        full = {d.doc_id for d in frame.collect() if d.source == source and (d.text or "").split()}
        assert all(passes[n] == full for n in range(max(passes)))


def test_passes_are_different_permutations(docs):
    got = M.mix_sources(corpus(docs, {"a": 80, "b": 5}), entropy_share=1.0).filter("source = 'b'").collect()
    orders = {}
    for r in sorted(got, key=lambda r: (r["pass"], r["rank"])):
        orders.setdefault(r["pass"], []).append(r.doc_id)
    assert len(orders) > 3 and len({tuple(o) for o in orders.values()}) > 1


def test_every_document_without_tokens_once(docs, rows):
    frame = docs([None, "", "a b", " "], source=lambda i: ["x", "y", "x", "x"][i])
    assert rows(M.mix_sources(frame), "doc_id", "tokens") == [(0, 0), (1, 0), (2, 2), (3, 0)]


def test_odd_tables(docs, crowded, rows):
    assert M.mix_sources(docs([])).count() == 0
    assert rows(M.mix_sources(docs([None])), "doc_id") == [(0,)]
    pairs = [(1, "a"), (1, "a"), (None, "b c"), (2, "x " * 30_000)]
    assert rows(M.mix_sources(crowded(pairs)), "doc_id", "tokens") == sorted(
        [(1, 1), (1, 1), (None, 2), (2, 30_000)], key=repr
    )
    taken = M.take_mix(crowded(pairs))
    assert sorted(taken.columns) == sorted(crowded(pairs).columns)
    assert rows(taken, "doc_id") == [(1,), (1,), (2,), (None,)]


def test_rows_of_a_repeated_id_are_told_apart(docs, rows):
    """A budget for half of all tokens is not overrun by rows that share an id."""
    frame = docs([(1, f"w{i} x") for i in range(400)], source=lambda i: "s")
    assert abs(M.take_mix(frame, budget=400).count() - 200) <= 1
    named = frame.withColumn("mark", F.lit("x")).withColumn("times", F.lit(5)).withColumn("own_key", F.lit(5))
    taken = M.take_mix(named, budget=400)
    assert sorted(taken.columns) == sorted(named.columns) and abs(taken.count() - 200) <= 1
    assert rows(M.take_mix(docs([(1, "a")] * 7 + [(2, "b")], source=lambda i: "s")), "doc_id") == [(1,)] * 7 + [(2,)]
