import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import collocations as C

FIELDS = "lang rank phrase a l r n score".split()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def brute(rows, least, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    own = f.setdefault(lang, Counter())
                    own[tuple(words[i : i + size])] += 1
    found = []
    for lang, counts in f.items():
        kept = []
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            around = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= 80 * a for b in around):
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(found)


def ours(spark, rows, least, **options):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(map(tuple, C.collocations(frame, least, **options).select(*FIELDS).collect()))


def made(seed, count=60):
    rng = random.Random(seed)
    words = ["new", "York", "city", "of", "a", "é", "ÉA", "x\x00y", "the"]
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", ".", "\n", " . "]) for _ in range(40))
        rows.append((rng.choice(["en", "de", None]), text))
    return rows


@pytest.mark.parametrize("least", [1, 4, 30])
def test_against_brute_force(spark, least):
    rows = [*made(least), ("en", "new york city " * 40), ("de", "ab ab ab ab ab " * 9)]
    assert ours(spark, rows, least) == brute(rows, least)


def test_top_and_ties(spark):
    rows = made(3)
    assert ours(spark, rows, 2, top=5) == brute(rows, 2, 5)


def test_small_sketch_and_stretches(spark, monkeypatch):
    """Shared counters and cuts of long texts change nothing."""
    monkeypatch.setattr(C, "_stretches", _short_stretches(C._stretches))
    rows = [("en", " ".join(t for _, t in made(9))), ("en", "a b c d " * 3000), ("en", "w, " * 2000)]
    assert ours(spark, rows, 3) == brute(rows, 3)


def _short_stretches(real):
    def cut(data, bounds):
        from reviewmill.llm import collocations

        collocations.SLICE_BYTES = 100
        return real(data, bounds)

    return cut


def test_odd_rows(spark):
    rows = [("en", None), (None, ""), ("en", " \t . , \n"), ("fr", "solo")] + [("en", "A b")] * 40
    assert ours(spark, rows, 30) == brute(rows, 30) == [("en", 1, "a b", 40, 40, 40, 80, 1000000)]
    assert ours(spark, [("en", "x")], 30) == []
    empty = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(empty).collect() == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([("en", "a b")] * 40, "lang string, text string")
    for name in ("w1", "n", "f", "phrase", "words", "rank", "range", "score", "k"):
        frame = frame.withColumn(name, F.lit("x"))
    assert [r.a for r in C.collocations(frame).collect()] == [40]
