import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from reviewmill.llm import repeats as R


def brute(pairs):
    """Rows by a dictionary of every string of LENGTH bytes; ids must differ."""
    seen, out = set(), []
    for doc_id, text in sorted(pairs):
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, int)
        for start in range(len(data) - R.LENGTH + 1):
            string = data[start : start + R.LENGTH]
            if string in seen:
                cover[start] += 1
                cover[start + R.LENGTH] -= 1
            seen.add(string)
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def made(seed):
    rng = random.Random(seed)
    letters = "ab" if seed == 0 else "abcdefgh \u00e9\u4e2d"
    passages = ["".join(rng.choices(letters, k=rng.randrange(60, 400))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = ["".join(rng.choices(letters, k=rng.randrange(150))) for _ in range(4)]
        for place in range(3):
            if rng.random() < 0.6:
                whole = rng.choice(passages)
                start = rng.randrange(0, 40)
                parts.insert(place, whole[start : len(whole) - rng.randrange(0, 40)])
        texts.append("".join(parts))
    texts += [texts[3], "a" * 700, "ab" * 300, "x" * 99, "y" * 100, "", None, texts[5][10:], "z" * 30_000]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_brute_force(docs, rows, monkeypatch, seed):
    monkeypatch.setattr(R, "BUCKET_BYTES", 2000)
    pairs = made(seed)
    assert rows(R.remove_repeats(docs(pairs))) == sorted(brute(pairs), key=repr)


def test_real_texts(docs, rows, prose):
    some = prose[:120]
    assert rows(R.remove_repeats(docs(some))) == sorted(brute(some), key=repr)


def test_odd_rows(docs, crowded, rows):
    long = "".join(map(chr, range(300, 420)))
    pairs = [(1, long), (1, long + "!"), (1, long), (None, long), (2, long), (None, None)]
    got = rows(R.remove_repeats(crowded(pairs)), "doc_id", "n_bytes", "n_removed")
    size = len(long.encode())
    # The row without an id is first, so all others repeat it; equal rows agree.
    assert got == sorted(
        [(1, size, size), (1, size, size), (1, size + 1, size), (None, size, 0), (2, size, size), (None, 0, 0)], key=repr
    )
    assert R.remove_repeats(docs([])).count() == 0


@pytest.mark.parametrize("members", [1, 2, 57])
def test_column_orders(members):
    """Each column's order and common prefixes are those of sorted suffixes."""
    rng = np.random.default_rng(members)
    table = rng.integers(0, 2, (members, 9)).astype(np.uint16)
    table[rng.random(table.shape) < 0.05] = 256
    for column, order, common in R.column_orders(table):
        suffixes = [tuple(table[i, column:]) for i in order]
        assert suffixes == sorted(suffixes)
        for a, b, n in zip(suffixes, suffixes[1:], common[1:]):
            same = 0
            while same < len(a) and a[same] == b[same] < 256:
                same += 1
            assert n == same
        assert common[0] == 0


@pytest.mark.parametrize("crowded", [1, 1 << 20])
def test_split_anchors(docs, rows, monkeypatch, crowded):
    """Large anchors are split before or after they are dealt, with the same result."""
    monkeypatch.setattr(R, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(R, "MEMBERS", 3)
    monkeypatch.setattr(R, "CROWDED", crowded)
    monkeypatch.setattr(R, "BUCKET_STRINGS", 500)
    pairs = made(1)
    assert rows(R.remove_repeats(docs(pairs))) == sorted(brute(pairs), key=repr)


def test_no_task_gets_all_members():
    """20,000 texts that differ around one anchor are not ordered in one piece."""
    found = np.zeros(20_000 + 50, R._ANCHOR)
    found["region"], found["doc"], found["high"] = np.arange(len(found)), np.arange(len(found)), 68
    found["hash"][20_000:] = 1
    out = R._settle(16)(pd.DataFrame({"bucket": [3], "packed": [R._packed(found)]}))
    sizes = {k: len(R._unpacked(x["packed"], R._REQUEST)) for k, x in out.groupby("kind")}
    assert sizes == {"split": 20_000, "asked": 50}
