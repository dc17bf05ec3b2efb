import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewmill.llm import packing, token_files
from reviewmill.llm import tokens as K
from reviewmill.llm.queries import vocabulary

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]
LIBRARY = {f: Tokenizer.from_file(vocabulary(f)) for f, _ in FILES}
OWN = {f: K.Encoder(vocabulary(f), led) for f, led in FILES}
TRICKY = [
    "", "a  b", "a   b ", "x\n\n y", " lead", "trail ", "trail  ", "it's 3.14, ok... \t tab",
    "<|endoftext|> foo <|endoftext|>bar", "e\u0301 \u00e9. \u03a3\u03b1\u03c2 nb\u00a0sp", "_a_b, c_.", "a.\nb,\nc",
    "\u00bd, x\u00b2. y_", "dogs'. it's, we'll", " .a", "., b", "a . b", "\na", "\u00ff\u00d7\u00f7 a", "a \x1c b\x85 c",
    "a\u200b b", "\ufeffa b", "\u0130stanbul \u1e9e",
]


def ids(name, text):
    return LIBRARY[name].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", [f for f, _ in FILES])
def test_real_and_tricky_texts(prose, name):
    texts = [t for _, t in prose] + TRICKY
    got = OWN[name].encode(pa.array(texts + [None], pa.string()))
    assert [x.tolist() for x in got] == [ids(name, t) for t in texts] + [[]]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abE.,'! \n\t_0\u00e9\u00d7\u0301\u00a0\u2028<|>\x1c\x85\u03a3")), max_size=24))
def test_any_text(text):
    for name, _ in FILES:
        assert OWN[name].encode(pa.array([text]))[0].tolist() == ids(name, text)


def test_full_cache(monkeypatch, prose):
    monkeypatch.setattr(K, "CACHED_PIECES", 50)
    own = K.Encoder(vocabulary(FILES[1][0]), True)
    for _, text in prose[:30]:
        assert own.encode(pa.array([text, text]))[1].tolist() == ids(FILES[1][0], text)
    assert len(own._known) <= 50


@pytest.mark.parametrize("seed", range(4))
def test_elias_fano(seed):
    rng = np.random.default_rng(seed)
    steps = rng.integers(0, [1, 5, 3000, 2][seed], [1, 40, 3000, 700][seed])
    values = np.concatenate([[0], np.cumsum(steps)])
    code = token_files.EliasFano.build(values)
    again = token_files.EliasFano(code.count, code.width, *code.parts())
    assert again.all().tolist() == values.tolist()
    assert [again.select(i) for i in range(len(values))] == values.tolist()
    bits = 8 * sum(map(len, again.parts()[:2]))
    assert bits <= len(values) * (2 + max(0, np.log2(max(1, values[-1]) / len(values)))) + 2 * len(values) + 16


def test_token_files_round_trip(spark, docs, rows, tmp_path, prose, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 3000)
    name, led = FILES[0]
    pairs = [*prose[:80], (10**9, None), (10**9 + 1, ""), (-5, "last first " * 5000), (-(2**63), "a"), (2**63 - 1, "b")]
    random.Random(1).shuffle(pairs)
    token_files.write_token_files(docs(pairs), str(tmp_path / "t"), vocabulary(name), led, 1)
    expected, start = [], 0
    for doc_id, text in sorted(pairs):
        own = np.array([*ids(name, text or ""), 1], "<u4")
        expected.append((doc_id, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert rows(token_files.read_documents(spark, str(tmp_path / "t"))) == sorted(expected, key=repr)


def test_token_files_of_odd_tables(spark, crowded, rows, tmp_path):
    name, led = FILES[0]
    for n, pairs in enumerate(([], [(None, "a"), (1, "b"), (1, "c c"), (1, "b"), (None, None)])):
        path = str(tmp_path / str(n))
        token_files.write_token_files(crowded(pairs), path, vocabulary(name), led, 1)
        got = rows(token_files.read_documents(spark, path), "start", "doc_id", "n_tokens")
        got.sort()
        assert [r[1] for r in got] == sorted((i for i, _ in pairs), key=lambda x: (x is not None, x))
        assert [r[0] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]


def check_packed(got, pairs, size):
    name = FILES[1][0]
    bins, texts = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault(r.doc_id, []).append(r)
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    for doc_id, text in pairs:
        own = np.array([*ids(name, text or ""), 2], "<u4")
        pieces = sorted(texts[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(own) // size)))
        assert all(r.length == size for r in pieces[1:])
        end = 0
        for r in pieces:
            assert r.start == end and r.ids_crc32 == zlib.crc32(own[end : end + r.length].tobytes())
            end += r.length
        assert end == len(own)
    return len(bins)


@pytest.mark.parametrize("size", [64, 1024])
def test_packing(docs, prose, size):
    name, led = FILES[1]
    pairs = [*prose, (10**9, None), (10**9 + 1, ""), (10**9 + 2, "word " * 30_000)]
    got = packing.pack(docs(pairs), vocabulary(name), led, 2, size).collect()
    bins = check_packed(got, pairs, size)
    assert bins <= -(-sum(r.length for r in got) // size) * 1.03 + 1


def test_packing_of_odd_tables(docs, crowded):
    name, led = FILES[1]
    assert packing.pack(docs([]), vocabulary(name), led, 2).count() == 0
    got = packing.pack(crowded([(1, "a"), (1, "a"), (None, "b"), (2, None)]), vocabulary(name), led, 2).collect()
    assert sorted((r.doc_id is None, r.length) for r in got) == [(False, 1), (False, 2), (False, 2), (True, 2)]
    assert sorted(r.offset for r in got) == [0, 2, 4, 6]


@pytest.mark.parametrize("seed", range(3))
def test_plan_uses_every_length(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 101): rng.randrange(1, 500) for _ in range(60)}
    used = {}
    for times, lengths in packing.plan_bins(dict(counts), 100):
        assert sum(lengths) <= 100 and times > 0
        for length in lengths:
            used[length] = used.get(length, 0) + times
    assert used == counts


def one_at_a_time(lengths, size):
    """Best-two-fit over a list of documents, each sequence by itself."""
    left, bins = sorted(lengths), []
    while left:
        own, gap = [], size
        while fits := [x for x in left if x <= gap]:
            own.append(fits[-1])
            left.remove(fits[-1])
            gap -= fits[-1]
        if gap and len(own) > 1:
            room = gap + own[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if own[-1] < a + b <= room]
            if pairs:
                _, a, b = max(pairs, key=lambda p: p[0])
                left = sorted([*left, own.pop()])
                left.remove(a)
                left.remove(b)
                own += [a, b]
        bins.append(sum(own))
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_one_at_a_time(seed):
    """As many sequences, and as full, as when each is packed by itself."""
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 3, 5, 8, 13, rng.randrange(1, 60)]) for _ in range(300)]
    counts = {x: lengths.count(x) for x in lengths}
    planned = [sum(own) for times, own in packing.plan_bins(counts, 64) for _ in range(times)]
    slow = one_at_a_time(lengths, 64)
    assert sum(planned) == sum(slow) and abs(len(planned) - len(slow)) <= 1
    full = [sum(x == 64 for x in bins) for bins in (planned, slow)]
    assert abs(full[0] - full[1]) <= 2


def test_select_over_wide_ranges():
    values = [0, 1, 2**40, 2**63, 2**64 - 1]
    code = token_files.EliasFano.build(np.array(values, np.uint64))
    assert [code.select(i) for i in range(5)] == values == code.all().tolist()


def test_two_replace_the_smallest():
    """6 + 3 leaves a gap of 1; for the 3, the pair 2 + 2 fills the sequence."""
    assert packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])


def test_runs_are_what_select_gives_and_look_at_their_own_bits(monkeypatch):
    values = np.cumsum(np.random.default_rng(1).integers(0, 900, 3000)).astype(np.uint64)
    code = token_files.EliasFano.build(values)
    seen, unpack = [], np.unpackbits
    monkeypatch.setattr(token_files.np, "unpackbits", lambda a, **k: seen.append(len(a)) or unpack(a, **k))
    for first, count in ((0, 3000), (0, 1), (255, 2), (256, 256), (700, 1000), (2999, 1), (5, 0)):
        seen.clear()
        assert code.span(first, count).tolist() == values[first : first + count].tolist()
        assert sum(seen) <= (count + 2 * token_files.SAMPLE) * (code.width + 3) / 8 + 8
    assert token_files._spans(code, 3000).tolist() == values.tolist()
    odd = [[], [0], [0] * 700, [0, 2**62], [2**63 - 1] * 3]
    for each in odd:
        assert token_files._spans(token_files.EliasFano.build(np.array(each, np.uint64)), len(each)).tolist() == each


def test_documents_are_not_read_value_by_value(monkeypatch):
    monkeypatch.setattr(token_files.EliasFano, "select", None)
    row = token_files._block_row(0, 0, 5, [None, 3, 9], [np.arange(n, dtype=np.uint32) for n in (2, 1, 4)])
    batch = pa.RecordBatch.from_pylist([row], token_files._BLOCK_ARROW)
    found = pa.Table.from_batches(token_files._documents(iter([batch])))
    assert found.column("doc_id").to_pylist() == [None, 3, 9]
    assert found.column("local_start").to_pylist() == [5, 7, 8]
    assert found.column("n_tokens").to_pylist() == [2, 1, 4]
