import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, name in enumerate(pii.KINDS):
        for m in re.finditer(PATTERNS[name], text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if name == "ip" else True,
                "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[name]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("a.@-+ ()0123456789%\u00e9\n")), max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_in_real_texts(prose):
    assert any(brute(t) for _, t in prose)
    for _, text in prose:
        assert pii.base_spans(text) == brute(text)


def test_very_long_runs_end_soon():
    for text in ("1" * 60_000, "1." * 30_000, "a" * 60_000 + "@", "@" * 60_000, "+1" + "(" * 60_000, "a.b@" * 20_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_very_long_texts_are_swept():
    """Megabytes of numbers in seconds: time follows the text, not its square."""
    import time

    trees = pii.Trees(
        np.array([0]), np.array([0.0]), np.array([0]), np.array([0]), np.array([1.0]), np.array([0]), np.array([1.0]),
        (0.5,) * 4,
    )
    line = "10.0.0.1 - 2024-01-02 03:04:05 id 4111111111111111 tel 555-0100-200 a@b.cd 12345678901\n"
    took = []
    for copies in (500, 4000):
        text = line * copies
        began = time.process_time()
        base, spans = pii.all_spans(text, trees)
        took.append(time.process_time() - began)
        assert len(base) >= 3 * copies and len(spans) > len(base)
        assert sum(1 for _ in pii._example_rows(text)) > copies
    assert took[1] < 8 * took[0] * 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 3), st.integers(1, 8), st.integers(0, 3)), max_size=14))
def test_spans_that_do_not_touch(made):
    spans = sorted((s, k, s + n) for s, k, n, _ in made)
    taken = pii.Taken(spans)
    for a in range(40):
        for b in range(a + 1, 41):
            assert taken.touches(a, b) == any(s < b and a < e for s, _, e in spans)
    scored = sorted(((q / 3, (s, k, s + n)) for s, k, n, q in made), key=lambda x: x[1])
    slow = []
    for _, span in sorted(scored, key=lambda x: (-x[0], x[1][0] - x[1][2], x[1])):
        if not any(s < span[2] and span[0] < e for s, _, e in slow):
            slow.append(span)
    assert sorted(pii._best_apart(scored)) == sorted(slow)


def planted(rng, i):
    """A text with personal data that the base patterns miss, and look-alikes; and the true spans."""
    def card(first):
        body = first + "".join(rng.choice("0123456789") for _ in range(14))
        return body + next(d for d in "0123456789" if pii.luhn(body + d))

    number = card(rng.choice("45"))
    wrong = number[:-1] + str((int(number[-1]) + 1) % 10)
    spaced = " ".join(number[j : j + 4] for j in range(0, 16, 4))
    parts = [
        ("email", f"jo{i}.m (at) mail{i % 7}.example.com"),
        ("email", f"kim{i}[at]post[dot]example[dot]org"),
        ("card", spaced),
        ("phone", f"555-{i % 900 + 100}-{rng.randrange(1000, 9999)}"),
        (None, wrong),
        (None, f"2024{i:06d}1234"),
        (None, f"version 1.{i}.300.{i % 9}"),
        (None, f"chapter {i} at home"),
    ]
    leads = {"phone": "call ", "card": f"order {rng.randrange(100, 999)} ", "email": "write to "}
    text, spans = f"text {i}: ", []
    for kind, part in rng.sample(parts, 5):
        text += leads.get(kind, "see ")
        if kind:
            spans.append((kind, len(text), len(text) + len(part)))
        text += part + " and so on\n"
    return text, spans


def test_precision_and_recall_on_planted_spans(docs):
    """Held out: the trees are fitted on other documents, made by another seed."""
    rng = random.Random(1)
    known = [planted(rng, i)[0] + f"mail a{i}@b.example.com ip 10.0.{i % 250}.1 tel +1 (555) 010-{i:04d}" for i in range(400)]
    trees = pii.fit_trees(docs(known))
    rng = random.Random(2)
    hits = found = true = 0
    for i in range(1000, 1300):
        text, spans = planted(rng, i)
        base, every = pii.all_spans(text, trees)
        added = {(pii.KINDS[k], s, e) for s, k, e in set(every) - set(base)}
        wanted = set(spans) - {(pii.KINDS[k], s, e) for s, k, e in base}
        hits, found, true = hits + len(added & wanted), found + len(added), true + len(wanted)
    print(f"precision {hits / found:.3f} recall {hits / true:.3f} of {true}")
    assert hits / found >= 0.9 and hits / true >= 0.9


@pytest.fixture
def private(docs):
    def build(extra):
        made = []
        for i in range(240):
            card = f"4{i:014d}"
            card += next(d for d in "0123456789" if pii.luhn(card + d))
            made.append(
                f"text {i} mail me.{i}@mail{i % 9}.example.com or +1 (555) 010-{i:04d} then 10.{i % 256}.3.4 "
                f"paid {card} but not {i:05d}99999999 nor 999.1.2.{i} nor 4{i:014d}{(int(card[-1]) + 1) % 10} \u00e9"
            )
        return docs([*made, *extra])

    return build


def test_query_rows(private, rows):
    odd = [(1001, None), (1002, ""), (None, "a@b.cd"), (1003, "x " * 30_000 + "a@b.cd"), (1004, "write joe.m (at) mail3.example.com")]
    got = {r.doc_id: r for r in pii.find_personal_data(private(odd)).collect()}
    assert len(got) == 245
    assert [got[7][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert got[1001].spans == got[1002].spans == ""
    assert got[None].spans == "email:0:6" and got[1003].spans == "email:60000:60006"
    assert got[1003].redacted.endswith("x [EMAIL]")
    # Base spans stay, whatever is added.
    for r in got.values():
        counts = [sum(s.startswith(k) for s in r.spans.split(",")) for k in pii.KINDS]
        assert all(c >= r[f"n_{k}"] for c, k in zip(counts, pii.KINDS))
    # A form that no fixed pattern has is found by the trees.
    assert got[1004].n_email == 0 and got[1004].spans.startswith("email:")


def test_tables_without_examples(docs, crowded, rows):
    assert pii.find_personal_data(docs([])).count() == 0
    got = pii.find_personal_data(crowded([(1, "no data"), (1, "a@b.cd"), (2, None)]))
    assert rows(got, "doc_id", "spans") == [(1, ""), (1, "email:0:6"), (2, "")]


def test_thresholds_cover_documents_beyond_the_sample(spark, docs, monkeypatch):
    """A kind that no held-out document of the sample has gets its threshold from the others."""
    monkeypatch.setattr(pii, "FIT_DOCUMENTS", 160)
    order = F.xxhash64(F.lit(5), "id")
    ids = spark.range(400).select("id", (F.pmod(order, F.lit(4)) == 0).alias("held")).orderBy(order).collect()
    made = []
    for n, (i, held) in enumerate(ids):
        card = f"4{i:014d}"
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
        made.append((i, f"text {i} paid {'nothing' if held and n < 160 else card} but not {wrong} to a{i}@b.example.com"))
    assert pii.fit_trees(docs(made)).cuts[pii.CARD] <= 1
