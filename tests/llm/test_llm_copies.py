import re

import pytest
from pyspark.sql import functions as F

from reviewmill.llm.exact_copies import exact_groups, keep_exact

ODD = [
    (1, "a b"), (2, "ab"), (3, "a  b\n"), (4, None), (5, ""), (6, " \t"),
    (7, "c"), (7, "c"), (None, "c"), (None, None), (8, "x" * 50_000), (9, "a b"),
]


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, len(text or "")))
    out = []
    for members in groups.values():
        named = [m for m in members if m[0] is not None]
        most = max(n for _, n in members)
        best = min((i for i, n in named if n == most), default=None)
        out += [(i, best, len(members), i == best) for i, _ in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [F.md5, lambda c: F.left(F.md5(c), F.lit(1))])
def test_groups_of_equal_texts(docs, rows, digest):
    got = exact_groups(docs(ODD), content_hash=digest)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept") == expected(ODD)


def test_collisions_split(docs, rows):
    """Every text has the same hash: bytes decide."""
    got = exact_groups(docs(["a", "b", "a", "c"]), content_hash=lambda c: F.lit("same"))
    assert rows(got, "doc_id", "keep_id", "group_size") == [(0, 0, 2), (1, 1, 1), (2, 0, 2), (3, 3, 1)]


def test_empty_table_and_clashing_columns(docs, crowded, rows):
    assert exact_groups(docs([])).count() == 0
    assert rows(exact_groups(crowded(ODD)), "doc_id", "keep_id", "group_size", "kept") == expected(ODD)


def test_kept_rows_have_all_columns(crowded, rows):
    frame = crowded([(1, "a"), (2, "a "), (3, "b")])
    kept = keep_exact(frame)
    assert kept.columns == frame.columns or sorted(kept.columns) == sorted(frame.columns)
    assert rows(kept, "doc_id") == [(2,), (3,)]


def test_one_row_of_each_group_stays(docs, rows):
    same = [(None, "a"), (None, "a"), (4, "a "), (None, "b"), (None, "b"), (5, "c"), (5, "c"), (5, "d"), (6, "a b"), (6, "ab ")]
    kept = keep_exact(docs(same))
    assert rows(kept, "doc_id", "text") in (
        [(4, "a "), (5, "c"), (5, "d"), (6, x), (None, "b")] for x in ("a b", "ab ")
    )
    assert rows(keep_exact(docs([(1, "x"), (None, "x"), (None, "x"), (None, "y")])), "doc_id") == [(1,), (None,)]
    assert keep_exact(docs([])).count() == 0


def test_extreme_ids(docs, rows):
    ids = [-(2**63), 2**63 - 1, 0, -1]
    got = exact_groups(docs([(i, "a") for i in ids] + [(None, "a")]))
    assert rows(got.select("keep_id").distinct()) == [(-(2**63),)]


def test_large_group_moves_no_texts(docs, spark):
    """What comes after the groups are found moves hashes and marks, not contents."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = exact_groups(docs(["same text"] * 100))
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "Python" not in plan
    lines = plan.split("\n")
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert below and not any("content#" in line.split("AS ")[-1] and "sha2" not in line for line in below)
