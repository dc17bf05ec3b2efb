"""The pipeline against a brute-force version of each stage on its own input."""

import math
import re

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from reviewmill.llm.quality import judge_quality
from reviewmill.session import materialize
from test_llm_near import brute as near_brute
from test_llm_tokens import check_packed


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {"": docs}
    last = docs
    for name, stage in corpus_pipeline.STAGES:
        last = found[name] = materialize(stage(spark, last, sf_dir), name)
        if name != "packing":
            assert last.columns == docs.columns
    texts = {n: {r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for n, f in found.items() if n != "packing"}

    judged = judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert set(texts["quality"]) == {r.doc_id for r in judged.filter("kept").select("doc_id").collect()}
    rated = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    clean = [r.doc_id for r in rated if r.quality == 1]
    assert sum(i in texts["quality"] for i in clean) >= 0.99 * len(clean)

    first = {}
    for doc_id, text in sorted(texts["quality"].items(), key=lambda x: (-len(x[1] or ""), x[0])):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), doc_id)
    assert set(texts["exact"]) == set(first.values())

    assert set(texts["near"]) == {r[0] for r in near_brute(list(texts["exact"].items()), 80) if r[3]}

    def tokens(frame):
        rows = frame.select("source", F.expr("length(regexp_replace(text, '[^\\x20\\x09-\\x0D]+', 'w'))"), "text").collect()
        out = {}
        for r in rows:
            out[r.source] = out.get(r.source, 0) + len((r.text or "").split())
        return out

    before, after = tokens(found["near"]), tokens(found["mix"])
    total = sum(before.values())
    longest = max(len((t or "").split()) for t in texts["near"].values())
    entropy = -sum(t / sum(after.values()) * math.log(t / sum(after.values())) for t in after.values() if t)
    assert entropy >= corpus_pipeline.ENTROPY_SHARE * math.log(len(before)) - 0.02
    assert abs(sum(after.values()) - total) <= longest * len(before)

    copies = {r.doc_id: r["count"] for r in found["mix"].groupBy("doc_id").count().collect()}
    once = [(i, texts["mix"][i]) for i, n in copies.items() if n == 1]
    rows = found["packing"].collect()
    alone = {i for i, _ in once}
    assert {r.doc_id for r in rows} == set(copies)
    ends = {}
    for r in rows:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) == max(o + n for o, n in v) <= 1024 for v in ends.values())
    pieces = [r for r in rows if r.doc_id in alone]
    check_pieces(pieces, once)


def check_pieces(pieces, pairs):
    """check_packed without gaps: the other documents of a sequence are left out."""
    moved, end = [], {}
    for n, r in enumerate(sorted(pieces, key=lambda r: (r.doc_id, r.piece))):
        moved.append(type(r)(**{**r.asDict(), "sequence_id": n, "offset": 0}))
        end[n] = r.length
    check_packed(moved, pairs, 1024)


def test_run_is_all_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 0


def test_entry_has_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(entry.oracle_sql()) <= set(names)


def test_batches_for_workers_are_bounded(spark, sf_dir):
    session = spark.newSession()
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = session.read.parquet(f"{sf_dir}/documents.parquet")
    corpus_pipeline.quality(session, docs, sf_dir)
    # Texts of a megabyte each, all in one partition.
    texts = session.range(0, 24, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 8 << 20
    session.conf.set(name, str(32 << 20))
    corpus_pipeline.quality(session, docs, sf_dir)
    assert session.conf.get(name) == str(32 << 20)
