import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import quality as Q

LABELS = "doc_id long, quality int, toxic int"


def texts(count, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeimnorst", k=rng.randrange(2, 9))) for _ in range(400)]
    out = []
    for i in range(count):
        good = i % 4 != 0
        some = [rng.choice(words) for _ in range(rng.randrange(30, 90))]
        if good:
            out.append(". ".join(" ".join(some[j : j + 8]).capitalize() for j in range(0, len(some), 8)) + ".")
        else:
            out.append(" ".join([f"{some[0].upper()}!!"] * 20 + [f"{w}###" for w in some[:20]]))
    return out


def labels(spark, pairs):
    return spark.createDataFrame([(i, q, 0) for i, q in pairs], LABELS)


def test_held_out_accuracy(spark, sf_dir, docs):
    made = texts(400)
    rated = labels(spark, [(i, int(i % 4 != 0)) for i in range(0, 400, 2)])
    got = Q.judge_quality(docs(made), rated).select("doc_id", "kept").collect()
    assert sum(r.kept == (r.doc_id % 4 != 0) for r in got if r.doc_id % 2) >= 196


def test_real_texts(spark, sf_dir):
    """Labelled documents: the good ones stay, the junk goes."""
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rated = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = rated.select("doc_id", F.col("quality").alias("label"))
    got = Q.judge_quality(frame, rated).join(labelled, "doc_id").select("kept", "label").collect()
    assert np.mean([r.kept == (r.label == 1) for r in got]) >= 0.98


def test_posteriors_are_the_formula(spark, docs):
    """host_mean and path_mean against sums in plain Python."""
    made = texts(120)
    rated = labels(spark, [(i, int(i % 4 != 0)) for i in range(120)])
    frame = docs(made, source=lambda i: f"h{i % 7 if i % 5 else 0}").withColumn(
        "lang", F.concat(F.lit("p"), F.col("doc_id") % 3)
    )
    got = Q.judge_quality(frame, rated).collect()
    p = {r.doc_id: 1 / (1 + np.exp(-r.text_odds)) for r in got}
    mean = np.mean(list(p.values()))
    hosts, paths = {}, {}
    for r in got:
        hosts.setdefault(r.source, []).append(p[r.doc_id])
        paths.setdefault((r.source, r.lang), []).append(p[r.doc_id])

    def strength(groups):
        n = np.array([len(v) for v, _ in groups], float)
        raw = np.array([np.mean(v) for v, _ in groups])
        c = np.array([c for _, c in groups])
        base = (n * c * (1 - c)).sum() / n.sum()
        between = ((n * (raw - c) ** 2).sum() - (c * (1 - c)).sum()) / (n.sum() - (n**2).sum() / n.sum())
        return Q.STRONGEST if between <= base / (Q.STRONGEST + 1) else np.clip(base / between - 1, Q.WEAKEST, Q.STRONGEST)

    k = strength([(v, mean) for v in hosts.values()])
    host = {h: (sum(v) + k * mean) / (len(v) + k) for h, v in hosts.items()}
    kp = strength([(v, host[h]) for (h, _), v in paths.items()])
    for r in got:
        own = paths[(r.source, r.lang)]
        path = (max(0, sum(own) - p[r.doc_id]) + kp * host[r.source]) / (len(own) - 1 + kp)
        assert r.host_mean == pytest.approx(host[r.source], rel=1e-6)
        assert r.path_mean == pytest.approx(np.clip(path, 1e-6, 1 - 1e-6), rel=1e-6)
        odds = r.text_odds - np.log(mean / (1 - mean)) + np.log(r.path_mean / (1 - r.path_mean))
        assert r.quality == pytest.approx(1 / (1 + np.exp(-odds)), rel=1e-6)
        assert r.kept == (r.quality >= 0.5)


def test_sparse_sites_lean_on_their_host(spark):
    rows = [("h", "big", 0.9, 1000), ("h", "small", 0.0, 1), ("bad", "x", 0.1, 1000)]
    frame = spark.createDataFrame(rows, "host string, path string, raw double, n long").withColumn("centre", F.lit(0.5))
    assert Q.WEAKEST <= Q._strength(frame, "raw", "n", "centre") < 10


def test_odd_rows(spark, docs, crowded, rows):
    pairs = [(1, None), (1, ""), (None, "a b"), (2, "x " * 40_000), (3, "\n \t"), (4, "#" * 100_000)]
    nothing = labels(spark, [])
    got = Q.judge_quality(crowded(pairs), nothing)
    assert got.count() == 6 and got.filter("NOT kept OR quality IS NULL").count() == 0
    for rated in ([(2, 1), (4, 0), (4, None), (None, 1), (2, 1)], [(2, 1)]):
        assert Q.judge_quality(docs(pairs), labels(spark, rated)).count() == 6
    assert Q.judge_quality(docs([]), nothing).count() == 0
    lost = docs(pairs).withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string"))
    assert Q.judge_quality(lost, nothing).count() == 6


def test_columns_called_like_ours(spark, docs):
    frame = docs(["a b", "c", None])
    for name in ("_host", "_n", "_good", "_text_log_odds", "_host_mean"):
        frame = frame.withColumn(name, F.lit("x"))
    got = Q.judge_quality(frame, labels(spark, [(0, 1), (1, 0)]))
    assert set(frame.columns) < set(got.columns)
    assert {(r._host, r._n, r._text_log_odds) for r in got.collect()} == {("x", "x", "x")}


def test_features_depend_on_the_text_alone():
    some = [*texts(20), "", None, "ÉTÉ été", "a"]
    together = Q.text_features(pa.array(some))
    for i, text in enumerate(some):
        assert np.allclose(together[i], Q.text_features(pa.array([text], pa.string()))[0])


def test_fit_sample_is_bounded(spark, docs):
    made = texts(60)
    rated = labels(spark, [(i, int(i % 4 != 0)) for i in range(60)])
    few = Q.fit_classifier(docs(made), rated, fit_rows=20)
    again = Q.fit_classifier(docs(made).repartition(5), rated, fit_rows=20)
    assert np.allclose(few.weights, again.weights) and few.bias == pytest.approx(again.bias)
