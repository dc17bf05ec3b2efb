"""Document quality: a text classifier shrunk through host and path posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm.rows import fresh
from reviewmill.llm.texts import PLACES, flat, mix, slices, spans, word_hashes
from reviewmill.session import materialize

FEATURES = [
    "word_length",
    "capitals",
    "marks",
    "digits",
    "line_ends",
    "repeated_word",
    "known_words",
    "known_triples",
    "length",
    "odd_endings",
    "stops",
    "long_words",
]
# Labelled rows that the classifier is fitted on, at most.
FIT_ROWS = 20_000
# Weight of the penalty on the classifier's coefficients, in rows.
RIDGE = 1.0
# Bounds for the strength of a prior, in documents.
WEAKEST, STRONGEST = 1.0, 1e6

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK &= ~(_LETTER | _DIGIT | _STOP)
_MARK[[ord(c) for c in "'\"-()"]] = False


def _distinct(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """How many different values each text has."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=texts)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; null and empty texts have zeros."""
    data, bounds = flat(column)
    texts = len(bounds) - 1
    size = np.maximum(np.diff(bounds), 1)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    starts, ends, first = spans(data, bounds)
    counts = np.diff(first)
    words = np.maximum(counts, 1)
    owner = np.repeat(np.arange(texts), counts)
    hashes = word_hashes(data, starts, ends)
    letters = total(_LETTER[data])
    # Capitals of Latin-1 end in 0x80 to 0x9E after 0xC3.
    capital = _UPPER[data]
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    triples = hashes[:-2] * PLACES[1] + hashes[1:-1] * PLACES[2] + hashes[2:] * PLACES[3]
    whole = owner[:-2] == owner[2:]
    lengths = ends - starts
    last = data[ends - 1]
    out = [
        np.log1p(np.bincount(owner, lengths, texts) / words),
        total(capital) / np.maximum(letters, 1),
        total(_MARK[data]) / size,
        total(_DIGIT[data]) / size,
        np.log1p(total(data == 10) / words * 100),
        np.bincount(owner, again, texts) / words,
        _distinct(hashes, owner, texts) / words,
        _distinct(mix(triples[whole]), owner[:-2][whole], texts) / np.maximum(counts - 2, 1),
        np.log1p(counts),
        np.bincount(owner, _MARK[last], texts) / words,
        total(_STOP[data]) / words,
        np.bincount(owner, lengths > 20, texts) / words,
    ]
    return np.where(counts[:, None] > 0, np.stack(out, axis=1), 0.0)


@dataclass(frozen=True)
class Classifier:
    """Log odds of good quality: ``bias`` and a weight for each standardised feature."""

    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray
    bias: float

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        scaled = np.clip((features - self.means) / self.scales, -8, 8)
        return np.clip(_expand(scaled) @ self.weights + self.bias, -12, 12)


def _expand(scaled: np.ndarray) -> np.ndarray:
    return np.concatenate([scaled, scaled**2], axis=1)


def fit(features: np.ndarray, labels: np.ndarray) -> Classifier:
    """Ridge-penalised logistic regression by Newton steps.

    Without rows the odds are even; with rows of one class only, its smoothed share.
    """
    n = len(labels)
    share = (labels.sum() + 0.5) / (n + 1)
    bias = float(np.log(share / (1 - share)))
    width = 2 * len(FEATURES)
    if not n or labels.min() == labels.max():
        nothing = np.zeros(len(FEATURES))
        return Classifier(nothing, nothing + 1, np.zeros(width), bias)
    means, scales = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)
    x = _expand(np.clip((features - means) / scales, -8, 8))
    x = np.concatenate([x, np.ones((n, 1))], axis=1)
    beta = np.zeros(width + 1)
    beta[-1] = bias
    penalty = np.full(width + 1, RIDGE)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - penalty * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        # Short steps where the odds saturate.
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(means, scales, beta[:-1], float(beta[-1]))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = text_features(part.column("text"))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [part.column("good"), lists.cast(pa.list_(pa.float64()))], ["good", "features"]
            )


def fit_classifier(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", fit_rows: int = FIT_ROWS,
) -> Classifier:
    """Fits on ``fit_rows`` labelled documents at most, taken by a hash of their ids.

    Labels are 0 or 1; a document labelled twice counts with its mean, rounded up
    from a half. Null ids and labels are left out. Only the sample's features
    come to the driver: FIT_ROWS short rows at any volume.
    """
    rated = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    rated = rated.groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("good"))
    sample = rated.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    # The sample is bounded by fit_rows, so it goes to the texts.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(sample), "id").select("good", "text")
    rows = chosen.mapInArrow(_featurise, "good double, features array<double>").toPandas()
    if not len(rows):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(rows["features"].to_list()), rows["good"].to_numpy())


def _scorer(model: Classifier, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                odds = model.log_odds(text_features(part.column(text_col)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(odds)], [*part.schema.names, EVIDENCE]
                )

    return run


EVIDENCE = "_text_log_odds"


def with_evidence(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` with the classifier's log odds in the column EVIDENCE."""
    schema = T.StructType([*docs.schema.fields, T.StructField(EVIDENCE, T.DoubleType())])
    return docs.mapInArrow(_scorer(model, text_col), schema)


def _probability(log_odds):
    return 1 / (1 + F.exp(-log_odds))


def _strength(means: DataFrame, mean: str, count: str, centre: str) -> float:
    """Documents that a prior counts for, by moments over the groups.

    Groups that differ by no more than chance would give an endless prior, groups that
    differ as much as documents do a weak one; both ends are bounded.
    """
    row = means.agg(
        F.sum(F.col(count) * F.pow(F.col(mean) - F.col(centre), 2)).alias("spread"),
        F.sum(F.col(centre) * (1 - F.col(centre))).alias("chance"),
        F.sum(F.col(count) * F.col(centre) * (1 - F.col(centre))).alias("whole"),
        F.sum(F.pow(F.col(count), 2)).alias("squares"),
        F.sum(count).alias("n"),
    ).first()
    if not row["n"] or not row["whole"]:
        return STRONGEST
    base = row["whole"] / row["n"]
    room = row["n"] - row["squares"] / row["n"]
    between = (row["spread"] - row["chance"]) / room if room > 0 else 0.0
    if between <= base / (STRONGEST + 1):
        return STRONGEST
    return float(np.clip(base / between - 1, WEAKEST, STRONGEST))


def path_sums(scored: DataFrame, host_col: str, path_col: str) -> DataFrame:
    """(host, path, n, good): documents and expected good ones, summed in the tasks."""
    p = _probability(F.col(EVIDENCE))
    groups = scored.groupBy(F.col(host_col).alias("host"), F.col(path_col).alias("path"))
    return groups.agg(F.count("*").alias("n"), F.sum(p).alias("good"))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    threshold: float = 0.5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``docs`` with text_odds, host_mean, path_mean, quality and kept.

    The classifier gives log odds for each text. Its probabilities are summed per
    host and path. The global mean is the prior of every host, a host's
    posterior that of its paths; the strength of both priors comes from how much hosts
    and paths differ. A document's prior is its path's posterior without its own
    share; its evidence is its log odds less those of the global mean. It is kept
    if the resulting probability reaches ``threshold``.

    Null and empty texts have no evidence but that of a text without words. A
    null host or path is a group of its own. Rows that repeat an id are judged
    one by one; very long texts are read whole. Without labels all odds are even and all documents are kept. No rows
    give no rows. Columns of ``docs`` with the names of results are replaced.
    """
    results = ["text_odds", "host_mean", "path_mean", "quality", "kept"]
    own = [EVIDENCE, "_host", "_path", "_host_mean", "_n", "_good"]
    clashing = {c: fresh(f"{c}_of_docs", docs) for c in docs.columns if c.lower() in own}
    if clashing:
        # Columns called like ours give way meanwhile.
        named = [clashing.get(c, c) for c in (id_col, text_col, host_col, path_col)]
        rated = labels.withColumnsRenamed({id_col: named[0]})
        judged = judge_quality(docs.withColumnsRenamed(clashing), rated, *named, threshold, fit_rows)
        return judged.withColumnsRenamed({new: c for c, new in clashing.items()})
    plain = docs.drop(*[c for c in results if c not in (host_col, path_col, text_col, id_col)])
    model = fit_classifier(docs, labels, id_col, text_col, fit_rows=fit_rows)
    site = plain.select(F.col(host_col).alias("host"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    paths = materialize(path_sums(with_evidence(site, model), "host", "path"), "paths")
    overall = paths.agg(F.sum("good"), F.sum("n")).first()
    mean = float(np.clip((overall[0] or 0.0) / (overall[1] or 1), 1e-6, 1 - 1e-6)) if overall[1] else 0.5

    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    hosts = hosts.withColumn("raw", F.col("host_good") / F.col("host_n")).withColumn("centre", F.lit(mean))
    host_prior = _strength(hosts, "raw", "host_n", "centre")
    hosts = hosts.select(
        F.col("host").alias("own_host"),
        ((F.col("host_good") + host_prior * mean) / (F.col("host_n") + host_prior)).alias("host_mean"),
    )
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("own_host"))).drop("own_host")
    sites = materialize(sites.withColumn("raw", F.col("good") / F.col("n")), "sites")
    path_prior = _strength(sites, "raw", "n", "host_mean")
    sites = sites.select(
        F.col("host").alias("_host"),
        F.col("path").alias("_path"),
        F.col("host_mean").alias("_host_mean"),
        F.col("n").alias("_n"),
        F.col("good").alias("_good"),
    )

    scored = with_evidence(plain, model, text_col)
    same = F.col(host_col).eqNullSafe(F.col("_host")) & F.col(path_col).eqNullSafe(F.col("_path"))
    joined = scored.join(sites, same)
    evidence = F.col(EVIDENCE)
    others = (
        F.greatest(F.lit(0.0), F.col("_good") - _probability(evidence)) + path_prior * F.col("_host_mean")
    ) / (F.col("_n") - 1 + path_prior)
    prior = F.least(F.greatest(others, F.lit(1e-6)), F.lit(1 - 1e-6))
    base = float(np.log(mean / (1 - mean)))
    odds = evidence - F.lit(base) + F.log(prior / (1 - prior))
    return joined.select(
        *plain.columns,
        evidence.alias("text_odds"),
        F.col("_host_mean").alias("host_mean"),
        prior.alias("path_mean"),
        _probability(odds).alias("quality"),
        (_probability(odds) >= threshold).alias("kept"),
    )
