"""Phrases whose words come together more often than apart.

Counting is by top-order marginalisation: each word starts one window, padded to
LONGEST words, and only these windows are counted. One ROLLUP over the columns of a
window sums them to all shorter phrases, as a phrase occurs as often as windows
begin with it. A first pass keeps upper bounds for the counts of phrases in a hashed
sketch of bounded size; a window ends before a word with which it is too rare. So what
moves are the windows of frequent phrases, as long as the sketch has room.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm.texts import LOWER, PLACES, flat, mix, slices, word_hashes
from reviewmill.session import contained, materialize

LONGEST = 4
WORDS = [f"w{i + 1}" for i in range(LONGEST)]
# Stands for the words that a window lacks; no word is empty.
PAD = ""

# Texts are read in slices of so many bytes, longer ones in stretches between pieces.
SLICE_BYTES = 4 << 20
# The sketch has a counter for every 16 bytes of text within these limits: the larger
# it is, the fewer rare phrases pass for frequent ones. At most 128 MB of bits.
LEAST_BITS, MOST_BITS, BYTES_A_COUNTER = 16, 30, 16
# Counters of one row on their way, and sketched occurrences held in a task.
_RANGE_BITS, _HELD = 16, 3 << 20

# Rows that rank within a language in one task: salts of two rounds before the last.
_SALTS = (256, 4)

_WORD, _BLANK, _BREAK = range(3)
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = _BREAK


def _stretches(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, data, bounds) in which a longer text is cut after a break between pieces."""
    if len(data) <= SLICE_BYTES:
        yield 0, data, bounds
        return
    breaks = np.flatnonzero(_KIND[data] == _BREAK) + 1
    for text, (start, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        while start < end:
            stop = min(end, start + SLICE_BYTES)
            if stop < end:
                last = np.searchsorted(breaks, stop, "right")
                if not last or breaks[last - 1] <= start:
                    last += 1
                stop = min(end, breaks[last - 1]) if last <= len(breaks) else end
            yield text, data[start:stop], np.array([0, stop - start])
            start = stop


class _Words:
    """The words of a stretch: a code for each, equal for equal words of lower-cased bytes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: np.ndarray, lang_hashes: np.ndarray):
        kind = _KIND[data]
        inside = kind == _WORD
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        begins = inside & edge[:-1]
        begins[1:] |= inside[1:] & ~inside[:-1]
        ends = inside & edge[1:]
        ends[:-1] |= inside[:-1] & ~inside[1:]
        starts = np.flatnonzero(begins)
        sizes = np.flatnonzero(ends) + 1 - starts
        places = np.concatenate([[0], np.cumsum(sizes)])
        joined = pa.py_buffer(LOWER[data[inside]])
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), joined])
        coded = coded.dictionary_encode()
        self.words = coded.dictionary
        self.codes = coded.indices.to_numpy().astype(np.int64)
        text = np.searchsorted(bounds, starts, "right") - 1
        self.lang = langs[text]
        piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts]
        follows = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        # Words from each one on in its piece, up to LONGEST.
        self.run = np.ones(len(starts), np.int8)
        for _ in range(LONGEST - 1):
            self.run[:-1][follows] = np.minimum(self.run[1:][follows] + 1, LONGEST)
        own, held = flat(self.words.cast(pa.large_string()))
        self._hashes = word_hashes(own, held[:-1], held[1:])[self.codes]
        self._lang_hashes = lang_hashes[self.lang]

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words that start at these words."""
        total = self._lang_hashes[at]
        for place in range(size):
            total = total + self._hashes[at + place] * PLACES[8 * size + place]
        return mix(total)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, list[str]]]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            named = part.column("lang").dictionary_encode()
            codes = named.indices.to_numpy()
            names = named.dictionary.to_pylist()
            own, held = flat(named.dictionary)
            hashes = word_hashes(own, held[:-1], held[1:])
            data, bounds = flat(part.column("text"))
            for first, some, own_bounds in _stretches(data, bounds):
                yield _Words(some, own_bounds, codes[first : first + len(own_bounds) - 1], hashes), names


def _sketch(bits: int, least: int):
    """Counters of all phrases, in ranges: places within the range and counts, up to ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            places, counts = np.unique(np.concatenate(held), return_counts=True)
            ranges = places >> _RANGE_BITS
            starts = np.flatnonzero(np.diff(ranges, prepend=-1))
            low = (places & ((1 << _RANGE_BITS) - 1)).astype("<u2")
            counts = np.minimum(counts, least).astype("<u2")
            ends = np.append(starts[1:], len(places))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ranges[starts], pa.int32()),
                    pa.array([low[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                    pa.array([counts[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                ],
                ["range", "places", "counts"],
            )

        held, size = [], 0
        for words, _ in _read(batches):
            for count in range(1, LONGEST + 1):
                at = np.flatnonzero(words.run >= count)
                held.append((words.keys(at, count) >> np.uint64(64 - bits)).astype(np.int64))
                size += len(at)
                if size >= _HELD:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    return run


def _frequent(least: int):
    """One row of bits per range: which counters reach ``least``. Rows come in order of ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            bits = np.packbits(sums >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict(
                {"range": pa.array([current], pa.int32()), "bits": pa.array([bits], pa.binary())}
            )

        current, sums = None, None
        for batch in batches:
            for own, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if own != current:
                    if current is not None:
                        yield row()
                    current, sums = own, np.zeros(1 << _RANGE_BITS, np.int64)
                sums[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<u2")
        if current is not None:
            yield row()

    return run


def _bounds_of_counts(rows: DataFrame, least: int) -> tuple[int, np.ndarray]:
    """The sketch: how many bits of a key number a counter, and whether it reaches ``least``."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wanted = math.ceil(math.log2(max(1, size / BYTES_A_COUNTER)))
    bits = min(max(wanted, LEAST_BITS), MOST_BITS)
    parts = rows.mapInArrow(_sketch(bits, least), "range int, places binary, counts binary")
    dealt = parts.repartition("range").sortWithinPartitions("range")
    found = dealt.mapInArrow(_frequent(least), "range int, bits binary")
    whole = np.zeros((1 << bits) // 8, np.uint8)
    step = (1 << _RANGE_BITS) // 8
    # At most 2^30 bits, whatever the corpus.
    for own, some in found.toLocalIterator():
        whole[own * step : (own + 1) * step] = np.frombuffer(some, np.uint8)
    return bits, whole


def _windows(bits: int, shared):
    """Windows with their counts; words that are in no frequent phrase count as the empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value

        def passes(keys: np.ndarray) -> np.ndarray:
            at = keys >> np.uint64(64 - bits)
            return (frequent[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

        for words, names in _read(batches):
            length = np.zeros(len(words.codes), np.int8)
            for size in range(1, LONGEST + 1):
                at = np.flatnonzero((words.run >= size) & (length == size - 1))
                length[at[passes(words.keys(at, size))]] = size
            for size in range(LONGEST + 1):
                at = np.flatnonzero(length == size)
                if len(at):
                    yield _counted(words, names, at, size)

    return run


def _counted(words: _Words, names: list[str], at: np.ndarray, size: int) -> pa.RecordBatch:
    """Different windows of ``size`` words that start ``at`` these words, and how often."""
    key = words.lang[at].astype(np.int64)
    for place in range(size):
        # Different beginnings are numbered anew, so the key never outgrows its 64 bits.
        key = np.unique(key, return_inverse=True)[1] * np.int64(len(words.words)) + words.codes[at + place]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    at = at[first]
    spoken = words.words.cast(pa.large_string())
    parts = [spoken.take(pa.array(words.codes[at + place])) for place in range(size)]
    if parts:
        joined = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
    else:
        joined = pa.array([PAD] * len(at), pa.large_string())
    lang = pa.array(names).take(pa.array(words.lang[at]))
    return pa.RecordBatch.from_arrays([lang, joined.cast(pa.string()), pa.array(counts)], ["lang", "window", "n"])


def phrase_counts(docs: DataFrame, least: int, lang_col: str, text_col: str) -> DataFrame:
    """(lang, words, phrase, f): all phrases of 1 to LONGEST words that occur ``least`` times
    in a language, and one row per language with words = 0, an empty phrase and all words."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    bits, frequent = _bounds_of_counts(rows, least)
    shared = spark.sparkContext.broadcast(frequent)
    windows = rows.mapInArrow(_windows(bits, shared), "lang string, window string, n long")
    # Different windows only from here on; the columns after a window's last word are PAD.
    windows = windows.groupBy("lang", "window").agg(F.sum("n").alias("n"))
    spoken = F.split("window", " ")
    columns = [F.coalesce(F.get(spoken, F.lit(i)), F.lit(PAD)).alias(w) for i, w in enumerate(WORDS)]
    windows = windows.select("lang", *columns, "n")
    rolled = spark.sql(
        f"""SELECT lang, {", ".join(WORDS)}, sum(n) AS f FROM {{windows}}
            GROUP BY lang, ROLLUP ({", ".join(WORDS)})""",
        windows=windows,
    )
    # A column that is rolled up is null; one that a window lacks is PAD.
    size = sum(F.col(w).isNotNull().cast("int") for w in WORDS)
    found = rolled.withColumn("words", size).filter(
        (F.col("words") == 0) | ((F.col("f") >= least) & ~F.array_contains(_present(), PAD))
    )
    return found.select("lang", "words", F.concat_ws(" ", *WORDS).alias("phrase"), "f")


def _present() -> Column:
    return F.filter(F.array(*WORDS), lambda w: w.isNotNull())


def _part(phrase: str, start: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, count), " ")


@contained("collocations")
def collocations(
    docs: DataFrame,
    least: int = 30,
    top: int = 2000,
    absorbed_percent: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
    spaces and tabs into words. Candidates have 2 to LONGEST words and occur a >= ``least``
    times within pieces, overlaps included. Cut after k words into parts that occur l and
    r times, a candidate scores floor(2000000 a / (l + r)); its lowest cut counts, the first of
    equals. A candidate inside a longer one that has ``absorbed_percent`` of its
    occurrences or more is dropped, whether the longer one is dropped or not. Order is by
    score and a, descending, then phrase by bytes. n counts all words of the language.

    A null language is ``und``; null and empty texts and texts of separators alone have no
    words. Repeated rows count each time. An empty table, or one without candidates, gives no
    rows. Other columns are ignored. Texts of any length are read whole, in stretches of
    some megabytes cut between pieces; only a piece longer than that is held in one go.
    """
    counts = materialize(phrase_counts(docs, least, lang_col, text_col), "phrases")
    phrases = counts.filter("words > 0")
    candidates = phrases.filter("words > 1").withColumnRenamed("f", "a")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        _part("phrase", F.lit(1), F.col("k")).alias("head"),
        _part("phrase", F.col("k") + 1, F.col("words")).alias("rest"),
    )
    known = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(known.toDF("lang", "head", "l"), ["lang", "head"])
    cuts = cuts.join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    exact = "CAST({} AS DECIMAL(19, 0))"
    score = F.expr(f"({exact.format('a')} * {exact.format('2000000')}) div ({exact.format('l')} + {exact.format('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest)

    inner = candidates.filter("words > 2").withColumn(
        "size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))
    )
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = inner.select("lang", _part("phrase", F.col("start"), F.col("size")).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    absorbed = F.expr(
        f"{exact.format('around')} * 100 >= {exact.format('a')} * {absorbed_percent}"
    )
    stay = scored.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(absorbed, F.lit(False)))
    stay = stay.select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for salts in _SALTS:
        # The best of each share, so that no task ranks a whole language.
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
        stay = stay.withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= top).drop("rank")
    ranked = stay.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
