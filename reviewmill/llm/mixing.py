"""Mixing sources to target weights by temperature, realised as block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.rows import column, fresh, mark
from reviewmill.session import materialize

# Blocks a source is dealt to. Their number is fixed, so the order of a source's
# blocks is a small table at any volume; a block grows with its source.
BLOCKS = 4096
# Bisection levels in all, and how many of them one pass over the shares decides.
LEVELS, LEVELS_A_PASS = 30, 6


def word_count(text: Column) -> Column:
    """Words between ASCII white space; the default token count."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_tokens(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    """(source, tokens) of sources with any tokens; null is a source of its own."""
    found = docs.select(F.col(source_col).alias("source"), tokens.alias("tokens"))
    return found.groupBy("source").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")


def _meets(shares: DataFrame, exponents: list[float], budget: float, entropy, repeats) -> list[bool]:
    """Whether each exponent keeps the weights flat enough, in one pass."""
    sums = []
    for i, x in enumerate(exponents):
        power = F.pow("share", F.lit(x))
        sums.append(F.sum(power).alias(f"z{i}"))
        sums.append(F.sum(power * F.log("share")).alias(f"e{i}"))
    row = shares.agg(*sums, F.min("share").alias("least"), F.sum("tokens").alias("total")).first()
    out = []
    for i, x in enumerate(exponents):
        z = row[f"z{i}"]
        flat = math.log(z) - x * row[f"e{i}"] / z
        most = row["least"] ** (x - 1) / z * budget / row["total"]
        # Both fall as the exponent grows: entropy asks for a small one, the
        # repetition limit for a large one.
        out.append(flat >= entropy if entropy is not None else most > repeats)
    return out


def _bisect(shares: DataFrame, budget: float, entropy=None, repeats=None) -> float:
    """The largest exponent in [0, 1] with enough entropy, or the smallest within
    the repetition limit; 0 or 1 if no exponent gets there."""
    low, high = 0.0, 1.0
    ends = _meets(shares, [low, high], budget, entropy, repeats)
    if not ends[0]:
        return low
    if ends[1]:
        return high
    for _ in range(LEVELS // LEVELS_A_PASS):
        steps = 1 << LEVELS_A_PASS
        inner = [low + (high - low) * i / steps for i in range(1, steps)]
        holds = [True, *_meets(shares, inner, budget, entropy, repeats), False]
        first, last = 0, steps
        while last - first > 1:
            middle = (first + last) // 2
            if holds[middle]:
                first = middle
            else:
                last = middle
        low, high = low + (high - low) * first / steps, low + (high - low) * last / steps
    return low if entropy is not None else high


def mixing_exponent(
    sources: DataFrame,
    budget: float,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
) -> float:
    """The exponent that turns token shares into weights proportional to share ** exponent.

    ``entropy_share`` asks for an entropy of at least that part of the largest one
    possible, log(number of sources). ``max_repeats`` limits how often any source is
    repeated for ``budget`` tokens, and wins if both cannot be met. Without a
    target the exponent is 1: natural shares.
    """
    total = sources.agg(F.sum("tokens"), F.count("*")).first()
    if not total[1]:
        return 1.0
    shares = sources.withColumn("share", F.col("tokens") / F.lit(float(total[0])))
    exponent = 1.0
    if entropy_share is not None:
        exponent = _bisect(shares, budget, entropy=entropy_share * math.log(total[1]) - 1e-12)
    if max_repeats is not None:
        exponent = max(exponent, _bisect(shares, budget, repeats=max_repeats))
    return exponent


def weigh_sources(
    sources: DataFrame, budget: int | None, entropy_share: float | None, max_repeats: float | None
) -> DataFrame:
    """(source, tokens, weight, target): whole target tokens that share the budget."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    exponent = mixing_exponent(sources, budget, entropy_share, max_repeats)
    powered = sources.withColumn("power", F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent)))
    norm = powered.agg(F.sum("power")).first()[0] or 1.0
    weight = F.col("power") / F.lit(norm)
    target = F.round(weight * F.lit(float(budget))).cast("long")
    return powered.select("source", "tokens", weight.alias("weight"), target.alias("target"))


def _order(seed: int, *columns) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def mix_sources(
    docs: DataFrame,
    budget: int | None = None,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tokens: Column | None = None,
    seed: int = 17,
) -> DataFrame:
    """A row per copy of a document in the mix: doc_id, source, pass, block, rank, tokens, weight.

    A source with target T and S tokens gives floor(T / S) whole passes and a last
    one that stops once the rest of T is reached: every pass is an own
    permutation of the source's blocks (``rank`` orders them), and within a block of
    its documents. So each source comes within one document of its target.
    ``budget`` is in tokens, all of the input's by default.

    Documents without tokens (null, empty, no words) belong to the first pass of
    their source and cost nothing; those of a source without any tokens form no
    part of the mix's shares but are kept once. A null source is a source of its own. Rows that repeat an id are
    separate documents of that id. An empty table gives no rows.

    Blocks are summed in the tasks; only the order of at most BLOCKS block sums a
    source, and the documents of the one block per source in which the last
    pass stops, are put in a row.
    """
    count = word_count(F.col(text_col)) if tokens is None else tokens
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count.alias("tokens")
    ).withColumn("block", F.pmod(_order(seed, "doc_id"), F.lit(BLOCKS)).cast("int"))
    rows = materialize(rows, "mix-rows")
    sums = materialize(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    sources = materialize(sums.groupBy("source").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"), "mix-sources")
    weights = weigh_sources(sources, budget, entropy_share, max_repeats)
    # Whole passes, and the tokens that the last one has to bring.
    weights = weights.select(
        "source",
        "weight",
        F.expr("target div tokens").alias("passes"),
        F.expr("target % tokens").alias("rest"),
    )
    weights = materialize(weights, "mix-weights")

    last = sums.join(weights, sums.source.eqNullSafe(weights.source)).select(
        sums.source, "block", "tokens", "passes", "rest"
    )
    last = last.withColumn("rank", _order(seed, F.col("passes"), F.col("block")))
    ordered = Window.partitionBy("source").orderBy("rank", "block")
    before = F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    last = last.withColumn("before", F.coalesce(before, F.lit(0)))
    # Blocks of the last pass: whole ones, and the one in which it stops.
    last = materialize(
        last.filter("before < rest").select(
            "source", "block", (F.col("before") + F.col("tokens") > F.col("rest")).alias("cut"),
            (F.col("rest") - F.col("before")).alias("room"),
        ),
        "mix-last",
    )

    placed = rows.join(weights.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own")), "left")
    placed = placed.drop("own").withColumn("passes", F.coalesce("passes", F.lit(1)))
    final = placed.join(
        last.toDF("own", "own_block", "cut", "room"),
        F.col("source").eqNullSafe(F.col("own")) & (F.col("block") == F.col("own_block")),
        "left",
    ).drop("own", "own_block")
    whole = F.when((F.col("passes") == 0) & (F.col("tokens") == 0), 1).otherwise(
        F.col("passes") + F.when(F.col("cut") == F.lit(False), 1).otherwise(0)
    )
    final = final.withColumn("whole", F.when(F.col("tokens") == 0, 1).otherwise(whole))
    columns = ["doc_id", "source", "pass", "block", "tokens", "weight"]
    full = final.filter("whole > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))
    )
    within = Window.partitionBy("source", "block").orderBy(_order(seed, F.lit("doc"), F.col("doc_id")), "doc_id", "tokens")
    spent = F.coalesce(F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = (
        final.filter("cut AND tokens > 0")
        .withColumn("spent", spent)
        .filter("spent + tokens <= room")
        .withColumn("pass", F.col("passes").cast("long"))
    )
    copies = full.select(*columns).union(part.select(*columns))
    return copies.withColumn("rank", _order(seed, F.col("pass"), F.col("block")))


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, once per copy.

    Where ids repeat, rows are told apart by id and text, and rows that repeat both
    stand for one another, so the budget holds for rows.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    if docs.groupBy(column(id_col)).count().filter("count > 1").isEmpty():
        return _copied(docs, mix_sources(docs, **options), id_col)
    name = fresh("mark", docs)
    marked = docs.withColumn(name, mark(id_col, text_col))
    copies = mix_sources(marked, **{**options, "id_col": name})
    alike = materialize(marked.groupBy(name).count().filter("count > 1").select(name), "alike-rows")
    one = marked.join(alike, name, "left_anti").unionByName(
        marked.join(alike, name, "left_semi").dropDuplicates([name])
    )
    return _copied(one, copies, name).drop(name)


def _copied(docs: DataFrame, copies: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs``, one for each key, as often as the mix has them."""
    own, times = fresh("own_key", docs), fresh("times", docs)
    counts = copies.groupBy("doc_id").agg(F.count("*").cast("int"))
    counts = materialize(counts, "mix-copies").toDF(own, times)
    found = docs.join(counts, column(key).eqNullSafe(F.col(own)))
    found = found.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return found.drop(own, times)
