"""Shards with the mixture of the whole, by proportional stratified interleaving.

Rows are put in a seeded order within their source. The i-th of n rows gets the
fractional rank (2i + 1) / 2n, all rows are ordered by it, and the order is cut into
shards of equal row counts, so each shard holds every source in proportion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import materialize

LAW = "rows"


def _fingerprint(df: DataFrame, seed: int) -> Column:
    """A seeded digest of a row in 32 hex digits; maps, which have no hash, count for nothing."""
    plain = [c for c, kind in df.dtypes if "map<" not in kind]
    parts = [x for c in plain for x in (_col(c), _col(c).isNull())]
    return F.concat(
        *(F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), F.lit(half), *parts))), 16, "0") for half in (1, 2))
    )


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def seeded_order(id_col: str, text_col: str, seed: int) -> Column:
    """32 hex digits that order the rows of a source: an MD5 over seed, id and text."""
    text = F.md5(F.coalesce(_col(text_col), F.lit("")))
    number = F.coalesce(_col(id_col).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), number, text))


def _ranked(rows: DataFrame, within: list[str], order: list[str], count: str, bucket: Column) -> DataFrame:
    """``rows`` with ``before`` and ``members``: ``count`` summed over the earlier and over all
    rows of the same ``within``.

    Rows are dealt by ``within`` and a bucket that follows the order, so a hot key is
    spread over its buckets; only bucket totals are summed along a key.
    """
    dealt = rows.withColumn("bucket", bucket)
    totals = dealt.groupBy(*within, "bucket").agg(F.sum(count).alias("held"))
    along = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *within,
        "bucket",
        F.coalesce(F.sum("held").over(along), F.lit(0)).alias("start"),
        F.sum("held").over(Window.partitionBy(*within)).alias("members"),
    )
    inside = Window.partitionBy(*within, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    found = placed.join(starts, [*within, "bucket"]).withColumn("before", F.col("start") + F.col("inside"))
    return found.drop("bucket", "inside", "start")


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as structs ``doc``, with shard, slot, size and text_crc32.

    The law is ``rows``: counts of shards differ by one at most. ``slot`` numbers
    the rows of a shard from 0 without a gap, in the interleaved order. ``size`` is the
    text's UTF-8 bytes and one; ``text_crc32`` is unsigned.

    Null and empty texts, null ids and null sources (a source of their own) are dealt
    like others. Rows alike in every column are counted once per task, take a run of
    places and get one each. An empty table gives no rows; shards may
    stay empty if there are fewer rows. All columns of ``docs`` are kept inside ``doc``,
    so no name clashes. Texts, however long, are read whole by one hash and move
    only if the caller reads them: the order is made on digests.
    """
    text = F.coalesce(_col(text_col), F.lit(""))
    keyed = docs.select(
        F.struct(*(_col(c) for c in docs.columns)).alias("doc"),
        F.coalesce(_col(source_col).cast("string"), F.lit("")).alias("source"),
        _col(source_col).isNull().alias("unnamed"),
        seeded_order(id_col, text_col, seed).alias("at"),
        _fingerprint(docs, seed).alias("row"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = ["source", "unnamed", "at", "row"]
    alike = materialize(keyed.groupBy(*key).agg(F.count("*").alias("copies")), "shard-rows")
    total = alike.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # About as many buckets as rows in each, whatever the size.
    bits = max(8, math.ceil(math.log2(total + 1) / 2))

    by_hash = F.shiftright(F.conv(F.substring("at", 1, 8), 16, 10).cast("long"), 32 - min(bits, 32))
    ranked = _ranked(alike, ["source", "unnamed"], ["at", "row"], "copies", by_hash)
    # One row for each copy from here on; equal fractions go by source.
    every = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)
    spread = ranked.select(*key, "copies", F.explode(every).alias("copy"), "before", "members")
    fraction = (2 * (F.col("before") + F.col("copy")) + 1).cast("double") / (2 * F.col("members")).cast("double")
    spread = spread.select(
        *key, "copies", "copy", fraction.alias("fraction"), F.lit(1).alias("one"), F.lit(0).alias("all")
    )
    placed = _ranked(
        spread,
        ["all"],
        ["fraction", "unnamed", "source", "at", "row", "copy"],
        "one",
        F.floor(F.col("fraction") * (1 << bits)),
    )
    cut = F.expr(f"((before + 1) * {shards}L - 1) div {max(total, 1)}L").cast("int")
    places = placed.select(*key, "copies", "copy", "before", cut.alias("shard"))
    places = places.withColumn("slot", F.col("before") - F.expr(f"(shard * {total}L) div {shards}L"))
    places = materialize(places.drop("before"), "shard-places")

    result = ["doc", "size", "text_crc32", "shard", "slot"]
    single = keyed.join(places.filter("copies = 1"), key).select(*result)
    several = places.filter("copies > 1")
    if several.isEmpty():
        return single
    # Rows alike in every column are one row with several places.
    again = keyed.join(several.select(*key).distinct(), key, "left_semi")
    again = again.groupBy(*key).agg(*(F.first(c).alias(c) for c in ("doc", "size", "text_crc32")))
    return single.union(again.join(several, key).select(*result))


def write_shards(docs: DataFrame, path: str, shards: int = 16, **options) -> None:
    """Writes ``docs`` as one folder per shard (``shard=0`` and so on): doc and slot, by slot.

    A shard is written by as many tasks as its rows need: ranges of slots follow one another.
    """
    placed = shard_documents(docs, shards, **options)
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("doc", "slot", "shard").write.partitionBy("shard").parquet(path)
