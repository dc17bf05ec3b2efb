"""Exact de-duplication by content hash, with bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.rows import column, keep_one, mark
from reviewmill.session import materialize

SEPARATORS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without separators; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, "")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after normalising. Rows are grouped by a
    128-bit content hash *and* text, straight from the scan: bytes decide, a collision
    splits its group, and copies shrink to one row per task before a text moves. What the
    rows learn about their group they get by hash, without texts. Of a group the row
    with the most code points stays, then the smallest id.

    Null and empty texts and texts of separators alone are equal. Rows that
    repeat an id are rows of their own in ``group_size``; all of them are kept
    if their id is. A null id loses every tie, and is kept only if its
    group has no other. An empty table gives no rows. Other columns are ignored. Very long
    texts are compared whole, and one copy of a task is in memory at a time.
    """
    found = _groups(docs, id_col, text_col, content_hash)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return found.select("doc_id", "keep_id", "group_size", kept, "text_sha256")


# The order of rows as one number, which Spark can aggregate in place: size, then smallest id.
_ORDER = """CAST(size AS DECIMAL(10, 0)) * 36893488147419103232BD
    + coalesce(9223372036854775808BD - CAST(doc_id AS DECIMAL(20, 0)), 0BD)"""
_REST = "(best % 36893488147419103232BD)"
_BEST_ID = f"IF({_REST} = 0, NULL, CAST(9223372036854775808BD - {_REST} AS BIGINT))"


def _groups(docs: DataFrame, id_col: str, text_col: str, content_hash) -> DataFrame:
    """``exact_groups`` with ``mark``, ``hash`` and whether a row is ``first`` in its group's order."""
    base = docs.select(
        column(id_col).cast("long").alias("doc_id"),
        normalised(column(text_col)).alias("content"),
        F.char_length(F.coalesce(column(text_col), F.lit(""))).alias("size"),
        mark(id_col, text_col).alias("mark"),
    )
    base = base.withColumn("hash", content_hash(F.col("content"))).withColumn("order", F.expr(_ORDER))
    texts = base.groupBy("hash", "content").agg(F.max("order").alias("best"), F.count("*").alias("group_size"))
    found = texts.groupBy("hash").agg(
        F.count("*").alias("texts"), F.max("best").alias("best"), F.sum("group_size").alias("group_size")
    )
    found = materialize(found.filter("group_size > 1"), "equal-texts")
    plain = base.select("doc_id", "mark", "hash", "order", F.sha2("content", 256).alias("text_sha256"))
    joined = plain.join(found, "hash", "left")

    def told(rows: DataFrame, keep_id: Column) -> DataFrame:
        return rows.select(
            "doc_id",
            "mark",
            "hash",
            keep_id.alias("keep_id"),
            F.coalesce(F.col("order") == F.col("best"), F.lit(True)).alias("first"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            "text_sha256",
        )

    keep_id = F.when(F.col("texts").isNull(), F.col("doc_id")).otherwise(F.expr(_BEST_ID))
    alone = told(joined.filter("texts IS NULL OR texts = 1"), keep_id)
    collided = found.filter("texts > 1").select("hash")
    if collided.isEmpty():
        return alone
    # Different texts of one hash: a handful in any corpus, if there is one.
    apart = base.join(collided, "hash", "left_semi")
    split = apart.groupBy("hash", "content").agg(F.max("order").alias("best"), F.count("*").alias("group_size"))
    split = apart.join(split, ["hash", "content"]).withColumn("text_sha256", F.sha2("content", 256))
    return alone.union(told(split, F.expr(_BEST_ID)))


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal
    texts, whatever its id. Of rows that repeat id and size the smallest mark stays, of rows
    that repeat id and text any one."""
    groups = _groups(docs, id_col, text_col, F.md5).filter("group_size > 1")
    groups = materialize(groups.select("mark", "first", "text_sha256"), "exact-copies")
    # One row of a group, unless ids repeat.
    stays = groups.filter("first").groupBy("text_sha256").agg(F.min("mark").alias("kept"), F.count("*").alias("n"))
    several = materialize(stays.filter("n > 1"), "repeated-ids")
    alike = groups.filter("first").join(several, "text_sha256").groupBy("mark", "kept").count()
    gone = groups.filter("NOT first").select("mark")
    gone = gone.union(alike.filter("mark <> kept").select("mark"))
    return keep_one(docs, id_col, text_col, gone, alike.filter("mark = kept AND count > 1").select("mark"))
