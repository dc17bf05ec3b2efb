"""Rows that have no key of their own: told apart by id and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialize


def column(name: str) -> Column:
    """The column of just this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, frame: DataFrame) -> str:
    """A column name like ``name`` that ``frame`` does not have."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name


def mark(id_col: str, text_col: str) -> Column:
    """128 bits of a row's id and text as hex digits; null texts count as empty."""
    number = F.coalesce(column(id_col).cast("string"), F.lit("-"))
    return F.md5(F.concat(number, F.lit(":"), F.coalesce(column(text_col), F.lit(""))))


def keep_one(docs: DataFrame, id_col: str, text_col: str, gone: DataFrame, alike: DataFrame) -> DataFrame:
    """``docs`` without the rows marked in ``gone``, and with one row for each mark in ``alike``.

    Both hold marks in a column ``mark``. Texts move only if the marks are too
    many for a broadcast; marks in ``alike`` stand for rows that repeat id and text.
    """
    name = fresh("mark", docs)
    keyed = docs.withColumn(name, mark(id_col, text_col))
    alike = alike.select(F.col("mark").alias(name))
    out = gone.select(F.col("mark").alias(name)).distinct()
    if alike.isEmpty():
        return keyed.join(out, name, "left_anti").drop(name)
    alike = materialize(alike, "alike-rows")
    again = keyed.join(alike, name, "left_semi").dropDuplicates([name])
    return keyed.join(out.union(alike), name, "left_anti").union(again).drop(name)
