"""Whole rows beside an operator's own columns, whatever names the rows' columns have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROW = "row"


def column(name: str) -> Column:
    """A column by its exact name."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row as one value, with further columns beside it that cannot clash with its own."""
    return docs.select(F.struct(*map(column, docs.columns)).alias(ROW), *[c.alias(name) for name, c in columns.items()])


def unpacked(rows: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The rows' own columns; those in ``changed`` get new values."""
    return rows.select(*[(changed[n] if n in changed else F.col(ROW).getField(n)).alias(n) for n in names])


def text_or_empty(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def digest(text: Column) -> Column:
    """128 bits that tell texts apart."""
    return F.unhex(F.md5(text.cast("binary")))


def row_digest(docs: DataFrame) -> Column:
    """128 bits that tell rows apart by all their columns, in two numbers."""
    every = [column(c) for c in docs.columns]
    return F.struct(F.xxhash64(F.lit(1), *every).alias("a"), F.xxhash64(F.lit(2), *every).alias("b"))
