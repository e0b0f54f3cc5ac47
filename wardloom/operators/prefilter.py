"""Dropping rows without a partner before they are moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.session import is_small

BITS = 1 << 26  # of the vector: at most 2^20 words of 64, whatever the number of keys


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITS))


def likely_partners(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` does not occur in ``keys``; none that does is lost.

    The keys set bits of a vector whose size does not depend on them, so it is broadcast, and rows are told apart
    where they are. A join on the column has to follow: some rows pass because their hash meets another key's.
    """
    placed = keys.select(_place(column).alias("_bit"))
    vector = placed.groupBy(F.expr("_bit div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_bits"))
    marked = rows.withColumn("_bit", _place(column)).withColumn("_word_of", F.expr("_bit div 64"))
    met = marked.join(F.broadcast(vector), F.col("_word_of") == F.col("_word"))
    return met.filter(F.call_function("bit_get", F.col("_bits"), F.expr("cast(_bit % 64 as int)")) == 1).select(*rows.columns)


def with_partner(rows: DataFrame, partners: DataFrame, column: str) -> DataFrame:
    """Inner join of ``rows`` with ``partners``, written and unique by ``column``.

    Rows stay where they are if the partners are small; otherwise only likely matches are shuffled.
    """
    found, exact = in_place(rows, partners, column)
    return found if exact else found.join(partners, column)


def in_place(rows: DataFrame, partners: DataFrame, column: str) -> tuple[DataFrame, bool]:
    """``with_partner`` as far as no row is shuffled for it, and whether that is all of it."""
    if is_small(partners):
        return rows.join(F.broadcast(partners), column), True
    return likely_partners(rows, partners, column), False
