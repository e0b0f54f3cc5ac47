"""Surrogate ids and repeatable random picks as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits are 60 bits: fits a bigint, and reaches every record of a corpus far beyond 2^32.
HASH_DIGITS = 15


def encode_fields(columns: Sequence[Column]) -> Column:
    """One string per row that no other combination of field values shares.

    Each field carries its length, and NULL has its own mark, so neither a separator inside a
    value nor a NULL in another place can make two different rows equal.
    """
    fields = []
    for column in columns:
        text = column.cast("string")
        fields.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat_ws("|", *fields)


def surrogate_id(columns: Sequence[Column]) -> Column:
    """32 hex digits derived from the given fields: the same fields give the same id on every run."""
    return F.md5(encode_fields(columns))


def random_id() -> Column:
    """A fresh 32-hex-digit id per row and run."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def hash_pick(columns: Sequence[Column], salt: str, choices: Column | int) -> Column:
    """A number in ``0 .. choices - 1``, uniform over rows and fixed for equal fields and salt."""
    digest = F.md5(F.concat(encode_fields(columns), F.lit("|" + salt)))
    number = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")
    return F.pmod(number, F.lit(choices).cast("long") if isinstance(choices, int) else choices)


PROVIDER_COUNT = 2000  # fixed value: provider numbers are drawn from 1 .. 2000


def provider_pick(columns: Sequence[Column], salt: str, key_type: str = "bigint") -> Column:
    """A provider number from the fixed range, typed like the provider key so that it joins."""
    return (hash_pick(columns, salt, PROVIDER_COUNT) + 1).cast(key_type)
