"""Random assignment as a join: every row draws one entry of a numbered table, repeatably."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import hash_pick
from wardloom.operators.corpus import Corpus
from wardloom.operators.numbering import running_offsets


def with_pick(rows: DataFrame, fields: Sequence[str], salt: str, corpus: Corpus) -> DataFrame:
    """Append ``idx``: the record each row draws, uniform and with replacement."""
    corpus.require_records()
    return rows.withColumn("idx", hash_pick([F.col(f) for f in fields], salt, corpus.size))


def assign_text(rows: DataFrame, fields: Sequence[str], salt: str, corpus: Corpus, name: str = "notes") -> DataFrame:
    """Append the drawn record's text.

    An equi-join on the record number: draws are uniform, so no number is hot unless the corpus
    is tiny, and then it is broadcast (or its few partitions are split by adaptive execution). Only records that
    some row drew take part.
    """
    drawn = with_pick(rows, fields, salt, corpus)
    texts = corpus.drawn(drawn.select("idx").distinct())
    return drawn.join(texts.withColumnRenamed("text", name), "idx").drop("idx")


def assign_key(rows: DataFrame, fields: Sequence[str], salt: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Append a key drawn from the distinct values of ``keys[key]``."""
    numbered = running_offsets(
        keys.select(F.col(key).alias(name)).dropna().distinct().withColumn("n", F.lit(1).cast("long")), [name], name="idx"
    )
    total = numbered.count()
    if not total:
        raise ValueError("there is no key to draw from")
    drawn = rows.withColumn("idx", hash_pick([F.col(f) for f in fields], salt, total))
    return drawn.join(numbered.drop("n"), "idx").drop("idx")
