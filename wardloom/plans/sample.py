"""A small lexicon and word lists in the vocabulary of the sample documents.

The published lexicon is a file the user brings; these stand in for it when the operators run on
the sample tables, and are chosen so that every rule fires there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardloom.functions.rules import Rules

LEXICON = {
    "the": 1.9, "of": -2.5, "and": 2.7, "was": 3.1, "in": -1.3, "that": 0.9, "is": -0.6, "for": 1.1, "le": -1.7,
    "der": 2.2, "des": -0.8, "que": 1.5, "worthless": -2.1, "stupid": -2.4, "th": 0.7, "re": -1.1,
}

RULES = Rules(
    intensifiers=("to", "la", "les"),
    dampeners=("en", "on", "die"),
    dampening_pairs=("it it", "to to", "de de", "an on"),
    negations=("no", "et", "und", "are", "el", "it"),
    never="de",
    never_followers=("la", "un", "this"),
    least="at",
    least_exceptions=("by", "from"),
    contrast="with",
    kind_of=("th", "er"),
    idioms=(("of the", 3.0), ("de la", 1.5), ("by the", -2.0), ("to be", 2.5), ("on la de", -1.5)),
)


def lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{token}', {valence}D)" for token, valence in LEXICON.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS l(token, valence)")
