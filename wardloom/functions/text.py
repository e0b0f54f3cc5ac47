"""Text helpers: cutting into records, newline removal, custom scorers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# How each kind of note file separates its records.
NEWLINE = "\n"
FOLLOW_UP_DELIMITER = "-" * 100
DISCHARGE_DELIMITER = "-" * 55


def literal_pattern(delimiter: str) -> str:
    """A regular expression that matches exactly ``delimiter``."""
    return "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def cut_records(text: Column, delimiter: str) -> Column:
    """Array of the non-empty pieces of ``text`` between literal delimiters (blank pieces stay)."""
    return F.filter(F.split(text, literal_pattern(delimiter)), lambda piece: piece != "")


def strip_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def score_with(make_scorer: Callable[[], Callable[[str], float]]) -> Callable[[Column], Column]:
    """Wrap any text scorer as a column function.

    ``make_scorer`` runs once per Python worker batch stream, so a model is loaded there and not
    shipped with every row. NULL text scores NULL.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for texts in batches:
            yield texts.map(scorer, na_action="ignore").astype("float64")

    return score
