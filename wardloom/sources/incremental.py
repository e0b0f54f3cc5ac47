"""Incremental reads: only rows past the key committed by the last successful run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.sources.versions import VersionLog


@dataclass
class PendingRead:
    """Rows of one run, and the mark to commit once they are safely loaded."""

    rows: DataFrame
    upper: str | None
    _log: VersionLog
    _number: int

    def commit(self) -> None:
        if self.upper is not None:
            self._log.commit(self._number + 1, {"mark": self.upper})


class Bookmark:
    """The high-water mark of one source, kept below ``folder`` under the source's own name."""

    def __init__(self, spark: SparkSession, folder: str, source: str):
        if not source:
            raise ValueError("a bookmark needs the name of its source")
        self._log = VersionLog(spark, f"{folder.rstrip('/')}/{source}")

    def mark(self) -> str | None:
        content = self._log.latest()[1]
        return content["mark"] if content else None

    def read_new(self, source: DataFrame, key: str, ordered: bool = False, null_keys: str = "error") -> PendingRead:
        """Rows with ``key`` above the mark, up to the highest such key present now.

        The mark only moves forward: the upper bound is the highest key among rows above it, and
        without such rows there is nothing to commit. The bound is fixed before reading, so rows that
        arrive during the load wait for the next run. Both bounds are plain comparisons that reach
        the scan. Rows with a NULL key have no place in the order: they are an error, or with
        ``null_keys="always"`` part of every run. ``ordered`` sorts by the key, ascending.
        """
        if null_keys not in ("error", "always"):
            raise ValueError("null_keys is error or always")
        number, content = self._log.latest()
        key_type, column = source.schema[key].dataType, F.col(key)
        above = column > F.lit(content["mark"]).cast(key_type) if content else column.isNotNull()
        upper = source.filter(above).agg(F.max(key).cast("string")).first()[0]
        if null_keys == "error" and not source.filter(column.isNull()).isEmpty():
            raise ValueError(f"rows without a {key} would never be read")
        wanted = F.lit(False) if upper is None else above & (column <= F.lit(upper).cast(key_type))
        rows = source.filter(wanted | column.isNull() if null_keys == "always" else wanted)
        return PendingRead(rows.orderBy(key) if ordered else rows, upper, self._log, number)
