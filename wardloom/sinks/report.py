"""The load report: one row per loaded table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from wardloom.sinks.snapshot import LoadCounts

log = logging.getLogger(__name__)

SCHEMA = (
    "table string, rows_in bigint, rows_deleted bigint, rows_out bigint, "
    "started timestamp, ended timestamp, error string"
)
CLOCK = "%H:%M:%S"


class LoadReport:
    """Collects what each load did; a failed load is noted and its error raised again."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._rows: list[tuple] = []

    def run(self, table: str, load: Callable[[], LoadCounts]) -> LoadCounts:
        started = datetime.now(timezone.utc)
        log.info("%s started %s", table, started.strftime(CLOCK))
        try:
            counts = load()
        except Exception as error:
            self._rows.append((table, None, None, None, started, datetime.now(timezone.utc), str(error)))
            raise
        ended = datetime.now(timezone.utc)
        log.info("%s ended %s", table, ended.strftime(CLOCK))
        self._rows.append((table, counts.rows_in, counts.rows_deleted, counts.rows_out, started, ended, None))
        return counts

    def to_df(self, columns: Sequence[str] = ()) -> DataFrame:
        """One row per load of this run."""
        report = self._spark.createDataFrame(self._rows, SCHEMA)
        return report.select(*columns) if columns else report
