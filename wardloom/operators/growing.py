"""A corpus that grows: records keep their numbers, new files take the numbers above."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wardloom.operators.corpus import Corpus, number_records
from wardloom.session import Intermediates
from wardloom.sinks.snapshot import SnapshotTable
from wardloom.sources.text import SUFFIX, as_written, list_text_files


class GrowingCorpus:
    """The records of a folder that files are added to, kept as a table ``(idx, text, file)`` below ``root``.

    Numbers are given once and stay. Draws from the first ``size`` records are the same whenever they are repeated,
    whatever has been added since. A file counts once it has been taken in; a change of it is not seen.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._records = SnapshotTable(spark, f"{root.rstrip('/')}/records")

    def size(self) -> int:
        return self._records.rows() if self._records.exists() else 0

    def take_in(self, folder: str, delimiter: str, suffix: str = SUFFIX) -> int:
        """Number the records of files not seen before, in order of path; returns the new size.

        Records and the files they come from are committed together, so an interrupted run leaves the corpus as
        it was, and of two runs at once one fails.
        """
        with Intermediates(self.spark):
            listed = list_text_files(self.spark, folder, suffix)
            if self._records.exists():
                listed = listed.join(self._records.read().select("file").distinct(), "file", "left_anti")
            new = [as_written(row.file) for row in listed.collect()]  # the driver lists folders anyway
            if new:
                found, begin = number_records(self.spark, new, delimiter, suffix), self.size()
                rows = found.records.select((F.col("idx") + begin).alias("idx"), "text", "file")
                self._records.create_if_absent(rows).append(rows)
        return self.size()

    def corpus(self, size: int | None = None) -> Corpus:
        """The first ``size`` records; all that are there now without it."""
        size = self.size() if size is None else size
        if size > self.size():
            raise ValueError(f"the corpus has {self.size()} records")
        if not size:
            raise ValueError("the corpus holds no record to draw from")
        return Corpus(self._records.read().filter(F.col("idx") < size).select("idx", "text"), size)
