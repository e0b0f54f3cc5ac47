"""Numbering rows at scale: equal rows, and running offsets over an ordered table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardloom.session import materialize

EXPAND_IN_PLACE = 64  # groups up to this many copies are expanded where they are
EXPAND_CHUNK = 10_000  # larger groups are cut into pieces of this many copies and spread


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_equal_rows(df: DataFrame, name: str = "occurrence") -> DataFrame:
    """Append ``name``: 0, 1, 2 ... among rows that are equal in every column.

    Equal rows are counted with map-side combining and then written out again by count, so a row
    that makes up a third of the table never meets in one task: its copies are cut into chunks
    and the chunks spread over a fixed number of partitions.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))

    few = counted.filter(F.col("_copies") <= EXPAND_IN_PLACE).select(
        *df.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias(name)
    )
    last_chunk = F.floor((F.col("_copies") - 1) / EXPAND_CHUNK)
    chunks = counted.filter(F.col("_copies") > EXPAND_IN_PLACE).select(
        *df.columns, "_copies", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("_chunk")
    )
    start = F.col("_chunk") * EXPAND_CHUNK
    stop = F.least(start + EXPAND_CHUNK, F.col("_copies")) - 1
    many = chunks.repartition(shuffle_width(df), *df.columns, "_chunk").select(
        *df.columns, F.explode(F.sequence(start, stop)).alias(name)
    )
    return few.unionByName(many)


def running_offsets(counts: DataFrame, order_by: Sequence[str], count: str = "n", name: str = "offset") -> DataFrame:
    """Append ``name``: the sum of ``count`` over all rows before this one in ``order_by`` order.

    Two levels instead of one global window: the rows are range-partitioned and sorted, their
    place is written down, and only one total per range (as many as there are partitions) goes
    through a single task. The result is a written table: it is narrow, used more than once, and
    its size then decides how it is joined.
    """
    ranges = shuffle_width(counts)
    placed = materialize(
        counts.repartitionByRange(ranges, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "offsets",
    ).withColumn("_range", F.shiftright("_place", 33))

    totals = placed.groupBy("_range").agg(F.sum(count).alias("_total"))
    bases = totals.select(
        "_range",
        F.coalesce(F.sum("_total").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    in_range = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    # `bases` has at most `ranges` rows, so this broadcast cannot grow with the data.
    numbered = (
        placed.withColumn("_inner", F.coalesce(F.sum(count).over(in_range), F.lit(0)))
        .join(F.broadcast(bases), "_range")
        .withColumn(name, F.col("_base") + F.col("_inner"))
        .select(*counts.columns, name)
    )
    return materialize(numbered, "offsets")
