"""The incremental job: whatever files are new in the sources, shaped and loaded into their tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardloom.plans import tables
from wardloom.plans.tables import TableLoad
from wardloom.sinks.report import LoadReport
from wardloom.sinks.snapshot import LoadCounts, SnapshotTable
from wardloom.streaming.upsert import start_stream

Shape = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Source:
    """A folder that files are dropped into, and the tables that are loaded from it.

    Which files were read is remembered, not which keys: another day of a known user is new.
    """

    name: str
    folder: str
    schema: T.StructType
    loads: tuple[tuple[TableLoad, Shape], ...]
    file_format: str = "parquet"


def newest(load: TableLoad, order_by: str) -> TableLoad:
    """``load`` with the rule that rows of a key with the highest ``order_by`` stand, whenever they come."""
    return replace(load, on_duplicate="newest", order_by=order_by)


def warehouse_sources(inbox: str, customers: T.StructType, wearables: T.StructType, provider: T.StructType, order_by: str) -> tuple[Source, ...]:
    """The three sources below ``inbox`` and the five tables, each row with the column ``order_by`` that says how new it is."""
    facts, profiles = (columns + (order_by,) for columns in (tables.WATCH_FACT_COLUMNS, tables.USER_COLUMNS))
    base = inbox.rstrip("/")
    return (
        Source("wearables", f"{base}/wearables", wearables, (
            (newest(tables.DEVICES, order_by), lambda df: tables.devices(df, tables.DEVICE_COLUMNS + (order_by,))),
            (newest(tables.WATCH_FACTS, order_by), lambda df: tables.watch_facts(df, facts)),
        )),
        Source("customers", f"{base}/customers", customers, (
            (newest(tables.USERS, order_by), lambda df: tables.users(df, profiles)),
            (newest(tables.RENEWAL_HISTORY, order_by), lambda df: tables.renewal_history(df, also=(order_by,))),
        )),
        Source("provider", f"{base}/provider", provider, ((newest(tables.PROVIDER, order_by), lambda df: df),)),
    )


def load_new_files(spark: SparkSession, base: str, sources: Iterable[Source], checkpoints: str, report: LoadReport | None = None) -> LoadReport:
    """Load the files that are new in every source into its tables below ``base``; returns the report.

    Each source is a file stream with a checkpoint of its own below ``checkpoints``, run until all that is there has been
    read. A batch is shaped and loaded table by table; every table notes the batch in the commit that holds its
    rows. After a failure the batch runs again, and the tables that have it skip it. With fresh checkpoints all
    files are loaded again, in one batch or many, and leave the same rows (but for rows without a key, which are
    added again).
    """
    report = report or LoadReport(spark)
    for source in sources:
        stream = spark.readStream.schema(source.schema).format(source.file_format).load(source.folder)
        start_stream(stream, _loader(spark, base, source, report), f"{checkpoints.rstrip('/')}/{source.name}", source.name).awaitTermination()
    return report


def _loader(spark: SparkSession, base: str, source: Source, report: LoadReport) -> Callable[[DataFrame, str, int], None]:
    def load(batch: DataFrame, stream: str, batch_id: int) -> None:
        for spec, shape in source.loads:
            table, rows = SnapshotTable(spark, f"{base.rstrip('/')}/{spec.name}"), shape(batch)
            table.create_if_absent(rows, spec.partition_by, spec.keys, spec.buckets)
            if table.applied(source.name, stream) < batch_id:
                report.run(spec.name, _upsert(table, rows, spec, (source.name, stream, batch_id)))

    return load


def _upsert(table: SnapshotTable, rows: DataFrame, spec: TableLoad, applied: tuple[str, str, int]) -> Callable[[], LoadCounts]:
    return lambda: table.upsert(rows, spec.keys, spec.on_duplicate, spec.order_by, applied=applied)
