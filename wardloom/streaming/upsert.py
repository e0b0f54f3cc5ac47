"""Incremental loads as a stream: files not seen before are loaded into tables, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wardloom.sinks.snapshot import SnapshotTable

STREAM_ID = "sql.streaming.queryId"  # set by Spark while a batch runs; the same for every run of a checkpoint


def start_stream(
    source: DataFrame, load: Callable[[DataFrame, str, int], None], checkpoint: str, name: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start calling ``load(batch, stream, batch_id)`` for every micro-batch; ``stream`` names the checkpoint.

    The default trigger takes all that is there, then stops.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        load(batch, batch.sparkSession.sparkContext.getLocalProperty(STREAM_ID) or checkpoint, batch_id)

    return (
        source.writeStream.queryName(name)
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_upsert(
    source: DataFrame,
    table: SnapshotTable,
    keys: Sequence[str],
    checkpoint: str,
    name: str,
    on_duplicate: str = "keep_all",
    order_by: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start upserting every micro-batch of ``source`` into ``table``.

    ``checkpoint`` (one per stream, in shared storage) remembers what was read. The table records
    the checkpoint's id and the batch number in the same commit as the rows, so a
    batch that is replayed after a failure is skipped. A new checkpoint has a new id: its batches
    are all loaded, also those that an earlier checkpoint had loaded, which for an upsert changes
    nothing, but for rows without a key. With ``on_duplicate="newest"``, files that come late, or come again in one large
    batch, do not put older rows in the place of newer ones.
    """

    def load(batch: DataFrame, stream: str, batch_id: int) -> None:
        if table.applied(name, stream) < batch_id:
            table.upsert(batch, keys, on_duplicate, order_by, applied=(name, stream, batch_id))

    return start_stream(source, load, checkpoint, name, trigger)
