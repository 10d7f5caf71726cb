"""Streaming queries that keep tables up to date."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from radiolake.operators.dedup import first_new
from radiolake.plans.tables import Settings, decoded_messages, write_tables
from radiolake.sources.keys import earlier_keys, write_keys
from radiolake.sources.storage import read_text, write_new


def stream_writer(spark: SparkSession, checkpoint: str) -> str:
    """The name under which this checkpoint's batches are counted, fixed when the checkpoint is new.

    Without it a batch that is done could come again under another name, so a name that was cut off is
    an error, not a reason for a new one.
    """
    place = f"{checkpoint}/writer"
    write_new(spark, place, f"stream {uuid.uuid4().hex}")
    name = read_text(spark, place)
    if name is None:
        raise ValueError(f"{place} is empty; restore it from the texts in the tables' _ledger/number")
    return name


def _run(df: DataFrame, write, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Each micro-batch is kept while it is written. The persisted batch is a shortcut only, a lost
    part is computed again from the source."""

    def kept(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(held, batch_id)
        finally:
            held.unpersist()

    writer = df.writeStream.foreachBatch(kept).option("checkpointLocation", f"{checkpoint}/query")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_first_arrival(
    df: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[str] = ("timestamp", "seq"),
    interval: str | None = None,
) -> StreamingQuery:
    """Endless dedup on packet keys with the first arrival kept, also inside a micro-batch.

    Rows are appended to `path`, a folder per micro-batch, replaced on a replay. Each micro-batch is
    cut to the first row per key before its one exchange, then checked against the stored keys that
    it has too, so a hot key costs a row per task. One stream writes to a path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keys = f"{path}_keys"
        fresh = first_new(batch, earlier_keys(batch, keys, batch_id), order)
        folder = f"{path}/batch={batch_id}"
        fresh.write.mode("overwrite").parquet(folder)
        write_keys(batch.sparkSession.read.schema(df.schema).parquet(folder), keys, batch_id)

    return _run(df, write, checkpoint, interval)


def start_ingest(
    messages: DataFrame,
    settings: Settings,
    key_ring: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Start the stream; without an interval it takes what is there and ends.

    Each micro-batch is parsed and decrypted once, kept while the tables are written, and may be
    replayed after a failure: the ledger of the tables knows whether it is done.
    """
    writer = stream_writer(messages.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_tables(batch, settings, out, writer, batch_id)

    return _run(decoded_messages(messages, settings, key_ring), write, checkpoint, interval)
