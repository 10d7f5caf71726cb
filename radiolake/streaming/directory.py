"""The node directory kept in Spark's state: each node's last known values, folded on and on.

The state holds one row per node. A micro-batch writes the nodes it has touched, whole rows, to a
folder of its own, so its cost follows its messages and not the nodes; readers take the last row of
each node. compact_directory folds many such folders into one.

Layout: batch=N for a micro-batch, replaced as a whole when it is replayed; base=N for the last rows
of all batches up to N. A base counts once its write is finished.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from radiolake.operators.nodes import fold_nodes
from radiolake.schemas import NODE_INFO, conform
from radiolake.sources.storage import delete, exists, numbered

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Spark's state store that keeps its rows on disk; its memory does not grow with the nodes.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_BATCH = T.StructType([*NODE_INFO.fields, T.StructField("batch", T.LongType())])


@contextmanager
def state_in(spark: SparkSession, provider: str) -> Iterator[None]:
    """Queries started in this block keep their state so; a query reads the setting as it starts."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def start_directory(
    changes: DataFrame, path: str, checkpoint: str, interval: str | None = None, provider: str = ROCKSDB
) -> StreamingQuery:
    """Fold an endless feed of node changes; without an interval it takes what is there and ends.

    The fold is a streaming aggregate in update mode: it combines before its exchange, so a node with
    a third of a micro-batch's changes leaves a row per task, and meets the state after it. A
    replayed micro-batch finds the state of its start again and writes the same rows. One stream
    writes to a path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        conform(batch, NODE_INFO).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = fold_nodes(changes).writeStream.outputMode("update").foreachBatch(write)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with state_in(changes.sparkSession, provider):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _base(spark: SparkSession, path: str) -> int:
    """The newest finished base; -1 when there is none."""
    done = [n for n in numbered(spark, path, "base") if exists(spark, f"{path}/base={n}/_SUCCESS")]
    return max(done, default=-1)


def _rows(spark: SparkSession, path: str, base: int) -> DataFrame:
    """All rows since the base with their batch, those of the base under its number."""
    batches = [n for n in numbered(spark, path, "batch") if n > base]
    places = [f"{path}/batch={n}" for n in batches] + ([f"{path}/base={base}"] if base >= 0 else [])
    if not places:
        return spark.createDataFrame([], _BATCH)
    read = spark.read.schema(NODE_INFO).parquet(*places)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|base)=(\d+)/[^/]*$", 1)
    return read.select("*", number.cast("bigint").alias("batch"))


def _last(rows: DataFrame) -> DataFrame:
    """The row of the highest batch of each node; a batch has one row of a node at most."""
    values = ", ".join(NODE_INFO.fieldNames()[1:])
    last = rows.groupBy("node_id").agg(F.expr(f"max_by(struct({values}), batch)").alias("last"))
    return last.select("node_id", "last.*")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """The directory as of the last micro-batch."""
    return conform(_last(_rows(spark, path, _base(spark, path))), NODE_INFO)


def compact_directory(spark: SparkSession, path: str) -> None:
    """Fold all batches but the last into a new base; the last one may still be replayed.

    Readers and the stream may go on: the base counts when it is whole, and only then are the folders
    that it holds removed. A reader that began before may miss them and has to read again.
    """
    batches, base = numbered(spark, path, "batch"), _base(spark, path)
    if len(batches) < 2 or batches[-2] <= base:
        return
    below = batches[-2]
    rows = _rows(spark, path, base).filter(F.col("batch") <= below)
    conform(_last(rows), NODE_INFO).write.mode("overwrite").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
    ).parquet(f"{path}/base={below}")
    for number in batches[:-1]:
        delete(spark, f"{path}/batch={number}")
    for number in numbered(spark, path, "base"):
        if number < below:
            delete(spark, f"{path}/base={number}")
