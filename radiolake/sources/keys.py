"""The keys of stored packets, apart from the packets: what a batch is checked against.

Layout: v=V/batch=N, rows sorted by key, files as large as the rows ask for. A batch replaces its own
folder and reads only earlier batches; the history itself is never read or listed. A batch takes from
the stored keys those that it has too, so that what goes on to the check is no larger than the batch.
compact_keys, called when there are many small batches, rewrites all but the last as one, in a new
version that readers turn to once it is marked whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolake.operators.dedup import keyed_rows
from radiolake.schemas import PACKET_HISTORY, PACKET_KEY
from radiolake.sources.storage import delete, exists, numbered, write_new

#: The mark of a version that is whole; a name that readers of parquet skip.
_WHOLE = "_whole"

_STORED = T.StructType(
    [T.StructField(k, PACKET_HISTORY[k].dataType) for k in PACKET_KEY]
    + [T.StructField("batch", T.LongType())]
)


def _version(spark: SparkSession, path: str) -> str:
    """The newest version that is whole. No file names it, so none can be cut off; there are two at most."""
    whole = [v for v in numbered(spark, path, "v") if v == 0 or exists(spark, f"{path}/v={v}/{_WHOLE}")]
    return f"{path}/v={max(whole, default=0)}"


def _write(keys: DataFrame, folder: str) -> None:
    dealt = keys.hint("rebalance", *PACKET_KEY).sortWithinPartitions(*PACKET_KEY)
    dealt.write.mode("overwrite").parquet(folder)


def write_keys(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep the whole keys of the rows stored with a batch."""
    folder = f"{_version(rows.sparkSession, path)}/batch={batch_id}"
    _write(keyed_rows(rows).select(*PACKET_KEY), folder)


def drop_keys(spark: SparkSession, path: str, batch_id: int) -> None:
    delete(spark, f"{_version(spark, path)}/batch={batch_id}")


def _all_keys(spark: SparkSession, path: str) -> DataFrame:
    place = _version(spark, path)
    if not exists(spark, place):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(place)


def earlier_keys(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The keys of `batch`, which is read for them, that earlier batches have stored.

    Where the batch's keys are small enough to be broadcast, as those of a micro-batch, the stored ones
    are only scanned; a larger batch meets them in an exchange of both.
    """
    stored = _all_keys(batch.sparkSession, path).filter(F.col("batch") < batch_id).select(*PACKET_KEY)
    return stored.join(keyed_rows(batch).select(*PACKET_KEY), list(PACKET_KEY), "left_semi")


def compact_keys(spark: SparkSession, path: str) -> None:
    """Rewrite the batches below the last one as one folder, under the highest of their numbers.

    The last batch keeps a folder of its own: its writer may have failed after its keys were stored,
    and then the batch is dropped or comes again. Call it while no writer runs; a failure changes nothing.
    """
    old = _version(spark, path)
    stored = _all_keys(spark, path)
    last = stored.agg(F.max("batch")).first()[0]
    if last is None:
        return
    new = f"{path}/v={int(old.rsplit('=', 1)[1]) + 1}"
    delete(spark, new)  # what a failed call left
    below = stored.filter(F.col("batch") < last)
    before = below.agg(F.max("batch")).first()[0]
    if before is not None:
        _write(below.select(*PACKET_KEY), f"{new}/batch={before}")
    _write(stored.filter(F.col("batch") == last).select(*PACKET_KEY), f"{new}/batch={last}")
    write_new(spark, f"{new}/{_WHOLE}", "whole")
    delete(spark, old)
