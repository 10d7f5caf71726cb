"""The packet history: append-only, each key once, safe to replay batch by batch.

Layout: batch=N/ingest_date=D, the date in UTC. append_routed keeps it, the rejected rows and the
refused node descriptions side by side, table=T/batch=N/ingest_date=D, from one pass and one write. A batch replaces its own folder as a whole and is
checked against the keys of earlier batches, which lie in a table of their own, so running the last
batch again gives the same rows. A batch older than the last one stored is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolake.operators.dedup import first_new
from radiolake.schemas import PACKET_HISTORY, PACKET_KEY, conform
from radiolake.sources.keys import drop_keys, earlier_keys, write_keys
from radiolake.sources.storage import delete, exists, numbered, read_text, replace_text

_PLACE = T.StructType(
    [T.StructField("batch", T.LongType()), T.StructField("ingest_date", T.DateType())]
)
_REASON = T.StructType([T.StructField("reject_reason", T.StringType())])
_UTC_DATE = "date_from_unix_date(CAST(floor(unix_micros(timestamp) / 86400000000) AS INT))"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    placed = T.StructType(schema.fields + _PLACE.fields)
    if not exists(spark, path):
        return spark.createDataFrame([], placed)
    return spark.read.schema(placed).parquet(path)


def _replace_batch(df: DataFrame, path: str, schema: T.StructType, batch_id: int) -> None:
    """Write one batch over whatever an earlier attempt left, on whatever dates.

    Rows arrive spread by key, every task holding every date. They are gathered by date, and a date
    too large for one file is split, so a backfill of many dates does not end in dates x tasks
    small files.
    """
    spark = df.sparkSession
    last = _check_turn(spark, path, batch_id)
    placed = _by_date(conform(df, schema))
    placed.write.mode("overwrite").partitionBy("ingest_date").parquet(f"{path}/batch={batch_id}")
    if batch_id > last:
        replace_text(spark, f"{path}/_last", str(batch_id))


def _check_turn(spark: SparkSession, path: str, batch_id: int) -> int:
    """The last batch stored; an older one than that is refused."""
    last = last_batch(spark, path)
    if batch_id < last:
        raise ValueError(f"batch {batch_id} comes after batch {last} is stored in {path}")
    return last


def _by_date(df: DataFrame, *more: str) -> DataFrame:
    placed = df.withColumn("ingest_date", F.expr(_UTC_DATE))
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return placed.hint("rebalance", *more, "ingest_date")
    # A date is dealt over a few tasks, as nothing can split it later.
    return placed.repartition(*more, "ingest_date", F.pmod(F.xxhash64("timestamp"), F.lit(8)))


#: The tables that one pass over a batch fills.
HISTORY, REJECTED, REFUSED_NODES = "packet_history", "rejected", "rejected_nodes"
TABLES = (HISTORY, REJECTED, REFUSED_NODES)


def table_path(out: str, table: str) -> str:
    return f"{out}/table={table}"


def append_routed(rows: DataFrame, out: str, batch_id: int) -> None:
    """Store marked rows, each in the table that its column `table` names; history rows only if new.

    `rows` come from plans.tables.routed_rows. One pass, one exchange and one write: rows of the other
    tables go through the check as keys of their own. What an earlier attempt left of the batch is
    removed first.
    """
    spark = rows.sparkSession
    history = table_path(out, HISTORY)
    last = _check_turn(spark, history, batch_id)
    for table in TABLES:
        delete(spark, f"{table_path(out, table)}/batch={batch_id}")
    stays = F.col("table") == HISTORY
    fresh = first_new(rows, earlier_keys(rows.filter(stays), _keys(history), batch_id), apart=~stays)
    placed = fresh.drop("seq").withColumn("batch", F.lit(batch_id).cast("bigint"))
    _by_date(placed, "table").write.mode("append").partitionBy("table", "batch", "ingest_date").parquet(out)
    if batch_id > last:
        replace_text(spark, f"{history}/_last", str(batch_id))
    _keep_keys(spark, history, batch_id)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, PACKET_HISTORY).drop("ingest_date", "batch")


def last_batch(spark: SparkSession, path: str) -> int:
    """The highest batch written, finished or not; -1 when there is none. Reads one small file.

    Where that file is missing or cut off, the folders are listed.
    """
    noted = read_text(spark, f"{path}/_last")
    return int(noted) if noted else max(numbered(spark, path, "batch"), default=-1)


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove what a failed writer left under a number."""
    delete(spark, f"{path}/batch={batch_id}")
    drop_keys(spark, _keys(path), batch_id)


def _keys(path: str) -> str:
    return f"{path}_keys"


def append_history(rows: DataFrame, path: str, batch_id: int) -> None:
    """Store the rows whose key is new. `rows` are storable packet rows with `seq`; they are read for
    their keys and for themselves, so stage or persist them.

    Cost follows the batch and a scan of the stored keys; the stored packets are not read.
    """
    spark = rows.sparkSession
    fresh = first_new(rows, earlier_keys(rows, _keys(path), batch_id))
    _replace_batch(fresh, path, PACKET_HISTORY, batch_id)
    _keep_keys(spark, path, batch_id)


def _keep_keys(spark: SparkSession, path: str, batch_id: int) -> None:
    """Note the keys that the batch has stored, from what it stored."""
    keys = T.StructType([PACKET_HISTORY[k] for k in PACKET_KEY])
    folder = f"{path}/batch={batch_id}"
    stored = spark.read.schema(keys).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], keys)
    write_keys(stored, _keys(path), batch_id)


def append_rejected(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep what the history cannot hold, with the reason, instead of a log line.

    Out-of-range numbers have no place in the typed columns, so the original message is kept.
    """
    _replace_batch(rows, path, _REJECTED, batch_id)


def append_refused_nodes(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep node descriptions that the directory cannot hold, with the reason."""
    _replace_batch(rows, path, _REFUSED_NODES, batch_id)


def read_refused_nodes(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, _REFUSED_NODES).drop("ingest_date", "batch")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, _REJECTED).drop("ingest_date", "batch")


_REJECTED = T.StructType(
    [
        PACKET_HISTORY[name]
        for name in (
            "timestamp",
            "topic",
            "from_node_id",
            "portnum",
            "gateway_id",
            "mesh_packet_id",
            "raw_service_envelope",
        )
    ]
    + _REASON.fields
)

_REFUSED_NODES = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
    + _REASON.fields
)
