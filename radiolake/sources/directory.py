"""The node directory: one row per node, in buckets of its id, kept as numbered snapshots.

Layout: batch=N/bucket=K holds a bucket as batch N left it; v=N is a small table that names the batch of
each bucket and its rows. A batch writes only the buckets with a node that it changes, then v=N, which
counts once its write is finished. So readers always see a finished snapshot, and a batch that runs
again starts from the snapshot before it and gives the same one.

A directory begins with one bucket. When the snapshot has grown beyond BUCKET_ROWS a bucket, the next
batch deals all nodes to twice as many, or as often twice as it takes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolake.operators.nodes import fold_nodes, merge_folded
from radiolake.schemas import NODE_INFO, conform
from radiolake.session import staged
from radiolake.sources.storage import delete, finished_times, finished_versions

#: Nodes of a bucket in the mean, at most, when a batch begins.
BUCKET_ROWS = 500_000
#: A snapshot so many hours older than the newest one goes with the next batch.
KEEP_HOURS = 24

_PLACES = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("batch", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("rows", T.LongType()),
    ]
)


def _places(spark: SparkSession, path: str, *versions: int) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], _PLACES)
    return spark.read.schema(_PLACES).parquet(*[f"{path}/v={v}" for v in versions])


def _folder(path: str, bucket: int, batch: int) -> str:
    return f"{path}/batch={batch}/bucket={bucket}"


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], NODE_INFO)
    return spark.read.schema(NODE_INFO).parquet(*folders)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    places = _places(spark, path, *finished_versions(spark, path)[-1:]).collect()
    return _read(spark, [_folder(path, p.bucket, p.batch) for p in places])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("node_id"), F.lit(buckets)).cast("int")


def _write(nodes: DataFrame, folder: str, buckets: int) -> None:
    """The rows of a bucket in few files; a bucket too large for one is split."""
    placed = conform(nodes, NODE_INFO).withColumn("bucket", _bucket(buckets))
    if nodes.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        placed = placed.hint("rebalance", "bucket")
    else:  # a bucket is dealt over a few tasks, as nothing can split it later
        placed = placed.repartition("bucket", F.pmod(F.xxhash64("node_id", F.lit(1)), F.lit(8)))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)


def _grown(places: list[Row], bucket_rows: int) -> int:
    """The number of buckets for the nodes stored."""
    buckets, rows = places[0].buckets, sum(p.rows for p in places)
    while rows > buckets * bucket_rows:
        buckets *= 2
    return buckets


def write_nodes(
    changes: DataFrame,
    path: str,
    batch_id: int,
    bucket_rows: int = BUCKET_ROWS,
    keep_hours: float = KEEP_HOURS,
) -> None:
    """Merge a batch of changes into the directory, reading and writing the buckets it touches.

    A batch older than the last one is refused.
    """
    spark = changes.sparkSession
    versions = finished_versions(spark, path)
    if versions and versions[-1] > batch_id:
        raise ValueError(f"batch {batch_id} comes after snapshot {versions[-1]} is stored in {path}")
    drop_snapshot(spark, path, batch_id)  # its rows go before they are written again
    earlier = [v for v in versions if v < batch_id]
    stored = _places(spark, path, *earlier[-1:]).collect()
    places = {p.bucket: p for p in stored}
    buckets = _grown(stored, bucket_rows) if stored else 1
    out = f"{path}/batch={batch_id}"

    def folders(wanted: Iterable[int]) -> list[str]:
        return [_folder(path, b, places[b].batch) for b in wanted if b in places]

    if buckets == 1 or buckets != stored[0].buckets:
        _write(merge_folded(_read(spark, folders(places)), fold_nodes(changes)), out, buckets)
        places = {}
    else:
        with staged(fold_nodes(changes), "folded") as new:
            touched = [r.bucket for r in new.select(_bucket(buckets).alias("bucket")).distinct().collect()]
            _write(merge_folded(_read(spark, folders(touched)), new), out, buckets)
    written = spark.read.schema(T.StructType([*NODE_INFO.fields, _PLACES["bucket"]])).parquet(out)
    for r in written.groupBy("bucket").agg(F.count("*").alias("rows")).collect():
        places[r.bucket] = Row(bucket=r.bucket, batch=batch_id, buckets=buckets, rows=r.rows)
    rows = [tuple(places[bucket]) for bucket in sorted(places)]
    spark.createDataFrame(rows, _PLACES).coalesce(1).write.mode("overwrite").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
    ).parquet(f"{path}/v={batch_id}")
    _drop_aged(spark, path, keep_hours)


def drop_snapshot(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove what a failed writer left under a number; the snapshot goes before its rows."""
    delete(spark, f"{path}/v={batch_id}")
    delete(spark, f"{path}/batch={batch_id}")


def _drop(spark: SparkSession, path: str, versions: list[int], oldest_kept: int) -> None:
    """Remove snapshots, and the buckets that no later one has.

    What was replaced once never comes back, so the oldest snapshot that stays tells what is needed.
    Buckets go first: a call that failed is made good by the next one.
    """
    if not versions:
        return
    held = _places(spark, path, *versions).select("bucket", "batch").distinct()
    kept = _places(spark, path, oldest_kept).select("bucket", "batch")
    for place in held.exceptAll(kept).collect():
        delete(spark, _folder(path, place.bucket, place.batch))
    for version in versions:
        delete(spark, f"{path}/v={version}")


def _drop_aged(spark: SparkSession, path: str, hours: float) -> None:
    times = finished_times(spark, path)
    versions = sorted(times)
    keep_from = times[versions[-1]] - hours * 3_600_000
    aged = [v for v in versions[:-2] if times[v] < keep_from]
    _drop(spark, path, aged, versions[len(aged)])


def drop_old_snapshots(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the newest snapshots, when asked: readers may still hold an older one.

    Two at least stay, so that the last batch can run again.
    """
    versions = finished_versions(spark, path)
    old = versions[: -max(keep, 2)]
    _drop(spark, path, old, versions[len(old)] if versions else -1)
