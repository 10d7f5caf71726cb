"""Raw messages as a batch or streaming frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolake.schemas import RAW_MESSAGES, conform

_PARTITION_BITS = 16


def read_messages(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages stored as files. A stream takes new files as they come, a bounded number per batch."""
    reader = (spark.readStream if streaming else spark.read).schema(RAW_MESSAGES)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(file_format).load(path)


def messages_from_kafka(df: DataFrame, kafka_topics: Sequence[str] = ()) -> DataFrame:
    """Rows of Spark's Kafka source, whose key carries the message topic, as raw messages.

    An offset is unique within a partition of a Kafka topic. `kafka_topics` lists the topics that
    are read; a topic's place in it is a part of `seq`, which is so unique over all of them, and a
    row of any other topic is an error. With one topic the list may be left out. `seq` follows
    arrival order within a partition, and `ingest_ts` orders across partitions. A row without a
    key gets the topic '', so that a filter drops it by a value and not by a NULL.
    """
    number = F.shiftleft(F.col("offset"), _PARTITION_BITS).bitwiseOR(F.col("partition").cast("bigint"))
    if kafka_topics:
        listed = F.array(*[F.lit(t) for t in kafka_topics])
        place = F.array_position(listed, F.col("topic")) - 1
        known = F.when(place < 0, F.raise_error(F.concat(F.lit("topic not listed: "), "topic"))).otherwise(place)
        number = number * F.lit(len(kafka_topics)) + known
    rows = df.select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("topic"),
        F.col("value").alias("payload"),
        F.col("timestamp").alias("ingest_ts"),
        number.alias("seq"),
    )
    return conform(rows, RAW_MESSAGES)
