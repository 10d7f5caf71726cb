"""Column functions: topics, ids, labels, payloads, times and number-to-name lookups."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What stands in for an absent name, an absent gateway and an unset hardware model.
NO_NAME = "No name"
NO_GATEWAY = "unknown"
UNSET_WORD = "UNSET"
UNSET_LABEL = "Unknown"

# Leading marks, then leading zeros, then the digits that count. More than 16 digits cannot be a bigint.
_HEX_ID = r"^!*0*([0-9a-fA-F]{1,16})\z"


def topic_message_type(topic: Column) -> Column:
    """Fourth level of the topic, NULL when the topic is shorter."""
    return F.get(F.split(topic, "/"), F.lit(3))


def topic_channel(topic: Column) -> Column:
    """Fifth level of the topic, '' when it is absent, a type mark or a gateway id."""
    level = F.get(F.split(topic, "/"), F.lit(4))
    not_a_channel = level.isNull() | level.isin("e", "c") | level.startswith("!")
    return F.when(not_a_channel, F.lit("")).otherwise(level)


def hex_to_node_id(text: Column) -> Column:
    """'!abcdef12' -> 2882400018; NULL for anything that is not hex or exceeds a bigint."""
    digits = F.nullif(F.regexp_extract(text, _HEX_ID, 1), F.lit(""))
    return F.conv(digits, 16, 10).try_cast("bigint")


def names_frame(spark: SparkSession, names: Mapping[int, str]) -> DataFrame:
    """A lookup table as a local relation, so that Catalyst knows its exact size."""
    table = pa.table(
        {
            "number": pa.array(list(names.keys()), pa.int64()),
            "name": pa.array(list(names.values()), pa.string()),
        }
    )
    return spark.createDataFrame(table)


def enum_name(
    df: DataFrame, number: Column, names: Mapping[int, str] | DataFrame, out: str
) -> DataFrame:
    """Add `out`, the name of `number`; NULL when the number has none.

    No broadcast is forced: a lookup given as a mapping has an exact size, which Catalyst checks
    against its broadcast threshold, and a larger one is joined by shuffle.
    """
    frame = names if isinstance(names, DataFrame) else names_frame(df.sparkSession, names)
    lookup = frame.select(F.col("number").alias(f"__{out}_number"), F.col("name").alias(out))
    joined = df.join(lookup, number.cast("bigint") == F.col(f"__{out}_number"), "left")
    return joined.drop(f"__{out}_number")


def hw_label(name: Column) -> Column:
    """Hardware name with the unset mark spelled out."""
    return F.replace(name, F.lit(UNSET_WORD), F.lit(UNSET_LABEL))


def mac_text(address: Column) -> Column:
    """Bytes as lower hex pairs joined by colons; NULL when there are none."""
    pairs = F.regexp_replace(F.hex(address), "(..)(?!$)", "$1:")
    return F.nullif(F.lower(pairs), F.lit(""))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def payload_columns(payload: Column) -> tuple[Column, Column]:
    """payload_length and raw_payload, with 0 and no bytes standing in for an absent payload."""
    size = F.coalesce(F.length(payload), F.lit(0)).alias("payload_length")
    content = F.coalesce(payload, F.lit("").cast("binary")).alias("raw_payload")
    return size, content


def arrival_timestamp(seconds: Column) -> Column:
    """Epoch seconds -> timestamp, rounded half-even to the microsecond; NULL -> now."""
    whole = F.floor(seconds).cast("bigint")
    micros = F.rint((seconds - whole) * F.lit(1e6)).cast("bigint")
    return F.coalesce(F.timestamp_micros(whole * F.lit(1_000_000) + micros), F.current_timestamp())


def node_label(node_id: Column) -> Column:
    return F.format_string("!%08x", node_id)


def display_name(long_name: Column, short_name: Column) -> Column:
    return F.coalesce(empty_to_null(long_name), empty_to_null(short_name), F.lit(NO_NAME))


def gateway_label(gateway_id: Column) -> Column:
    return F.coalesce(empty_to_null(gateway_id), F.lit(NO_GATEWAY))
