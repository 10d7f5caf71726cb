"""Flatten decoded messages into packet history rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolake.functions.scalars import enum_name, payload_columns, topic_message_type
from radiolake.schemas import PACKET_HISTORY

# What an error text starts with.
PARSE_PREFIX = "Parsing error: "
TEXT_PREFIX = "Unicode decode error: "

# History column -> packet field, where the names differ or the field is copied as it is.
_COPIED = {
    "from_node_id": "from",
    "to_node_id": "to",
    "mesh_packet_id": "id",
    "rssi": "rx_rssi",
    "snr": "rx_snr",
    "hop_limit": "hop_limit",
    "hop_start": "hop_start",
    "via_mqtt": "via_mqtt",
    "want_ack": "want_ack",
    "priority": "priority",
    "delayed": "delayed",
    "channel_index": "channel_index",
    "rx_time": "rx_time",
    "pki_encrypted": "pki_encrypted",
    "next_hop": "next_hop",
    "relay_node": "relay_node",
    "tx_after": "tx_after",
}


def status_columns(df: DataFrame) -> DataFrame:
    """Add processed_successfully and parsing_error."""
    failed = F.col("decode_error").isNotNull()
    prefix = F.when(F.col("env.bad_text"), F.lit(TEXT_PREFIX)).otherwise(F.lit(PARSE_PREFIX))
    return df.withColumn("processed_successfully", ~failed).withColumn(
        "parsing_error", F.when(failed, F.concat(prefix, F.col("decode_error")))
    )


def packet_rows(
    df: DataFrame, port_names: Mapping[int, str] | DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """The 29 history columns plus `seq` and `extra` columns of df. Integers stay wide, so that
    storable() can judge them."""
    size, content = payload_columns(F.col("env.packet.decoded.payload"))
    copied = [F.expr(f"env.packet.`{field}` AS {column}") for column, field in _COPIED.items()]
    flat = status_columns(df).select(
        F.col("ingest_ts").alias("timestamp"),
        "topic",
        F.expr("env.packet.decoded.portnum AS portnum"),
        F.expr("env.gateway_id AS gateway_id"),
        F.expr("env.channel_id AS channel_id"),
        *copied,
        size,
        content,
        "processed_successfully",
        topic_message_type(F.col("topic")).alias("message_type"),
        F.col("payload").alias("raw_service_envelope"),
        "parsing_error",
        "seq",
        *extra,
    )
    named = enum_name(flat, F.col("portnum"), port_names, "portnum_name")
    return named.select(*PACKET_HISTORY.fieldNames(), "seq", *extra)
