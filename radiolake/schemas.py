"""Explicit schemas of the input messages and of the two result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_BOOL, _BYTES, _FLOAT, _INT = T.BooleanType(), T.BinaryType(), T.FloatType(), T.IntegerType()
_LONG, _TEXT, _TIME = T.LongType(), T.StringType(), T.TimestampType()

# One row per received message. `seq` breaks ties between equal arrival times and is unique.
RAW_MESSAGES = _struct(
    ("topic", _TEXT, False),
    ("payload", _BYTES, False),
    ("ingest_ts", _TIME, False),
    ("seq", _LONG, False),
)

PACKET_HISTORY = _struct(
    ("timestamp", _TIME, False),
    ("topic", _TEXT, False),
    ("from_node_id", _LONG, True),
    ("to_node_id", _LONG, True),
    ("portnum", _LONG, True),
    ("portnum_name", _TEXT, True),
    ("gateway_id", _TEXT, True),
    ("channel_id", _TEXT, True),
    ("mesh_packet_id", _LONG, True),
    ("rssi", _LONG, True),
    ("snr", _FLOAT, True),
    ("hop_limit", _INT, True),
    ("hop_start", _INT, True),
    ("payload_length", _INT, True),
    ("raw_payload", _BYTES, True),
    ("processed_successfully", _BOOL, True),
    ("via_mqtt", _BOOL, True),
    ("want_ack", _BOOL, True),
    ("priority", _INT, True),
    ("delayed", _INT, True),
    ("channel_index", _INT, True),
    ("rx_time", _INT, True),
    ("pki_encrypted", _BOOL, True),
    ("next_hop", _LONG, True),
    ("relay_node", _LONG, True),
    ("tx_after", _LONG, True),
    ("message_type", _TEXT, True),
    ("raw_service_envelope", _BYTES, True),
    ("parsing_error", _TEXT, True),
)

NODE_INFO = _struct(
    ("node_id", _LONG, False),
    ("hex_id", _TEXT, True),
    ("long_name", _TEXT, True),
    ("short_name", _TEXT, True),
    ("hw_model", _TEXT, True),
    ("role", _TEXT, True),
    ("primary_channel", _TEXT, True),
    ("is_licensed", _BOOL, True),
    ("mac_address", _TEXT, True),
    ("first_seen", _TIME, False),
    ("last_updated", _TIME, False),
)

# A packet is one radio packet heard by one gateway; a NULL part never equals anything.
PACKET_KEY = ("mesh_packet_id", "gateway_id")

# Node columns that keep their last non-NULL value.
NODE_VALUES = (
    "hex_id",
    "long_name",
    "short_name",
    "hw_model",
    "role",
    "primary_channel",
    "is_licensed",
    "mac_address",
)

# A change feed row is a node row plus its place in the arrival order.
CHANGE_ORDER = ("last_updated", "seq", "step")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the columns of `schema`, in its order and with its types."""
    return df.selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    )


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """Declare a parquet table in the session catalog unless it is already there."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")
