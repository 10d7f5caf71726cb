"""Packets derived from the `events` table: as plain columns, and as binary messages."""

from __future__ import annotations

import base64

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolake.functions.crypto import DEFAULT_KEY, aes_ctr, derive_key, make_key_ring
from radiolake.session import stage
from radiolake_checks.records import SPEC, encode

# Runs unchanged in Spark SQL and in DuckDB.
PACKETS_SQL = """
SELECT seq, ingest_ts,
  CASE WHEN seq % 11 = 0 THEN 'msh/EU_868/stat' ELSE concat('msh/EU_868/2/', mtype, '/', ch, '/', gateway_id) END AS topic,
  failed, mesh_packet_id, gateway_id, from_node_id, portnum, rx_time,
  CASE seq % 3 WHEN 0 THEN '' ELSE concat('node-', CAST(seq % 7 AS STRING)) END AS long_name,
  CASE seq % 5 WHEN 0 THEN '' ELSE concat('n', CAST(seq % 5 AS STRING)) END AS short_name,
  CAST(seq % 4 AS BIGINT) AS hw_model, seq % 2 = 0 AS is_licensed,
  text, channel_id,
  CASE seq % 7 WHEN 0 THEN '' ELSE concat('!id', CAST(seq % 7 AS STRING)) END AS user_id,
  CASE WHEN seq % 23 = 0 THEN CAST(9 AS BIGINT) ELSE CAST(seq % 2 AS BIGINT) END AS role,
  CASE WHEN seq % 4 = 1 THEN '' ELSE lpad(hex(seq), 12, '0') END AS mac_hex,
  seq % 29 = 0 AS bad_user,
  CASE WHEN failed OR portnum = 0 THEN 'plain' WHEN seq % 17 = 0 THEN 'lost'
       WHEN seq % 6 = 2 THEN 'default' WHEN seq % 6 = 3 THEN 'topic'
       WHEN seq % 6 = 4 THEN 'ring' WHEN seq % 6 = 5 THEN 'named' ELSE 'plain' END AS cipher,
  CASE WHEN NOT failed THEN from_node_id + 1 END AS to_node_id,
  CASE WHEN NOT failed THEN -(seq % 120) END AS rssi,
  CASE WHEN NOT failed THEN CAST((seq % 64) / 4.0 - 8 AS DOUBLE) END AS snr,
  CASE WHEN NOT failed THEN seq % 8 END AS hop_limit,
  CASE WHEN NOT failed THEN seq % 5 END AS hop_start,
  CASE WHEN NOT failed THEN seq % 2 = 1 END AS via_mqtt,
  CASE WHEN NOT failed THEN seq % 3 = 1 END AS want_ack,
  CASE WHEN NOT failed THEN seq % 128 END AS priority,
  CASE WHEN NOT failed THEN seq % 3 END AS delayed,
  CASE WHEN NOT failed THEN seq % 9 END AS channel_index,
  CASE WHEN NOT failed THEN seq % 19 = 0 END AS pki_encrypted,
  CASE WHEN NOT failed THEN seq % 256 END AS next_hop,
  CASE WHEN NOT failed THEN seq * 7 % 256 END AS relay_node,
  CASE WHEN NOT failed THEN seq % 10 END AS tx_after
FROM (SELECT event_id AS seq, ts AS ingest_ts, event_type = 'error' AS failed, props AS text,
  CASE event_type WHEN 'purchase' THEN 'json' WHEN 'view' THEN 'c' ELSE 'e' END AS mtype,
  CASE user_id % 4 WHEN 0 THEN 'LongFast' WHEN 1 THEN 'Wx' WHEN 2 THEN 'e' ELSE '!aa' END AS ch,
  CASE WHEN event_type = 'error' THEN '' WHEN user_id % 3 = 0 THEN '!abcdef12'
       WHEN user_id % 3 = 1 THEN '!00000a01' ELSE '^zz' END AS gateway_id,
  CASE WHEN event_type = 'error' OR user_id % 5 = 0 THEN ''
       ELSE concat('ch', CAST(user_id % 5 AS STRING)) END AS channel_id,
  CASE WHEN event_type <> 'error' THEN CAST(floor(event_id / 2) AS BIGINT) END AS mesh_packet_id,
  CASE WHEN event_type <> 'error' THEN 3735928000 + user_id END AS from_node_id,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 97 = 0 THEN CAST(999 AS BIGINT)
       WHEN event_type = 'signup' THEN CAST(4 AS BIGINT) WHEN event_type = 'click' THEN CAST(1 AS BIGINT)
       WHEN event_type = 'view' THEN CAST(0 AS BIGINT) ELSE CAST(3 AS BIGINT) END AS portnum,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 101 = 0 THEN CAST(4000000000 AS BIGINT)
       ELSE 1700000000 + event_id END AS rx_time
  FROM {events}) e
"""

# Made-up keys: one per ring entry, and one that the ring lacks.
WX_KEY = bytes(range(1, 17))
SHORT_KEY = b"\x01"
SOLO_KEY = bytes(range(32, 64))
LOST_KEY = b"\x77" * 32
CHANNEL_KEYS = [
    ("Wx", base64.b64encode(WX_KEY).decode()),
    ("", base64.b64encode(SHORT_KEY).decode()),
    ("Solo", base64.b64encode(SOLO_KEY).decode()),
]

# Bytes that no record parser accepts: a field longer than what is left.
_TRUNCATED = "0A05"

PACKET_FIELDS = (
    "hop_limit",
    "hop_start",
    "via_mqtt",
    "want_ack",
    "priority",
    "delayed",
    "channel_index",
    "rx_time",
    "pki_encrypted",
    "next_hop",
    "relay_node",
    "tx_after",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: what a message says, as plain columns."""
    return packets_from(table(spark, sf_dir, "events"))


def packets_from(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(PACKETS_SQL, events=events)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores. A scan has no more working tasks than its files have row groups,
    and encoding a row takes far longer than moving it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, df.rdd.getNumPartitions()))


def key_ring(spark: SparkSession) -> DataFrame:
    return make_key_ring(spark, CHANNEL_KEYS)


def _bytes(value: bytes) -> Column:
    return F.unhex(F.lit(value.hex()))


def user_bytes(wanted: Column | None = None) -> Column:
    """The serialized node description; with `wanted`, rows where it does not hold are not encoded."""
    fields = F.struct(
        F.col("user_id").alias("id"),
        "long_name",
        "short_name",
        "hw_model",
        "role",
        "is_licensed",
        F.unhex("mac_hex").alias("macaddr"),
    )
    return F.when(F.col("bad_user"), F.unhex(F.lit(_TRUNCATED))).otherwise(
        encode(SPEC, SPEC.user, fields if wanted is None else F.when(wanted, fields))
    )


def content_bytes() -> Column:
    """What the packet carries: a node description, or the event's text."""
    text, described = F.col("text").cast("binary"), F.col("portnum") == 4
    return F.when(described, user_bytes(described)).otherwise(text)


def _sender_key() -> Column:
    default = _bytes(base64.b64decode(DEFAULT_KEY))
    level = F.get(F.split("topic", "/"), F.lit(4))
    channel = F.when(level.isin("LongFast", "Wx"), level).otherwise(F.lit(""))
    return (
        F.when(F.col("cipher") == "default", default)
        .when(F.col("cipher") == "topic", derive_key(channel, default))
        .when(F.col("cipher") == "ring", _bytes(WX_KEY))
        .when(F.col("cipher") == "named", derive_key(F.lit("Solo"), _bytes(SOLO_KEY)))
        .when(F.col("cipher") == "lost", _bytes(LOST_KEY))
    )


def with_data(df: DataFrame) -> DataFrame:
    """Add the serialized inner record as `data`, and encrypted as its sender would as `sealed`."""
    filled = df.withColumn("content", content_bytes())
    fields = F.struct("portnum", F.col("content").alias("payload"))
    return filled.withColumn("data", encode(SPEC, SPEC.data, fields)).withColumn(
        "sealed", aes_ctr(F.col("data"), F.col("mesh_packet_id"), F.col("from_node_id"), _sender_key())
    )


def messages_from(df: DataFrame) -> DataFrame:
    """Plain packet columns as raw messages."""
    plain = F.col("cipher") == "plain"
    packet = F.struct(
        F.col("from_node_id").alias("from"),
        F.col("to_node_id").alias("to"),
        F.col("mesh_packet_id").alias("id"),
        F.when(plain, F.struct("portnum", F.col("content").alias("payload"))).alias("decoded"),
        F.when(~plain, F.col("sealed")).alias("encrypted"),
        F.col("rssi").alias("rx_rssi"),
        F.col("snr").alias("rx_snr"),
        *PACKET_FIELDS,
    )
    envelope = encode(SPEC, SPEC.envelope, F.struct(packet.alias("packet"), "gateway_id", "channel_id"))
    payload = F.when(F.col("failed"), F.unhex(F.lit(_TRUNCATED))).otherwise(envelope)
    return with_data(df).select("topic", payload.alias("payload"), "ingest_ts", "seq")


_written: dict[tuple[str, str], DataFrame] = {}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per event, written once per application and read by every query."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        events = spread(table(spark, sf_dir, "events"))
        _written[key] = stage(messages_from(packets_from(events)), "raw_messages")
    return _written[key]
