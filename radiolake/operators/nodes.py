"""Node directory: change feeds from messages, folded so that the last known value wins per column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolake.functions.scalars import (
    empty_to_null,
    enum_name,
    hex_to_node_id,
    hw_label,
    mac_text,
)
from radiolake.operators.decode import RecordSpec, decode_user
from radiolake.operators.filters import has_gateway, is_nodeinfo, node_text_has_nul
from radiolake.schemas import CHANGE_ORDER, NODE_INFO, NODE_VALUES

_CHANGE_COLUMNS = (*NODE_INFO.fieldNames(), "seq", "step")

# A gateway is noted before the node description in the same message.
GATEWAY_STEP = 0
NODEINFO_STEP = 1


@dataclass(frozen=True)
class NodeNames:
    """Number -> name tables of hardware models and roles, and the port of node descriptions."""

    hw_models: Mapping[int, str]
    roles: Mapping[int, str]
    nodeinfo_port: int


def _change(df: DataFrame, step: int, values: Mapping[str, Column]) -> DataFrame:
    """A change row: the given values, NULL for the rest, and the place in the arrival order."""
    columns = {
        **{f.name: F.lit(None).cast(f.dataType) for f in NODE_INFO.fields},
        "first_seen": F.col("ingest_ts"),
        "last_updated": F.col("ingest_ts"),
        **values,
        "seq": F.col("seq"),
        "step": F.lit(step),
    }
    return df.select([columns[name].alias(name) for name in _CHANGE_COLUMNS])


def gateway_changes(df: DataFrame) -> DataFrame:
    """One change per parsed message that names its gateway: only the id as written is known."""
    gateway = F.col("env.gateway_id")
    return _change(
        df.filter(has_gateway(F.col("env"))),
        GATEWAY_STEP,
        {"node_id": hex_to_node_id(gateway), "hex_id": gateway},
    )


# A moment as one decimal of 38 digits: seq shifted to be positive, and microseconds shifted by about
# 31,000 years, which leaves room up to the year 140,000.
_SEQ_RANGE, _SEQ_SHIFT = "18446744073709551616BD", "9223372036854775808BD"
_TIME_SHIFT = "1000000000000000000BD"


_NTZ_START = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _micros(df: DataFrame, name: str) -> tuple[str, str]:
    """SQL for microseconds of a time column, and for the time back from {micros}, for either type."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return (
            f"timestampdiff(MICROSECOND, {_NTZ_START}, {name})",
            f"timestampadd(MICROSECOND, {{micros}}, {_NTZ_START})",
        )
    return f"unix_micros({name})", "timestamp_micros({micros})"


def gateway_edges(df: DataFrame) -> DataFrame:
    """The first and the last of the gateway changes per gateway id: they fold to the same result.

    A gateway reports every packet it hears, so few ids hold nearly all rows. They are combined
    before the exchange on three slim columns, and the wide fold then meets two rows per id.
    """
    named = df.filter(F.length("env.gateway_id") > 0)
    gateway = F.col("env.gateway_id").alias("gateway_id")
    _, time = _micros(df, "ingest_ts")
    moment = _moment(df, "ingest_ts")
    edges = (
        named.groupBy(gateway)
        .agg(F.min(moment).alias("first"), F.max(moment).alias("last"))
        .select("gateway_id", F.explode(F.array_distinct(F.array("first", "last"))).alias("edge"))
        .select(
            "gateway_id",
            F.expr(
                time.format(micros=f"CAST(edge div {_SEQ_RANGE} - {_TIME_SHIFT} AS BIGINT)")
            ).alias("ingest_ts"),
            F.expr(f"CAST(edge % {_SEQ_RANGE} - {_SEQ_SHIFT} AS BIGINT)").alias("seq"),
        )
    )
    known = edges.withColumn("node_id", hex_to_node_id(F.col("gateway_id"))).filter(
        F.col("node_id").isNotNull()
    )
    return _change(
        known, GATEWAY_STEP, {"node_id": F.col("node_id"), "hex_id": F.col("gateway_id")}
    )


def _described(df: DataFrame, spec: RecordSpec, names: NodeNames) -> DataFrame:
    """Node descriptions with their parsed `user`, the names of its numbers and `reject_reason`."""
    described = df.filter(is_nodeinfo(F.col("env.packet"), names.nodeinfo_port))
    slim = described.select(
        "ingest_ts",
        "seq",
        F.col("env.packet.from").alias("node_id"),
        F.col("env.channel_id").alias("channel_id"),
        F.col("env.packet.decoded.payload").alias("payload"),
    )
    return named_users(decode_user(slim, spec, F.col("payload")), names)


def named_users(df: DataFrame, names: NodeNames) -> DataFrame:
    """Add `__hw`, `__role` and `reject_reason`, NULL for a user that the directory can hold."""
    user = F.col("user")
    named = enum_name(df, user["hw_model"], names.hw_models, "__hw")
    named = enum_name(named, user["role"], names.roles, "__role")
    texts = ("user.id", "user.long_name", "user.short_name", "channel_id")
    reason = (
        F.when(user.isNull(), "node description does not parse")
        .when(F.col("__hw").isNull(), "hw_model has no name")
        .when(F.col("__role").isNull(), "role has no name")
        .when(F.expr(node_text_has_nul(texts)), "text holds a NUL")
    )
    return named.withColumn("reject_reason", reason)


def nodeinfo_changes(df: DataFrame, spec: RecordSpec, names: NodeNames) -> DataFrame:
    """One change per readable node description whose model and role have names."""
    return _user_rows(_described(df, spec, names))


def refused_nodes(df: DataFrame, spec: RecordSpec, names: NodeNames) -> DataFrame:
    """Node descriptions that change no node, with the reason: timestamp, seq, node_id, channel_id,
    payload, reject_reason."""
    refused = _described(df, spec, names).filter(F.col("reject_reason").isNotNull())
    return refused.select(
        F.col("ingest_ts").alias("timestamp"), "seq", "node_id", "channel_id", "payload", "reject_reason"
    )


def with_node_reason(df: DataFrame, spec: RecordSpec, names: NodeNames) -> DataFrame:
    """Add `node_reason` to decoded messages: why a node description changes no node, else NULL."""
    described = is_nodeinfo(F.col("env.packet"), names.nodeinfo_port)
    payload = F.when(described, F.col("env.packet.decoded.payload"))
    named = named_users(
        decode_user(df.withColumn("channel_id", F.col("env.channel_id")), spec, payload), names
    )
    reason = F.when(described, F.col("reject_reason"))
    return named.select(*df.columns, reason.alias("node_reason"))


def user_changes(df: DataFrame, names: NodeNames) -> DataFrame:
    """Change rows from frames that hold node_id, channel_id and a parsed `user`."""
    return _user_rows(named_users(df, names))


def _user_rows(named: DataFrame) -> DataFrame:
    user = F.col("user")
    return _change(
        named.filter(F.col("__hw").isNotNull() & F.col("__role").isNotNull() & user.isNotNull()),
        NODEINFO_STEP,
        {
            "node_id": F.col("node_id"),
            "hex_id": empty_to_null(user["id"]),
            "long_name": empty_to_null(user["long_name"]),
            "short_name": empty_to_null(user["short_name"]),
            "hw_model": hw_label(F.col("__hw")),
            "role": F.col("__role"),
            "is_licensed": user["is_licensed"],
            "mac_address": mac_text(user["macaddr"]),
            "primary_channel": F.col("channel_id"),
        },
    )


def node_changes(gateways: DataFrame, nodeinfos: DataFrame) -> DataFrame:
    """Both feeds as one; CHANGE_ORDER holds the order that a shuffle would lose."""
    return gateways.unionByName(nodeinfos)


def _moment(df: DataFrame, time: str) -> Column:
    """`time` and `seq` as one ordered number, which a hash table can hold; a struct it cannot."""
    micros, _ = _micros(df, time)
    return F.expr(
        f"CAST((CAST({micros} AS DECIMAL(20, 0)) + {_TIME_SHIFT}) * {_SEQ_RANGE}"
        f" + (CAST(seq AS DECIMAL(20, 0)) + {_SEQ_SHIFT}) AS DECIMAL(38, 0))"
    )


def _fold(changes: DataFrame, order: str) -> DataFrame:
    latest = [
        F.expr(f"max_by({c}, {order}) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in NODE_VALUES
    ]
    folded = changes.groupBy("node_id").agg(
        *latest,
        F.min("first_seen").alias("first_seen"),
        F.max("last_updated").alias("last_updated"),
    )
    return folded.select(*NODE_INFO.fieldNames())


def distinct_changes(changes: DataFrame) -> DataFrame:
    """Changes that say the same of a node as one, with the last moment at which it was said.

    Nodes repeat themselves, so nearly all rows go here, in a hash table before any exchange: values
    are its keys, moments and times its sums. They fold to the same result.
    """
    return changes.groupBy("node_id", *NODE_VALUES, "step").agg(
        F.max(_moment(changes, "last_updated")).alias("moment"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_updated").alias("last_updated"),
    )


def fold_nodes(changes: DataFrame) -> DataFrame:
    """One row per node: the last non-NULL value of each column, first and last time heard.

    Equal changes are first made one, in a hash table; the fold itself, whose buffers hold texts and
    which Spark therefore sorts, meets only what differs. Both combine before their exchange, so a
    node with a third of all changes leaves a row per input partition and difference. A stream
    takes the fold alone, as it may hold one aggregate.
    """
    if changes.isStreaming:
        return _fold(changes, f"struct({', '.join(CHANGE_ORDER)})")
    return _fold(distinct_changes(changes), "struct(moment, step)")


def merge_nodes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored directory brought up to date with a later batch of changes."""
    return merge_folded(snapshot, fold_nodes(changes))


def merge_folded(snapshot: DataFrame, folded: DataFrame) -> DataFrame:
    """merge_nodes for changes that are folded already."""
    joined = snapshot.alias("old").join(folded.alias("new"), "node_id", "full_outer")
    latest = {c: f"coalesce(new.{c}, old.{c})" for c in (*NODE_VALUES, "last_updated")}
    merged = {"node_id": "node_id", "first_seen": "coalesce(old.first_seen, new.first_seen)", **latest}
    return joined.selectExpr(*[f"{merged[n]} AS {n}" for n in NODE_INFO.fieldNames()])
