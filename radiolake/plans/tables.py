"""From raw messages to the two tables, as lazy frames and as a batch job."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolake.operators.decode import RecordSpec, decode_envelope
from radiolake.operators.decrypt import decrypt_packets
from radiolake.operators.dedup import first_arrival
from radiolake.operators.filters import (
    DEFAULT_PATTERN,
    NODEINFO_PORT,
    UNKNOWN_PORT,
    reject_reason,
    skip_json,
    storable,
    storable_changes,
    topic_matches,
)
from radiolake.operators.nodes import (
    NodeNames,
    fold_nodes,
    gateway_edges,
    node_changes,
    nodeinfo_changes,
    with_node_reason,
)
from radiolake.operators.packets import packet_rows
from radiolake.schemas import NODE_INFO, PACKET_HISTORY, conform
from radiolake.session import staged
from radiolake.sources.directory import drop_snapshot, write_nodes
from radiolake.sources.history import (
    HISTORY,
    REFUSED_NODES,
    REJECTED,
    TABLES,
    append_routed,
    drop_batch,
    table_path,
)
from radiolake.sources.ledger import Ledger


@dataclass(frozen=True)
class Settings:
    """What the user supplies: record descriptor, number-to-name tables and the subscription."""

    spec: RecordSpec
    ports: Mapping[int, str]
    hw_models: Mapping[int, str]
    roles: Mapping[int, str]
    pattern: str = DEFAULT_PATTERN
    names: NodeNames = field(init=False)
    unknown_port: int = field(init=False)

    def __post_init__(self) -> None:
        numbers = {name: number for number, name in self.ports.items()}
        names = NodeNames(self.hw_models, self.roles, numbers[NODEINFO_PORT])
        object.__setattr__(self, "names", names)
        object.__setattr__(self, "unknown_port", numbers[UNKNOWN_PORT])

    @classmethod
    def from_spec(
        cls, spec: RecordSpec, ports: str, hw_models: str, roles: str, pattern: str = DEFAULT_PATTERN
    ) -> Settings:
        """Take the name tables from the descriptor, by the full names of its enums."""
        return cls(spec, spec.enum(ports), spec.enum(hw_models), spec.enum(roles), pattern)


def decoded_messages(messages: DataFrame, settings: Settings, key_ring: DataFrame) -> DataFrame:
    """Subscribed, non-JSON messages, parsed and decrypted. Narrow; batch or stream.

    The topic filters come first: Catalyst cannot move them below a Python function by itself.
    """
    wanted = skip_json(messages.filter(topic_matches(F.col("topic"), settings.pattern)))
    return decrypt_packets(
        decode_envelope(wanted, settings.spec), settings.spec, key_ring, settings.unknown_port
    )


def directory_changes(decoded: DataFrame, settings: Settings) -> DataFrame:
    """Storable node changes, the gateway part already thinned to what can matter.

    Both parts read the frame; persist or stage it first, or it is parsed twice.
    """
    described = nodeinfo_changes(decoded, settings.spec, settings.names)
    return storable_changes(node_changes(gateway_edges(decoded), described))


def packet_history(decoded: DataFrame, settings: Settings) -> DataFrame:
    """The packet history of a bounded set of decoded messages."""
    kept, _ = storable(packet_rows(decoded, settings.ports))
    return conform(first_arrival(kept), PACKET_HISTORY)


def node_directory(decoded: DataFrame, settings: Settings) -> DataFrame:
    """The node directory of a bounded set of decoded messages."""
    return conform(fold_nodes(directory_changes(decoded, settings)), NODE_INFO)


# The history's columns that the other tables have too; the rest are NULL in their rows.
_SHARED = {
    REJECTED: ("timestamp", "topic", "from_node_id", "portnum", "gateway_id", "mesh_packet_id", "raw_service_envelope"),
    REFUSED_NODES: ("timestamp", "channel_id"),
}


def _routed_column(field: T.StructField) -> str:
    tables = ", ".join(f"'{t}'" for t in (HISTORY, *(t for t, names in _SHARED.items() if field.name in names)))
    kept = f"CASE WHEN table IN ({tables}) THEN `{field.name}` END"
    return f"CAST({kept} AS {field.dataType.simpleString()}) AS `{field.name}`"


def routed_rows(decoded: DataFrame, settings: Settings) -> DataFrame:
    """Every row that a batch stores, with its `table`, `reject_reason` and `seq`: stored and rejected
    packets and refused node descriptions, marked in one pass over the messages."""
    marked = with_node_reason(decoded, settings.spec, settings.names)
    judged = packet_rows(marked, settings.ports, ("node_reason",)).withColumn("reject_reason", reject_reason())
    tables = f"""explode(array_compact(array(
        CASE WHEN reject_reason IS NULL THEN '{HISTORY}' ELSE '{REJECTED}' END,
        CASE WHEN node_reason IS NOT NULL THEN '{REFUSED_NODES}' END)))"""
    refused = f"table = '{REFUSED_NODES}'"
    return judged.withColumn("table", F.expr(tables)).selectExpr(
        *map(_routed_column, PACKET_HISTORY.fields),
        f"CASE WHEN {refused} THEN from_node_id END AS node_id",
        f"CASE WHEN {refused} THEN raw_payload END AS payload",
        f"CASE WHEN {refused} THEN node_reason ELSE reject_reason END AS reject_reason",
        "seq",
        "table",
    )


def write_tables(decoded: DataFrame, settings: Settings, out: str, writer: str, batch: int) -> bool:
    """Bring all tables up to date with one batch of decoded messages of a writer.

    `batch` counts within the writer. A batch that is done already changes nothing and gives False,
    so a replay is safe, whatever other writers have stored since. What a writer left that failed
    before its batch was done is removed first. The frame is read several times; the caller
    persists or stages it. Writers take turns.
    """
    spark = decoded.sparkSession
    ledger = Ledger(spark, out)
    claim = ledger.claim(writer, batch)
    if claim.done:
        return False
    if claim.left_over is not None:
        _drop(spark, out, claim.left_over)
        if claim.left_over != claim.number:
            ledger.drop(claim.left_over)
    append_routed(routed_rows(decoded, settings), out, claim.number)
    write_nodes(directory_changes(decoded, settings), f"{out}/node_info", claim.number)
    ledger.finish(claim.number)
    return True


def _drop(spark: SparkSession, out: str, number: int) -> None:
    for table in TABLES:
        drop_batch(spark, table_path(out, table), number)
    drop_snapshot(spark, f"{out}/node_info", number)


def load_batch(
    messages: DataFrame,
    settings: Settings,
    key_ring: DataFrame,
    out: str,
    job: str | None = None,
) -> bool:
    """Batch job, e.g. a backfill: parse and decrypt once into a staged table, then write all tables.

    Name the job, and running it again after a failure goes on with its batch; once it is done,
    running it again changes nothing and gives False. Without a name each call is a job of its own.
    """
    with staged(decoded_messages(messages, settings, key_ring), "decoded") as decoded:
        return write_tables(decoded, settings, out, f"job {job or uuid.uuid4().hex}", 0)
