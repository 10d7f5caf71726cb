"""Row filters: subscription topics, JSON skip, packet kinds, and rows a typed table can hold."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolake.functions.scalars import hex_to_node_id

# The default subscription, the JSON mark and two port names used by number.
DEFAULT_PATTERN = "msh/+/+/+/#"
JSON_MARK = "/json/"
UNKNOWN_PORT = "UNKNOWN_APP"
NODEINFO_PORT = "NODEINFO_APP"

_INT_RANGE = (-(2**31), 2**31 - 1)
_INT_COLUMNS = (
    "hop_limit",
    "hop_start",
    "payload_length",
    "priority",
    "delayed",
    "channel_index",
    "rx_time",
)
_TEXT_COLUMNS = ("topic", "gateway_id", "channel_id", "message_type", "parsing_error")
_NODE_TEXT_COLUMNS = ("hex_id", "long_name", "short_name", "primary_channel")


def topic_regex(pattern: str) -> str:
    """Compile a subscription pattern: '+' stands for one level, a final '#' for the rest."""
    levels = pattern.split("/")
    if any(("+" in x or "#" in x) and len(x) > 1 for x in levels) or "#" in levels[:-1]:
        raise ValueError(f"not a topic pattern: {pattern!r}")
    if levels == ["#"]:
        return r"(?s)^[^$].*\z"
    rest = levels[-1] == "#"
    body = "/".join("[^/]*" if x == "+" else re.escape(x) for x in levels[: len(levels) - rest])
    # Topics that start with '$' are the broker's own; a leading wildcard does not cover them.
    first = r"(?:[^/$][^/]*)?" + body[len("[^/]*") :] if levels[0] == "+" else body
    return "(?s)^" + first + (r"(?:/.*)?" if rest else "") + r"\z"


def topic_matches(topic: Column, pattern: str = DEFAULT_PATTERN) -> Column:
    """Does the topic belong to the subscription? The fixed prefix is left visible to the scan."""
    prefix = re.split(r"[+#]", pattern, maxsplit=1)[0]
    fixed = prefix.rstrip("/") if pattern[len(prefix) :] == "#" else prefix
    matches = topic.rlike(topic_regex(pattern))
    return topic.startswith(fixed) & matches if fixed else matches


def skip_json(df: DataFrame) -> DataFrame:
    """Drop messages that a gateway published a second time as JSON."""
    return df.filter(~F.col("topic").contains(JSON_MARK))


def is_encrypted(packet: Column, unknown_port: int = 0) -> Column:
    """No readable port, but ciphertext is there. NULL for a failed parse, as in the next two."""
    return (packet["decoded"]["portnum"] == unknown_port) & (F.length(packet["encrypted"]) > 0)


def is_nodeinfo(packet: Column, nodeinfo_port: int) -> Column:
    """A node describing itself; test it after decryption. A scan can evaluate it on statistics."""
    return packet["decoded"]["portnum"] == nodeinfo_port


def has_gateway(env: Column) -> Column:
    """The message names a gateway whose id is hex; a failed parse names none."""
    gateway = env["gateway_id"]
    return (F.length(gateway) > 0) & hex_to_node_id(gateway).isNotNull()


def _has_nul(names: tuple[str, ...]) -> str:
    return " OR ".join(f"coalesce(contains({n}, '\\u0000'), false)" for n in names)


def reject_reason() -> Column:
    """Why a typed table would refuse a packet row; NULL when it would not."""
    low, high = _INT_RANGE
    unnamed = "CASE WHEN portnum IS NOT NULL AND portnum_name IS NULL THEN 'portnum has no name' END"
    ranges = [
        f"CASE WHEN {n} NOT BETWEEN {low} AND {high} THEN '{n} out of range' END"
        for n in _INT_COLUMNS
    ]
    nul = f"CASE WHEN {_has_nul(_TEXT_COLUMNS)} THEN 'text holds a NUL' END"
    return F.expr(f"coalesce({', '.join([unnamed, *ranges, nul])})")


def storable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split packet rows into those the history can hold and those it loses, with the reason.

    Both halves filter one frame; persist or stage it first when both are written.
    """
    marked = df.withColumn("reject_reason", reject_reason())
    kept = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return kept, marked.filter(F.col("reject_reason").isNotNull())


def storable_changes(changes: DataFrame) -> DataFrame:
    """Node changes that the node table can hold; refused_nodes has the others."""
    return changes.filter(f"NOT ({node_text_has_nul()})")


def node_text_has_nul(names: tuple[str, ...] = _NODE_TEXT_COLUMNS) -> str:
    """SQL condition: a text of a node holds a NUL."""
    return _has_nul(names)
