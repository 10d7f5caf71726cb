"""Open encrypted packets with an ordered ring of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolake.functions.crypto import (
    counter_blocks,
    default_candidates,
    key_ring_column,
    keystream,
    ring_candidates,
)
from radiolake.functions.scalars import topic_channel
from radiolake.operators.decode import RecordSpec, open_data
from radiolake.operators.filters import is_encrypted


#: Ring entries tried in the first step; a packet carries three key streams of its own size for each.
RING_STEP = 4
#: Each further step tries this many times as many entries as the one before it.
RING_GROWTH = 4


def ring_steps(ring_size: int) -> list[tuple[int, int]]:
    """First entry and number of entries of each step: few for the common case, then ever more.

    Every step is an evaluation in Python with workers of its own, so their number must not grow
    with the ring; it grows with its logarithm. A packet tries at most RING_GROWTH times as many
    entries as it needs, or RING_STEP.
    """
    steps, first, count = [], 0, RING_STEP
    while first < ring_size:
        steps.append((first, min(count, ring_size - first)))
        first, count = first + count, count * RING_GROWTH
    return steps


def _opened(blocks: Column, keys: Column, spec: RecordSpec, unknown_port: int) -> Column:
    """The first key that opens the packet; without blocks nothing is computed or sent to Python."""
    wanted = blocks.isNotNull()
    streams = F.when(wanted, F.transform(keys, lambda k: keystream(blocks, k)))
    return open_data(F.when(wanted, F.col("env.packet.encrypted")), streams, spec, unknown_port)


def decrypt_packets(
    df: DataFrame,
    spec: RecordSpec,
    key_ring: DataFrame,
    unknown_port: int = 0,
    ring_size: int | None = None,
) -> DataFrame:
    """Replace `env.packet.decoded` where a key opens the packet; leave every other row as it is.

    Narrow: no shuffle, and the same for a stream. The default key is tried on its own first, then
    the ring in growing steps, each only for packets that are still closed. Only a packet that no
    earlier step opens sends the streams of the last and largest step to Python; Spark bounds the
    bytes of a batch (spark.sql.execution.arrow.maxBytesPerBatch). The number of steps is part of
    the plan: give `ring_size`, at least the number of entries, or the one row of the ring is asked.
    """
    if ring_size is None:
        ring_size = key_ring.select(F.size("ring")).first()[0]
    keys, channel, packet = F.col("__keys"), F.col("__channel"), F.col("env.packet")
    blocks = F.when(
        is_encrypted(packet, unknown_port),
        counter_blocks(F.length(packet["encrypted"]), packet["id"], packet["from"]),
    )
    prepared = df.withColumns(
        {
            "__keys": key_ring_column(key_ring),
            "__channel": topic_channel(F.col("topic")),
            "__blocks": blocks,
        }
    )
    opened = prepared.withColumn(
        "__found", _opened(F.col("__blocks"), default_candidates(channel, keys), spec, unknown_port)
    )
    for first, count in ring_steps(ring_size):
        rest = F.when(F.col("__found").isNull(), F.col("__blocks"))
        candidates = ring_candidates(channel, keys, first, count)
        opened = opened.withColumn(
            "__by_ring", _opened(rest, candidates, spec, unknown_port)
        ).withColumn("__found", F.coalesce("__found", "__by_ring"))
    found = F.col("__found")
    data = F.struct(found["portnum"].alias("portnum"), found["payload"].alias("payload"))
    decoded = F.when(found.isNotNull(), data).otherwise(packet["decoded"])
    replaced = F.when(packet.isNotNull(), packet.withField("decoded", decoded))
    return opened.withColumn("env", F.col("env").withField("packet", replaced)).drop(
        "__keys", "__channel", "__blocks", "__found", "__by_ring"
    )
