"""Shards of nearly equal size by histogram sort.

Documents are ordered by a key of 63 bits whose leading part is a hash of the text and whose
trailing part is a hash of doc_id: equal texts lie together, and a group of copies of any size can
still be cut anywhere. Splitters are found by counting: each round counts the exact bytes below
candidate boundaries in the intervals that hold a wanted splitter, over all partitions, and keeps
the interval the splitter must lie in, until the bytes between two candidates are within tolerance.
Then every document knows its shard, and one exchange brings it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolake.llm.ranking import ranked
from radiolake.llm.text import text_of
from radiolake.session import stage

SHARDS = 24
KEY_BITS, TEXT_BITS = 63, 36
#: Bits of the key that a round resolves: an interval is probed at 2 ** 10 boundaries.
ROUND_BITS = 10
#: Bytes a splitter may be off, as a part of a shard's size.
TOLERANCE = 1e-4
#: A row's own bytes beside its text.
OVERHEAD = 8


def key_of(doc_id: Column, text: Column) -> Column:
    by_text = F.shiftrightunsigned(F.xxhash64(text), 64 - TEXT_BITS)
    by_id = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(1)), 64 - (KEY_BITS - TEXT_BITS))
    return F.shiftleft(by_text, KEY_BITS - TEXT_BITS) + by_id


def splitters(sized: DataFrame, parts: int = SHARDS, tolerance: float = TOLERANCE) -> list[int]:
    """Keys that cut (key, size) into parts of nearly equal size: part p has the keys from the
    (p-1)th splitter on, below the pth.

    The driver sees `parts` x 2 ** ROUND_BITS counts a round at most, of any number of rows.
    """
    whole = sized.agg(F.sum("size")).first()[0] or 0
    wanted = [whole * p / parts for p in range(1, parts)]
    # Per splitter: the interval it lies in and the bytes below that.
    where = [(0, 0)] * len(wanted)
    shift = KEY_BITS
    slack = max(1.0, whole / parts * tolerance)
    best = [0] * len(wanted)
    open_ones = list(range(len(wanted))) if whole else []
    while open_ones and shift > 0:
        bits = min(ROUND_BITS, shift)
        starts = sorted({where[k][0] for k in open_ones})
        prefix = F.shiftright("key", shift).cast("long") if shift < KEY_BITS else F.lit(0).cast("long")
        shift -= bits
        counted = (
            sized.select(prefix.alias("prefix"), F.shiftright("key", shift).alias("probe"), "size")
            .filter(F.col("prefix").isin(starts))
            .groupBy("prefix", "probe")
            .agg(F.sum("size").alias("size"))
            .collect()
        )
        inside: dict[int, list[tuple[int, int]]] = {}
        for prefix_value, probe, size in sorted(tuple(r) for r in counted):
            inside.setdefault(prefix_value, []).append((probe, size))
        still = []
        for k in open_ones:
            start, below = where[k]
            for probe, size in inside[start]:
                if below + size > wanted[k]:
                    break
                below += size
            # The splitter lies in this cell: its ends are the nearest boundaries probed.
            low, high = wanted[k] - below, below + size - wanted[k]
            best[k] = (probe if low <= high else probe + 1) << shift
            where[k] = (probe, below)
            if min(low, high) > slack:
                still.append(k)
        open_ones = still
    return best


def sharded(documents: DataFrame, shards: int = SHARDS, payload: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the payload columns: every row once.

    Shards hold nearly equal bytes, off by the tolerance or half of the row at a boundary. Slots
    count a shard's rows from 0 in key order. A NULL text has OVERHEAD bytes and the checksum of
    nothing. Rows with equal id and text have equal keys and lie side by side. No documents give
    no rows; fewer documents than shards leave shards empty.
    """
    text = text_of()
    keyed = documents.select(
        key_of(F.col("doc_id"), text).alias("key"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        "doc_id",
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *payload,
    )
    slim = stage(keyed.select("key", "size", "doc_id", "text_crc32"), "shard_keys")
    shard = F.lit(0)
    for bound in splitters(slim, shards):
        shard = shard + (F.col("key") >= F.lit(bound)).cast("int")
    placed = (keyed if payload else slim).withColumn("shard", shard)
    slots, _ = ranked(placed, "shard", "key", "doc_id")
    return slots.select("doc_id", "size", "text_crc32", "shard", F.col("rank").alias("slot"), *payload)
