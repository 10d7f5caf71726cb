"""Channel keys and AES in counter mode, from Spark's own AES, SHA-2 and array functions.

Keys travel as a column read from a one-row table through a scalar subquery. They are never
literals, so no plan text shows them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the public default channel key.
DEFAULT_KEY = "1PG7OiApB1nwvP+rz05pAQ=="

# Fixed value: the key that stands in for one that is not valid base64.
_ZERO_KEY_HEX = "00" * 32

_KEY_SIZES = (16, 24, 32)
_BLOCK = 16

# Bytes that are mixed at once, the mean size from which values are mixed one by one, and rows whose
# lists of candidates are in memory at once.
_TOGETHER = 1 << 18
_LONG = 256
_ROWS = 500


def _decode_key(text: str) -> bytes | None:
    """Key bytes, or None for bad base64. Python's decoder is strict about padding; Spark's is not."""
    try:
        return base64.b64decode(text)
    except ValueError:
        return None


def make_key_ring(
    spark: SparkSession,
    channel_keys: Iterable[tuple[str, str]] = (),
    default_key: str = DEFAULT_KEY,
) -> DataFrame:
    """One row: default_key and ring, an ordered array of (name, key). NULL marks a bad key."""
    entry = pa.struct([("name", pa.string()), ("key", pa.binary())])
    ring = [{"name": name, "key": _decode_key(key)} for name, key in channel_keys]
    table = pa.table(
        {
            "default_key": pa.array([_decode_key(default_key)], pa.binary()),
            "ring": pa.array([ring], pa.list_(entry)),
        }
    )
    return spark.createDataFrame(table)


def key_ring_column(key_ring: DataFrame) -> Column:
    """The one row of a key ring as a struct column; more than one row is an error.

    What depends on the ring alone, each key bound to its own name, is derived here, once.
    """

    def entry(e: Column) -> Column:
        return F.struct(
            e["key"].alias("key"), _if_named(e["name"], e["key"]).alias("bound_to_name")
        )

    ring = F.transform("ring", entry).alias("ring")
    return key_ring.select(F.struct("default_key", ring)).scalar()


def _zero_key() -> Column:
    return F.unhex(F.lit(_ZERO_KEY_HEX))


def derive_key(channel: Column, key: Column) -> Column:
    """SHA-256(key, channel) for a named channel, the key itself for an unnamed one."""
    named = F.unhex(F.sha2(F.concat(key, channel.cast("binary")), 256))
    return F.coalesce(F.when(F.length(channel) > 0, named).otherwise(key), _zero_key())


def _if_named(channel: Column, key: Column) -> Column:
    return F.when(F.length(channel) > 0, derive_key(channel, key))


def default_candidates(channel: Column, keys: Column) -> Column:
    """The default key as it is, then bound to the topic channel if there is one."""
    key = keys["default_key"]
    steps = F.array(derive_key(F.lit(""), key), _if_named(channel, key))
    return F.filter(steps, lambda k: k.isNotNull())


def ring_candidates(channel: Column, keys: Column, first: int = 0, count: int | None = None) -> Column:
    """Per ring entry: the key as it is, bound to the topic channel, bound to its own name.

    `first` and `count` take a part of the ring, in its order.
    """

    def steps(entry: Column) -> Column:
        key = entry["key"]
        return F.array(derive_key(F.lit(""), key), _if_named(channel, key), entry["bound_to_name"])

    ring = keys["ring"] if count is None else F.slice(keys["ring"], first + 1, count)
    return F.filter(F.flatten(F.transform(ring, steps)), lambda k: k.isNotNull())


def candidate_keys(channel: Column, keys: Column) -> Column:
    """All keys to try, in order. `keys` comes from key_ring_column, `channel` from the topic."""
    return F.concat(default_candidates(channel, keys), ring_candidates(channel, keys))


def _swapped_hex(number: Column) -> Column:
    """The low 32 bits as 8 hex digits, least significant byte first."""
    swapped = (
        F.shiftleft(number.bitwiseAND(0xFF), 24)
        .bitwiseOR(F.shiftleft(number.bitwiseAND(0xFF00), 8))
        .bitwiseOR(F.shiftright(number, 8).bitwiseAND(0xFF00))
        .bitwiseOR(F.shiftright(number, 24).bitwiseAND(0xFF))
    )
    return F.lpad(F.hex(swapped), 8, "0")


def counter_blocks(size: Column, packet_id: Column, sender_id: Column) -> Column:
    """Counter blocks covering `size` bytes: id (8 bytes LE), sender (4 bytes LE), index (4 bytes BE).

    The sender is 32 bits wide, so the upper half of its 8 bytes starts at zero and holds the block
    index without a carry. NULL when there is nothing to cover or an id is out of range.
    """
    usable = (size > 0) & (packet_id >= 0) & sender_id.between(0, 0xFFFFFFFF)
    head = F.concat(
        _swapped_hex(packet_id), _swapped_hex(F.shiftright(packet_id, 32)), _swapped_hex(sender_id)
    )
    count = F.ceil(size / F.lit(_BLOCK)).cast("int")
    indexes = F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.lpad(F.hex(j), 8, "0"))
    joined = F.call_function("array_join", indexes, head)
    return F.when(usable, F.unhex(F.concat(head, joined)))


def keystream(blocks: Column, key: Column) -> Column:
    """Encrypted counter blocks (one padding block longer); NULL for a key of the wrong length."""
    stream = F.aes_encrypt(blocks, key, F.lit("ECB"), F.lit("PKCS"))
    return F.when(F.length(key).isin(*_KEY_SIZES), stream)


def flags(values: pa.BooleanArray) -> np.ndarray:
    """Flags without a NULL as numpy's; Arrow's own way imports pandas, 30 MB more in every worker."""
    bits = np.unpackbits(np.frombuffer(values.buffers()[1], np.uint8), bitorder="little")
    return bits[values.offset : values.offset + len(values)].astype(bool)


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array and where each value begins; offsets count from the first byte."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets.astype(np.int64)


def _xor(data: pa.Array, row: np.ndarray, streams: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """data[row[i]] XOR the first bytes of streams[i]: the bytes, and where each begins.

    A stream shorter than its data, or NULL, gives no bytes. Short values are mixed many at once, by the
    place of every byte, which takes some forty times their size: so _TOGETHER bytes at a time.
    """
    left, at = _flat(data)
    right, place = _flat(streams)
    size = (at[1:] - at[:-1])[row]
    there = flags(streams.is_valid()) & (place[1:] - place[:-1] >= size)
    size = np.where(there, size, 0)
    begin = np.concatenate([[0], np.cumsum(size)])
    from_left, from_right = at[:-1][row], place[:-1]
    mixed = np.empty(begin[-1], np.uint8)
    low = 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(begin, begin[low] + _TOGETHER, "right")) - 1)
        part, some = slice(low, high), size[low:high]
        out = mixed[begin[low] : begin[high]]
        if len(out) > _LONG * (high - low):
            end = 0
            for a, b, n in zip(from_left[part].tolist(), from_right[part].tolist(), some.tolist()):
                np.bitwise_xor(left[a : a + n], right[b : b + n], out=out[end : end + n])
                end += n
        else:
            inside = np.arange(len(out)) - np.repeat(begin[part] - begin[low], some)
            np.bitwise_xor(
                left[np.repeat(from_left[part], some) + inside],
                right[np.repeat(from_right[part], some) + inside],
                out=out,
            )
        low = high
    return mixed, begin


def xor_lists(data: pa.Array, streams: pa.Array) -> Iterator[list[bytes] | None]:
    """Per row the data XOR each of its streams; NULL data or streams give None, as does empty data."""
    for at in range(0, len(data), _ROWS):
        yield from _xor_lists(data.slice(at, _ROWS), streams.slice(at, _ROWS))


def _xor_lists(data: pa.Array, streams: pa.Array) -> Iterator[list[bytes] | None]:
    ends = np.frombuffer(streams.buffers()[1], np.int32)[streams.offset : streams.offset + len(streams) + 1]
    counts = np.where(flags(streams.is_valid()), ends[1:] - ends[:-1], 0)
    row = np.repeat(np.arange(len(data)), counts)
    mixed, begin = _xor(data, row, streams.flatten())
    whole, bounds = mixed.tobytes(), begin.tolist()
    ends = np.cumsum(counts).tolist()
    sizes = pc.binary_length(data).to_pylist()
    for c, e, n in zip(counts.tolist(), ends, sizes):
        yield [whole[bounds[i] : bounds[i + 1]] for i in range(e - c, e)] if c and n else None


@F.arrow_udf(T.BinaryType())
def xor_bytes(data: pa.Array, stream: pa.Array) -> pa.Array:
    """Binary XOR with the first bytes of the stream, which Spark lacks; NULL in, NULL out."""
    mixed, begin = _xor(data, np.arange(len(data)), stream)
    valid = pc.and_(data.is_valid(), stream.is_valid())
    if begin[-1] > np.iinfo(np.int32).max:
        raise ValueError("a batch of more than 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    bits = np.packbits(flags(valid), bitorder="little")
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(data), [pa.py_buffer(bits), pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(mixed)]
    )


def aes_ctr(data: Column, packet_id: Column, sender_id: Column, key: Column) -> Column:
    """AES-CTR both ways; no bytes for empty input, a bad key or an id out of range."""
    stream = keystream(counter_blocks(F.length(data), packet_id, sender_id), key)
    return F.coalesce(xor_bytes(data, stream), F.lit("").cast("binary"))
