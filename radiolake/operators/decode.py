"""Decode nested binary records with the descriptor the user supplies.

Spark ships no record decoder without an extra jar, so the parse runs in Arrow-batched functions:
one call per batch, one list per field, no per-row frame. The descriptor travels as bytes and its
message classes are built once per Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
from google.protobuf.descriptor import FieldDescriptor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from radiolake.functions.crypto import xor_lists


def _row(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


DATA = _row(("portnum", T.LongType()), ("payload", T.BinaryType()))

PACKET = _row(
    ("from", T.LongType()),
    ("to", T.LongType()),
    ("id", T.LongType()),
    ("decoded", DATA),
    ("encrypted", T.BinaryType()),
    ("rx_rssi", T.LongType()),
    ("rx_snr", T.FloatType()),
    ("hop_limit", T.LongType()),
    ("hop_start", T.LongType()),
    ("via_mqtt", T.BooleanType()),
    ("want_ack", T.BooleanType()),
    ("priority", T.LongType()),
    ("delayed", T.LongType()),
    ("channel_index", T.LongType()),
    ("rx_time", T.LongType()),
    ("pki_encrypted", T.BooleanType()),
    ("next_hop", T.LongType()),
    ("relay_node", T.LongType()),
    ("tx_after", T.LongType()),
)

# `error` is NULL for a good parse; `bad_text` tells a text error from any other.
ENVELOPE = _row(
    ("gateway_id", T.StringType()),
    ("channel_id", T.StringType()),
    ("packet", PACKET),
    ("error", T.StringType()),
    ("bad_text", T.BooleanType()),
)

# `rank` is the index of the candidate that was accepted.
FOUND = _row(("rank", T.IntegerType()), ("portnum", T.LongType()), ("payload", T.BinaryType()))

USER = _row(
    ("id", T.StringType()),
    ("long_name", T.StringType()),
    ("short_name", T.StringType()),
    ("hw_model", T.LongType()),
    ("role", T.LongType()),
    ("is_licensed", T.BooleanType()),
    ("macaddr", T.BinaryType()),
)

_UNSIGNED_64 = (FieldDescriptor.TYPE_UINT64, FieldDescriptor.TYPE_FIXED64)


@dataclass(frozen=True)
class RecordSpec:
    """A serialized file descriptor set and the full names of the records in it."""

    descriptor: bytes
    envelope: str
    data: str
    user: str

    @classmethod
    def from_file(cls, path: str, envelope: str, data: str, user: str) -> RecordSpec:
        return cls(Path(path).read_bytes(), envelope, data, user)

    def enum(self, name: str) -> dict[int, str]:
        """Number -> name of an enum in the descriptor."""
        found = _pool(self.descriptor).FindEnumTypeByName(name)
        return {number: value.name for number, value in found.values_by_number.items()}

    def check(self) -> None:
        """Refuse a descriptor that lacks a field every message needs, or has one no bigint holds."""
        packet = _fields(_record(self.descriptor, self.envelope))["packet"].message_type
        data = _record(self.descriptor, self.data).DESCRIPTOR
        user = _record(self.descriptor, self.user).DESCRIPTOR
        needed = {
            packet: ("from", "to", "id", "decoded"),
            data: ("portnum", "payload"),
            user: ("id", "long_name", "short_name", "hw_model", "role", "is_licensed"),
        }
        for record, names in needed.items():
            missing = [n for n in names if n not in record.fields_by_name]
            if missing:
                raise ValueError(f"{record.full_name} lacks {missing}")
            wide = [f.name for f in record.fields if f.type in _UNSIGNED_64]
            if wide:
                raise ValueError(f"{record.full_name} has 64-bit unsigned fields {wide}")


@lru_cache(maxsize=8)
def _pool(descriptor: bytes) -> descriptor_pool.DescriptorPool:
    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptor).file:
        pool.Add(file)
    return pool


@lru_cache(maxsize=32)
def _record(descriptor: bytes, name: str) -> type:
    return message_factory.GetMessageClass(_pool(descriptor).FindMessageTypeByName(name))


def _fields(record: type) -> dict:
    return record.DESCRIPTOR.fields_by_name


def _once(function):
    """Keep the optimizer from copying a parse into every filter and projection above it.

    The functions are deterministic; the mark only makes their result a boundary.
    """
    return function.asNondeterministic()


#: Rows whose records and Python values are in memory at once: they take many times the bytes of the batch.
ROWS_TOGETHER = 1000


def by_rows(function: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
    """What a function of whole columns gives, called for ROWS_TOGETHER rows at a time."""
    starts = range(0, len(columns[0]), ROWS_TOGETHER) or [0]
    return pa.concat_arrays([function(*[c.slice(at, ROWS_TOGETHER) for c in columns]) for at in starts])


def numpy_type(kind: pa.DataType) -> str:
    """The numpy name of a number or flag; Arrow's own answer imports pandas."""
    return {"float": "float32", "double": "float64"}.get(str(kind), str(kind))


def to_array(values: list, kind: pa.DataType) -> pa.Array:
    """pa.array for numbers, flags, texts and bytes. That one imports pandas, if it is there, and so takes
    30 MB more of every worker; a task has a worker for each parse in its plan."""
    there = np.fromiter((v is not None for v in values), bool, len(values))
    bits = None if there.all() else pa.py_buffer(np.packbits(there, bitorder="little"))
    if pa.types.is_string(kind) or pa.types.is_binary(kind):
        blobs = [b"" if v is None else v.encode() if isinstance(v, str) else v for v in values]
        ends = np.cumsum([0, *map(len, blobs)])
        if ends[-1] > np.iinfo(np.int32).max:
            raise ValueError("more than 2 GB of texts in some rows of a batch")
        parts = [bits, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(blobs))]
    else:
        plain = np.array([0 if v is None else v for v in values], numpy_type(kind))
        parts = [bits, pa.py_buffer(np.packbits(plain, bitorder="little") if pa.types.is_boolean(kind) else plain)]
    return pa.Array.from_buffers(kind, len(values), parts)


def _columns(messages: list, present: Iterable[str], schema: T.StructType) -> list[pa.Array]:
    """One Arrow array per scalar field; NULL for a field the descriptor lacks or a failed parse."""
    arrays = []
    for field in schema.fields:
        kind = to_arrow_type(field.dataType)
        if field.name in present:
            values = [None if m is None else getattr(m, field.name) for m in messages]
            arrays.append(to_array(values, kind))
        else:
            arrays.append(pa.nulls(len(messages), kind))
    return arrays


def _struct(arrays: list[pa.Array], schema: T.StructType, missing: list[bool]) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        arrays, names=schema.fieldNames(), mask=to_array(missing, pa.bool_())
    )


def _parse_all(record: type, blobs: list) -> tuple[list, list, list]:
    """Parsed messages, error texts and text-error flags, aligned with `blobs`."""
    parse = record.FromString
    messages, errors, bad_text = [], [], []
    for blob in blobs:
        message = error = None
        wrong_text = False
        try:
            message = parse(blob)
        except UnicodeDecodeError as failure:
            error, wrong_text = str(failure), True
        except Exception as failure:  # noqa: BLE001 - any failure becomes data
            error = str(failure)
        messages.append(message)
        errors.append(error)
        bad_text.append(wrong_text)
    return messages, errors, bad_text


def envelope_udf(spec: RecordSpec):
    """payload -> ENVELOPE."""
    spec.check()
    descriptor, name = spec.descriptor, spec.envelope

    def parse(payload: pa.Array) -> pa.Array:
        record = _record(descriptor, name)
        outer = _fields(record)
        packet_fields = outer["packet"].message_type.fields_by_name
        data_fields = packet_fields["decoded"].message_type.fields_by_name
        envelopes, errors, bad_text = _parse_all(record, payload.to_pylist())
        failed = [e is None for e in envelopes]
        packets = [None if e is None else e.packet for e in envelopes]
        decoded = [None if p is None else p.decoded for p in packets]

        inner = _struct(_columns(decoded, data_fields, DATA), DATA, failed)
        flat = T.StructType([f for f in PACKET.fields if f.name != "decoded"])
        arrays = dict(zip(flat.fieldNames(), _columns(packets, packet_fields, flat)))
        arrays["decoded"] = inner
        packet = _struct([arrays[n] for n in PACKET.fieldNames()], PACKET, failed)

        def text(field: str) -> pa.Array:
            if field not in outer:
                return pa.nulls(len(envelopes), pa.string())
            # The record object exists even after a failed parse, so its texts read as empty.
            return to_array(["" if e is None else getattr(e, field) for e in envelopes], pa.string())

        return pa.StructArray.from_arrays(
            [
                text("gateway_id"),
                text("channel_id"),
                packet,
                to_array(errors, pa.string()),
                to_array(bad_text, pa.bool_()),
            ],
            names=ENVELOPE.fieldNames(),
        )

    @F.arrow_udf(ENVELOPE)
    def parse_envelope(payload: pa.Array) -> pa.Array:
        return by_rows(parse, payload)

    return _once(parse_envelope)


def decode_envelope(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Add `env`, the parsed payload, and `decode_error`, NULL unless the parse failed."""
    parsed = df.withColumn("env", envelope_udf(spec)(F.col("payload")))
    return parsed.withColumn("decode_error", F.col("env.error"))


def _first_valid(record: type, candidates: Iterable[bytes | None], unknown_port: int) -> tuple | None:
    """The first candidate that parses and carries a port, named or not."""
    for rank, blob in enumerate(candidates):
        if not blob:
            continue
        try:
            data = record.FromString(blob)
        except Exception:  # noqa: BLE001 - a wrong key, go on with the next
            continue
        if data.portnum != unknown_port:
            return rank, data.portnum, data.payload
    return None


def _found_array(rows: list[tuple | None]) -> pa.Array:
    missing = [r is None for r in rows]
    arrays = [
        to_array([None if r is None else r[i] for r in rows], to_arrow_type(f.dataType))
        for i, f in enumerate(FOUND.fields)
    ]
    return _struct(arrays, FOUND, missing)


def decode_data(candidates: Column, spec: RecordSpec, unknown_port: int = 0) -> Column:
    """array of plain candidates -> FOUND of the first valid one, NULL when none is."""
    descriptor, name = spec.descriptor, spec.data

    def find(blobs: pa.Array) -> pa.Array:
        record = _record(descriptor, name)
        return _found_array([b and _first_valid(record, b, unknown_port) or None for b in blobs.to_pylist()])

    @F.arrow_udf(FOUND)
    def first_valid(blobs: pa.Array) -> pa.Array:
        return by_rows(find, blobs)

    return _once(first_valid)(candidates)


def open_data(sealed: Column, streams: Column, spec: RecordSpec, unknown_port: int = 0) -> Column:
    """Ciphertext and an array of key streams -> FOUND; XOR and parse stop at the first valid one."""
    descriptor, name = spec.descriptor, spec.data

    def find(data: pa.Array, keys: pa.Array) -> pa.Array:
        record = _record(descriptor, name)
        plain = xor_lists(data, keys)
        return _found_array([p and _first_valid(record, p, unknown_port) or None for p in plain])

    @F.arrow_udf(FOUND)
    def first_opened(data: pa.Array, keys: pa.Array) -> pa.Array:
        return by_rows(find, data, keys)

    return _once(first_opened)(sealed, streams)


def decode_user(df: DataFrame, spec: RecordSpec, payload: Column | None = None) -> DataFrame:
    """Add `user`, NULL when the payload does not parse. Filter to node descriptions first."""
    spec.check()
    descriptor, name = spec.descriptor, spec.user

    def parse(blobs: pa.Array) -> pa.Array:
        record = _record(descriptor, name)
        users, _, _ = _parse_all(record, blobs.to_pylist())
        missing = [u is None for u in users]
        return _struct(_columns(users, _fields(record), USER), USER, missing)

    @F.arrow_udf(USER)
    def parse_user(blobs: pa.Array) -> pa.Array:
        return by_rows(parse, blobs)

    source = F.col("env.packet.decoded.payload") if payload is None else payload
    return df.withColumn("user", _once(parse_user)(source))
