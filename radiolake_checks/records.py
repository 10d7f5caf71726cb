"""The fixture descriptor and encoders. All field numbers, enum numbers and names are our own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from google.protobuf import descriptor_pb2
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolake.functions.crypto import flags
from radiolake.operators.decode import RecordSpec, _record, by_rows, numpy_type, to_array
from radiolake.plans.tables import Settings

PORTS = {0: "UNKNOWN_APP", 1: "FX_ONE", 3: "FX_THREE", 4: "NODEINFO_APP"}
HW_MODELS = {0: "UNSET", 1: "FX_HW_A", 2: "FX_HW_B"}
ROLES = {0: "FX_CLIENT", 1: "FX_ROUTER"}

# A port field whose tag takes five bytes: no wrong key yields it by chance.
RARE_PORT_FIELD = 2**28 - 1

_FIELD = descriptor_pb2.FieldDescriptorProto

_USER = [
    ("id", _FIELD.TYPE_STRING),
    ("long_name", _FIELD.TYPE_STRING),
    ("short_name", _FIELD.TYPE_STRING),
    ("hw_model", "HardwareModel"),
    ("role", "Role"),
    ("is_licensed", _FIELD.TYPE_BOOL),
    ("macaddr", _FIELD.TYPE_BYTES),
]
_PACKET = [
    ("from", _FIELD.TYPE_FIXED32),
    ("to", _FIELD.TYPE_FIXED32),
    ("id", _FIELD.TYPE_FIXED32),
    ("decoded", "Data"),
    ("encrypted", _FIELD.TYPE_BYTES),
    ("rx_rssi", _FIELD.TYPE_INT32),
    ("rx_snr", _FIELD.TYPE_FLOAT),
    ("hop_limit", _FIELD.TYPE_UINT32),
    ("hop_start", _FIELD.TYPE_UINT32),
    ("via_mqtt", _FIELD.TYPE_BOOL),
    ("want_ack", _FIELD.TYPE_BOOL),
    ("priority", _FIELD.TYPE_INT32),
    ("delayed", _FIELD.TYPE_INT32),
    ("channel_index", _FIELD.TYPE_UINT32),
    ("rx_time", _FIELD.TYPE_FIXED32),
    ("pki_encrypted", _FIELD.TYPE_BOOL),
    ("next_hop", _FIELD.TYPE_UINT32),
    ("relay_node", _FIELD.TYPE_UINT32),
    ("tx_after", _FIELD.TYPE_UINT32),
]
_ENVELOPE = [
    ("packet", "MeshPacket"),
    ("channel_id", _FIELD.TYPE_STRING),
    ("gateway_id", _FIELD.TYPE_STRING),
]


def make_descriptor(port_field: int = RARE_PORT_FIELD, leave_out: tuple[str, ...] = ()) -> bytes:
    """A file descriptor set; `leave_out` names packet fields to omit."""
    file = descriptor_pb2.FileDescriptorProto(name="fx.proto", package="fx", syntax="proto3")
    enums = {"PortNum": PORTS, "HardwareModel": HW_MODELS, "Role": ROLES}
    for name, values in enums.items():
        enum = file.enum_type.add(name=name)
        for number, value in values.items():
            enum.value.add(name=value, number=number)

    def record(name: str, fields: list[tuple]) -> descriptor_pb2.DescriptorProto:
        message = file.message_type.add(name=name)
        for position, (field, kind, *number) in enumerate(fields, start=1):
            made = message.field.add(
                name=field, number=number[0] if number else position, label=_FIELD.LABEL_OPTIONAL
            )
            if isinstance(kind, str):
                made.type = _FIELD.TYPE_ENUM if kind in enums else _FIELD.TYPE_MESSAGE
                made.type_name = f".fx.{kind}"
            else:
                made.type = kind
        return message

    record("Data", [("portnum", "PortNum", port_field), ("payload", _FIELD.TYPE_BYTES, 2)])
    packet = record("MeshPacket", [f for f in _PACKET if f[0] not in leave_out])
    packet.oneof_decl.add(name="content")
    for field in packet.field:
        if field.name in ("decoded", "encrypted"):
            field.oneof_index = 0
    record("ServiceEnvelope", _ENVELOPE)
    record("User", _USER)
    return descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()


def make_spec(descriptor: bytes | None = None) -> RecordSpec:
    return RecordSpec(
        descriptor or make_descriptor(), "fx.ServiceEnvelope", "fx.Data", "fx.User"
    )


SPEC = make_spec()
SETTINGS = Settings.from_spec(SPEC, "fx.PortNum", "fx.HardwareModel", "fx.Role")


def _values(column: pa.Array) -> list:
    """The values of a column as Python's; numbers go through numpy, without a scalar object for each."""
    if pa.types.is_struct(column.type):
        return _given(column)
    if not (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        return column.to_pylist()
    numbers = np.frombuffer(column.buffers()[1], numpy_type(column.type))
    found = numbers[column.offset : column.offset + len(column)].astype(object)
    found[flags(column.is_null())] = None
    return found.tolist()


def _given(rows: pa.StructArray) -> list[dict | None]:
    """Each row as the fields that it gives, column by column; None for a NULL row."""
    names = [f.name for f in rows.type]
    values = zip(*map(_values, rows.flatten()))
    there = flags(rows.is_valid()).tolist()
    return [
        {n: v for n, v in zip(names, row) if v is not None} if whole else None
        for whole, row in zip(there, values)
    ]


def encode(spec: RecordSpec, name: str, fields: Column) -> Column:
    """A struct column, named after the fields of a record, as its serialized bytes."""
    descriptor = spec.descriptor

    def serialized(rows: pa.Array) -> pa.Array:
        record = _record(descriptor, name)
        return to_array(
            [None if r is None else record(**r).SerializeToString() for r in _given(rows)], pa.binary()
        )

    @F.arrow_udf(T.BinaryType())
    def write(rows: pa.Array) -> pa.Array:
        return by_rows(serialized, rows)

    return write.asNondeterministic()(fields)
