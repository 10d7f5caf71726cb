"""Build fixture records on the driver."""

from __future__ import annotations

import datetime as dt

from radiolake.operators.decode import _record
from radiolake_checks.records import SPEC

#: When the first fixture message arrives.
START = dt.datetime(2024, 5, 1, 12, 0, 0)

TOPIC = "msh/EU_868/2/e/LongFast/!abcdef12"


def user(spec=SPEC, **fields) -> bytes:
    return _record(spec.descriptor, spec.user)(**fields).SerializeToString()


def data(portnum: int = 1, payload: bytes = b"hi", spec=SPEC) -> bytes:
    return _record(spec.descriptor, spec.data)(portnum=portnum, payload=payload).SerializeToString()


def envelope(
    gateway: str = "!abcdef12",
    channel: str = "LongFast",
    portnum: int | None = 1,
    payload: bytes = b"hi",
    spec=SPEC,
    sender: int = 7,
    **packet,
) -> bytes:
    fields = {"from": sender, "id": 1, **packet}
    if portnum is not None:
        fields["decoded"] = {"portnum": portnum, "payload": payload}
    record = _record(spec.descriptor, spec.envelope)
    return record(packet=fields, gateway_id=gateway, channel_id=channel).SerializeToString()


def nodeinfo(sender: int = 7, gateway: str = "", channel: str = "LongFast", **fields) -> bytes:
    return envelope(gateway, channel, 4, user(**fields), sender=sender, id=sender)
