"""Brute force: the two tables built one message at a time, on plain values."""

from __future__ import annotations

import random

from fx import envelope, nodeinfo

from radiolake_checks.records import HW_MODELS, PORTS, ROLES

BROKEN = bytes.fromhex("0a05")
GATEWAYS = ["!abcdef12", "!00000a01", "00000a01", "^zz", ""]


def random_messages(count: int, seed: int) -> list[dict]:
    """A third of the messages share one key, a fifth do not parse."""
    rng = random.Random(seed)
    out = []
    for number in range(count):
        kind = rng.choice(["broken", "hot", "hot", "text", "node"])
        message = {
            "number": number,
            "kind": kind,
            "gateway": "!abcdef12" if kind == "hot" else rng.choice(GATEWAYS),
            "id": 1 if kind == "hot" else rng.randrange(max(count // 8, 2)),
            "sender": rng.randrange(6),
            "port": rng.choice([0, 1, 3, 999]),
            "rx_time": rng.choice([5, 5, 5, 2**31]),
            "channel": rng.choice(["", "c1", "c2"]),
            "json": rng.random() < 0.1,
        }
        if kind == "node":
            message["port"] = 4
            message["user"] = {
                "id": rng.choice(["", "!x1", "!x2"]),
                "long_name": rng.choice(["", "A", "B"]),
                "short_name": rng.choice(["", "a"]),
                "hw_model": rng.choice([0, 1, 2, 3]),
                "role": rng.choice([0, 1, 9]),
                "is_licensed": rng.random() < 0.5,
                "macaddr": rng.choice([b"", b"\x01\xff"]),
            }
        out.append(message)
    return out


def to_pair(m: dict) -> tuple[str, bytes]:
    topic = f"msh/EU/2/{'json' if m['json'] else 'e'}/Chan/g"
    if m["kind"] == "broken":
        return topic, BROKEN
    if m["kind"] == "node":
        from fx import user

        payload = user(**m["user"])
    else:
        payload = str(m["number"]).encode()
    return topic, envelope(
        m["gateway"], m["channel"], m["port"], payload, sender=m["sender"], id=m["id"],
        rx_time=m["rx_time"],
    )


def _node_id(gateway: str) -> int | None:
    try:
        return int(gateway.lstrip("!"), 16)
    except ValueError:
        return None


def sequential(messages: list[dict]) -> tuple[list[int], dict[int, dict]]:
    """Numbers of the stored messages, and the node directory with first and last message numbers."""
    stored, keys, nodes = [], set(), {}

    def upsert(node: int, number: int, values: dict) -> None:
        row = nodes.setdefault(node, {"first": number})
        row.update({k: v for k, v in values.items() if v is not None})
        row["last"] = number

    for m in messages:
        if m["json"]:
            continue
        if m["kind"] == "broken":
            stored.append(m["number"])
            continue
        if _node_id(m["gateway"]) is not None:
            upsert(_node_id(m["gateway"]), m["number"], {"hex_id": m["gateway"]})
        if m["kind"] == "node":
            u = m["user"]
            if u["hw_model"] in HW_MODELS and u["role"] in ROLES:
                values = {
                    "hex_id": u["id"] or None,
                    "long_name": u["long_name"] or None,
                    "short_name": u["short_name"] or None,
                    "hw_model": HW_MODELS[u["hw_model"]].replace("UNSET", "Unknown"),
                    "role": ROLES[u["role"]],
                    "is_licensed": u["is_licensed"],
                    "mac_address": u["macaddr"].hex(":") or None,
                    "primary_channel": m["channel"],
                }
                upsert(m["sender"], m["number"], values)
        if m["port"] not in PORTS or m["rx_time"] >= 2**31:
            continue
        key = (m["id"], m["gateway"])
        if key not in keys:
            keys.add(key)
            stored.append(m["number"])
    return stored, nodes
