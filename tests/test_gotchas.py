"""One small hand-made frame per behaviour that is easy to get wrong."""

from __future__ import annotations

import base64
import random

import pytest
from fx import TOPIC, data, envelope, nodeinfo, user
from pyspark.sql import functions as F

from radiolake.functions.crypto import aes_ctr, make_key_ring
from radiolake.operators.decode import RecordSpec, decode_data, decode_envelope
from radiolake.operators.filters import storable
from radiolake.operators.nodes import NodeNames, gateway_changes, nodeinfo_changes
from radiolake.operators.packets import packet_rows
from radiolake.plans.tables import (
    Settings,
    decoded_messages,
    directory_changes,
    node_directory,
    packet_history,
)
from radiolake.schemas import PACKET_HISTORY
from radiolake_checks.records import HW_MODELS, PORTS, ROLES, SETTINGS, SPEC, make_descriptor, make_spec

BROKEN = bytes.fromhex("0a05")


@pytest.fixture(scope="module")
def ring(spark):
    return make_key_ring(spark)


@pytest.fixture(scope="module")
def history(raw, ring):
    def make(*pairs, settings=SETTINGS, keys=None):
        decoded = decoded_messages(raw(pairs), settings, keys or ring)
        return packet_history(decoded, settings).orderBy("timestamp").collect()

    return make


@pytest.fixture(scope="module")
def directory(raw, ring):
    def make(*pairs, settings=SETTINGS, keys=None):
        decoded = decoded_messages(raw(pairs), settings, keys or ring)
        return {r.node_id: r for r in node_directory(decoded, settings).collect()}

    return make


def seal(spark, plain: bytes, packet_id: int, sender: int, key: bytes) -> bytes:
    df = spark.createDataFrame([(plain, packet_id, sender, key)], "d binary, i bigint, s bigint, k binary")
    return bytes(df.select(aes_ctr(F.col("d"), F.col("i"), F.col("s"), F.col("k"))).first()[0])


def test_g1_json_topics_make_no_row(history):
    rows = history(
        ("msh/EU/2/json/x/!1", envelope(id=1)),
        ("msh/EU/json/2/x", envelope(id=2)),
        ("msh/EU/2/json", envelope(id=3)),
    )
    assert [r.mesh_packet_id for r in rows] == [3]
    assert rows[0].message_type == "json"


def test_g2_g3_failed_parse_is_kept(history, directory):
    row, again = history((TOPIC, BROKEN), (TOPIC, BROKEN))
    assert row.raw_service_envelope == again.raw_service_envelope == BROKEN
    assert row.parsing_error.startswith("Parsing error: ") and not row.processed_successfully
    assert (row.gateway_id, row.channel_id, row.payload_length, bytes(row.raw_payload)) == ("", "", 0, b"")
    kept = {
        "timestamp", "topic", "gateway_id", "channel_id", "payload_length", "raw_payload",
        "processed_successfully", "message_type", "raw_service_envelope", "parsing_error",
    }
    assert {n for n in PACKET_HISTORY.fieldNames() if row[n] is not None} == kept
    assert directory((TOPIC, BROKEN)) == {}


def test_bad_text_is_a_failed_parse(history):
    good = envelope(gateway="!abcdef12", channel="Zq")
    bad = good.replace(b"Zq", b"\xff\xfe")
    assert good != bad
    (row,) = history((TOPIC, bad))
    assert "error" in row.parsing_error and row.mesh_packet_id is None


def test_g4_absent_fields_read_as_defaults(history):
    (row,) = history((TOPIC, b""))
    assert row.processed_successfully and row.parsing_error is None
    assert (row.portnum, row.portnum_name, row.from_node_id, row.mesh_packet_id) == (0, "UNKNOWN_APP", 0, 0)
    assert (row.gateway_id, row.snr, row.via_mqtt, row.rx_time) == ("", 0.0, False, 0)


def test_g5_field_missing_from_descriptor_is_null(history, raw, ring):
    spec = make_spec(make_descriptor(leave_out=("channel_index", "rx_snr")))
    settings = Settings(spec, PORTS, HW_MODELS, ROLES)
    (row,) = history((TOPIC, envelope(spec=spec)), settings=settings)
    assert row.channel_index is None and row.snr is None and row.hop_limit == 0


def test_descriptor_checks():
    with pytest.raises(ValueError, match="lacks"):
        make_spec(make_descriptor(leave_out=("from",))).check()
    assert SPEC.enum("fx.PortNum") == PORTS


def test_descriptor_from_file(tmp_path):
    file = tmp_path / "fx.desc"
    file.write_bytes(make_descriptor())
    assert RecordSpec.from_file(str(file), SPEC.envelope, SPEC.data, SPEC.user) == SPEC


def test_g6_keys_and_first_arrival(history):
    rows = history(
        (TOPIC, envelope(gateway="", id=0, payload=b"first")),
        (TOPIC, BROKEN),
        (TOPIC, b""),
        (TOPIC, BROKEN),
        (TOPIC, envelope(id=5, payload=b"a")),
        (TOPIC, envelope(id=5, payload=b"b")),
        (TOPIC, envelope(gateway="!01", id=5, payload=b"c")),
    )
    assert [bytes(r.raw_payload) for r in rows] == [b"first", b"", b"", b"a", b"c"]


def test_g7_failed_decryption_is_not_an_error(history):
    (row,) = history((TOPIC, envelope(portnum=None, encrypted=b"\x01\x02\x03")))
    assert (row.portnum_name, row.payload_length, row.processed_successfully) == ("UNKNOWN_APP", 0, True)


def test_g8_unnamed_port_loses_the_row_but_not_the_gateway(history, directory):
    message = (TOPIC, envelope(portnum=999))
    assert history(message) == []
    assert set(directory(message)) == {0xABCDEF12}


def test_g9_out_of_range_loses_the_row_and_leaves_the_key_free(history, raw, ring):
    rows = history(
        (TOPIC, envelope(rx_time=2**31, payload=b"lost")),
        (TOPIC, envelope(rx_time=2**31 - 1, payload=b"kept")),
    )
    assert [bytes(r.raw_payload) for r in rows] == [b"kept"]
    decoded = decoded_messages(raw([(TOPIC, envelope(hop_limit=2**32 - 1))]), SETTINGS, ring)
    _, rejected = storable(packet_rows(decoded, PORTS))
    assert [r.reject_reason for r in rejected.collect()] == ["hop_limit out of range"]


def test_g9_text_with_nul_is_refused(history, directory):
    assert history((TOPIC, envelope(channel="a\0b"))) == []
    nodes = directory((TOPIC, nodeinfo(sender=1, long_name="a\0b")), (TOPIC, nodeinfo(sender=2)))
    assert set(nodes) == {2}


def test_g10_wrong_key_garbage_that_parses_counts(spark, history):
    """With a one-byte port tag, a wrong key can give a parsable record: the first one stays."""
    spec = make_spec(make_descriptor(port_field=1))
    settings = Settings(spec, PORTS, HW_MODELS, ROLES)
    first, second = bytes(range(16)), bytes(range(16, 32))
    keys = make_key_ring(
        spark,
        [("", base64.b64encode(second).decode())],
        default_key=base64.b64encode(first).decode(),
    )
    unnamed = data(999, b"x", spec)
    sealed = seal(spark, unnamed, 1, 7, first)
    message = envelope(portnum=None, encrypted=sealed, spec=spec)
    assert history((TOPIC, message), settings=settings, keys=keys) == []
    named = seal(spark, data(1, b"x", spec), 1, 7, second)
    (row,) = history(
        (TOPIC, envelope(portnum=None, encrypted=named, spec=spec)), settings=settings, keys=keys
    )
    assert row.portnum in (0, 1)


def test_first_valid_candidate_wins(spark):
    spec = make_spec(make_descriptor(port_field=1))
    blobs = [None, b"", BROKEN, data(0, b"zero", spec), data(999, b"unnamed", spec), data(1, b"late", spec)]
    df = spark.createDataFrame([(blobs,), ([],), (None,)], "c array<binary>")
    first, *rest = [r[0] for r in df.select(decode_data(F.col("c"), spec)).collect()]
    assert (first.rank, first.portnum, bytes(first.payload)) == (4, 999, b"unnamed")
    assert rest == [None, None]


@pytest.mark.parametrize("name", ["default", "topic", "ring", "bound", "own"])
def test_every_key_step_opens(spark, history, name):
    from radiolake_checks.views import CHANNEL_KEYS, DEFAULT_KEY, SOLO_KEY, WX_KEY
    import hashlib

    default = base64.b64decode(DEFAULT_KEY)
    keys = {
        "default": default,
        "topic": hashlib.sha256(default + b"LongFast").digest(),
        "ring": WX_KEY,
        "bound": hashlib.sha256(WX_KEY + b"LongFast").digest(),
        "own": hashlib.sha256(SOLO_KEY + b"Solo").digest(),
    }
    sealed = seal(spark, data(1, b"secret words"), 77, 8, keys[name])
    message = envelope(portnum=None, id=77, sender=8, encrypted=sealed)
    (row,) = history((TOPIC, message), keys=make_key_ring(spark, CHANNEL_KEYS))
    assert (row.portnum_name, bytes(row.raw_payload)) == ("FX_ONE", b"secret words")


@pytest.mark.parametrize("place", [0, 3, 4, 19, 20, 49])
def test_a_long_ring_is_searched_to_its_end(spark, history, place):
    """Keys at the borders of the steps."""
    ring = [(f"idle{i}", base64.b64encode(bytes([i]) * 16).decode()) for i in range(50)]
    sealed = seal(spark, data(1, b"secret words"), 77, 8, bytes([place]) * 16)
    message = envelope(portnum=None, id=77, sender=8, encrypted=sealed)
    (row,) = history((TOPIC, message), keys=make_key_ring(spark, ring))
    assert (row.portnum_name, bytes(row.raw_payload)) == ("FX_ONE", b"secret words")


def test_g12_wrong_length_keys_fail_quietly(spark, history):
    keys = make_key_ring(spark, [("", "AQ==")], default_key="AQID")
    (row,) = history((TOPIC, envelope(portnum=None, encrypted=b"xyz")), keys=keys)
    assert row.portnum == 0 and row.processed_successfully


def test_g13_g14_gateway_then_nodeinfo(directory):
    both = directory((TOPIC, nodeinfo(sender=0xABCDEF12, gateway="!abcdef12", id="!own", long_name="N")))
    assert both[0xABCDEF12].hex_id == "!own"
    nodes = directory(
        (TOPIC, nodeinfo(sender=0xABCDEF12, id="!own", long_name="N", is_licensed=True)),
        (TOPIC, envelope(gateway="!!ABCDEF12")),
    )
    node = nodes[0xABCDEF12]
    assert (node.hex_id, node.long_name, node.is_licensed) == ("!!ABCDEF12", "N", True)
    assert (node.last_updated - node.first_seen).total_seconds() == 1


def test_g15_first_seen_stays(directory):
    node = directory(*[(TOPIC, nodeinfo(sender=9, long_name=n)) for n in ("a", "b", "")])[9]
    assert node.long_name == "b"
    assert (node.last_updated - node.first_seen).total_seconds() == 2


def test_g16_keyed_by_sender(directory):
    nodes = directory((TOPIC, nodeinfo(sender=9, id="!0000000a")))
    assert {k: v.hex_id for k, v in nodes.items()} == {9: "!0000000a"}


def test_g17_unreadable_nodeinfo_keeps_the_packet(history, directory):
    broken = envelope(gateway="", portnum=4, payload=BROKEN, id=1, sender=1)
    unnamed = nodeinfo(sender=2, hw_model=77)
    role = nodeinfo(sender=3, role=77)
    pairs = [(TOPIC, m) for m in (broken, unnamed, role)]
    assert directory(*pairs) == {}
    assert [r.processed_successfully for r in history(*pairs)] == [True] * 3


def test_g18_unset_model(raw, ring):
    names = NodeNames({0: "OLD_UNSET_X"}, ROLES, 4)
    decoded = decoded_messages(raw([(TOPIC, nodeinfo())]), SETTINGS, ring)
    assert nodeinfo_changes(decoded, SPEC, names).first().hw_model == "OLD_Unknown_X"


def test_g19_what_overwrites(directory):
    node = directory(
        (TOPIC, nodeinfo(channel="c", id="!a", long_name="L", short_name="S", is_licensed=True, macaddr=b"\1\2")),
        (TOPIC, nodeinfo(channel="", is_licensed=False)),
    )[7]
    assert (node.hex_id, node.long_name, node.short_name) == ("!a", "L", "S")
    assert (node.is_licensed, node.primary_channel, node.mac_address) == (False, "", "01:02")


def test_g20_odd_gateways_make_no_node(directory):
    odd = ["^zz", "!", "0x12", "1_2", " 12"]
    assert directory(*[(TOPIC, envelope(gateway=g)) for g in odd]) == {}


def test_g21_g22_channels(history):
    (row,) = history(("msh/r/2/e/Topic/!1", envelope(channel="Envelope")))
    assert (row.channel_id, row.message_type) == ("Envelope", "e")


def test_gateway_changes_have_only_the_id(raw, ring):
    decoded = decoded_messages(raw([(TOPIC, envelope())]), SETTINGS, ring)
    row = gateway_changes(decoded).first()
    assert (row.node_id, row.hex_id) == (0xABCDEF12, "!abcdef12")
    assert {n for n in row.asDict() if row[n] is not None} == {
        "node_id", "hex_id", "first_seen", "last_updated", "seq", "step",
    }


def test_changes_come_from_rows_the_history_loses(raw, ring):
    message = envelope(portnum=4, payload=user(long_name="N"), rx_time=2**31, sender=5)
    decoded = decoded_messages(raw([(TOPIC, message)]), SETTINGS, ring)
    assert {r.node_id for r in directory_changes(decoded, SETTINGS).collect()} == {5, 0xABCDEF12}


def test_any_bytes_make_a_row(raw, ring):
    """Random and cut-off payloads: never an exception, always one history row or a refusal."""
    rng = random.Random(5)
    good = envelope(portnum=1, payload=b"x" * 40)
    blobs = [rng.randbytes(rng.randrange(60)) for _ in range(200)]
    blobs += [good[:n] for n in range(0, len(good), 3)]
    decoded = decoded_messages(raw([(TOPIC, b) for b in blobs]), SETTINGS, ring)
    kept, rejected = storable(packet_rows(decoded, PORTS))
    assert kept.count() + rejected.count() == len(blobs)


def test_decode_keeps_the_input(raw):
    df = decode_envelope(raw([(TOPIC, envelope()), (TOPIC, BROKEN)]), SPEC)
    first, second = df.orderBy("seq").collect()
    assert first.decode_error is None and first.env.packet["from"] == 7
    assert second.decode_error and second.env.packet is None and second.payload == BROKEN
