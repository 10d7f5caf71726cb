from __future__ import annotations

import base64
import hashlib
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from radiolake.functions import crypto
from radiolake.functions.scalars import topic_channel

DEFAULT = base64.b64decode(crypto.DEFAULT_KEY)
PLAIN = bytes(range(40))


def ctr(spark, rows):
    df = spark.createDataFrame(rows, "data binary, id bigint, sender bigint, key binary")
    out = df.select(crypto.aes_ctr(F.col("data"), F.col("id"), F.col("sender"), F.col("key")))
    return [bytes(r[0]) for r in out.collect()]


def derived(spark, channel, key):
    df = spark.createDataFrame([(channel, key)], "channel string, key binary")
    return bytes(df.select(crypto.derive_key(F.col("channel"), F.col("key"))).first()[0])


@pytest.mark.parametrize(
    ("channel", "key", "sealed"),
    [
        (
            "",
            "d4f1bb3a20290759f0bcffabcf4e6901",
            "a3a2399282716f39a1dd9a095bc7fd85ea119ef6ac5379af3a70a40f4d1b0ec14e6e2309499b918a",
        ),
        (
            "LongFast",
            "fff10e0a9a7de9c0ee47ecc383cdb4cd3550d189d12e905da0ced21f2fed75ac",
            "d06f25c6a5945d2e0ded14d41be662cc4fdb6af8cfaaa8d9f6835540be60b8fc7aaf101144a05bfa",
        ),
    ],
)
def test_golden(spark, channel, key, sealed):
    made = derived(spark, channel, DEFAULT)
    assert made.hex() == key
    assert ctr(spark, [(PLAIN, 0x12345678, 0xDEADBEEF, made)])[0].hex() == sealed
    assert ctr(spark, [(bytes.fromhex(sealed), 0x12345678, 0xDEADBEEF, made)])[0] == PLAIN


def test_published_counter_mode_vector(spark):
    """First block of the AES-128 counter-mode example in NIST SP 800-38A, F.5.1."""
    df = spark.createDataFrame(
        [
            (
                bytes.fromhex("6bc1bee22e409f96e93d7e117393172a"),
                bytes.fromhex("f0f1f2f3f4f5f6f7f8f9fafbfcfdfeff"),
                bytes.fromhex("2b7e151628aed2a6abf7158809cf4f3c"),
            )
        ],
        "data binary, block binary, key binary",
    )
    stream = crypto.keystream(F.col("block"), F.col("key"))
    out = df.select(crypto.xor_bytes(F.col("data"), stream)).first()[0]
    assert bytes(out).hex() == "874d6191b620e3261bef6864990db6ce"


def test_xor_takes_little_more_than_its_bytes():
    """Whole batches of long and of short values, against Python's own XOR, one byte each."""
    for size, count in ((2500, 1600), (40, 100_000)):
        data = [bytes([i % 251]) * (size - i % 3) for i in range(count)]
        batch, stream = pa.array(data), pa.array([bytes([i % 13]) * (size + 16) for i in range(count)])
        tracemalloc.start()
        mixed = crypto.xor_bytes.func(batch, stream)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 4 * sum(map(len, data))
        assert mixed.to_pylist() == [bytes([i % 251 ^ i % 13]) * len(d) for i, d in enumerate(data)]


def test_failures_give_no_bytes(spark):
    good = (PLAIN, 1, 2, DEFAULT)
    bad = [
        (b"", 1, 2, DEFAULT), (PLAIN, 1, 2, b"\x01"), (PLAIN, 1, 2, b""), (PLAIN, 1, 2, None),
        (PLAIN, -1, 2, DEFAULT), (PLAIN, 1, -2, DEFAULT), (PLAIN, 1, 2**32, DEFAULT),
    ]
    out = ctr(spark, [good, *bad])
    assert len(out[0]) == len(PLAIN)
    assert out[1:] == [b""] * len(bad)


def test_block_edges_and_ids(spark):
    """Each length is a prefix of the longest, and every id bit matters."""
    lengths = [1, 15, 16, 17, 31, 32, 33, 5000]
    long = bytes(5000)
    rows = [(long[:n], 2**40 + 5, 0xFEDCBA98, DEFAULT) for n in lengths]
    out = ctr(spark, rows)
    assert [len(x) for x in out] == lengths
    assert all(out[-1].startswith(x) for x in out)
    ids = [(long[:16], 1 << b, 0, DEFAULT) for b in range(63)]
    senders = [(long[:16], 0, 1 << b, DEFAULT) for b in range(32)]
    assert len(set(ctr(spark, ids + senders))) == 95


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.binary(max_size=300), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), min_size=1, max_size=20))
def test_round_trip(spark, rows):
    key = hashlib.sha256(b"k").digest()
    sealed = ctr(spark, [(d, i, s, key) for d, i, s in rows])
    opened = ctr(spark, [(c, i, s, key) for c, (_, i, s) in zip(sealed, rows)])
    assert opened == [d for d, _, _ in rows]


def candidates(spark, topic, ring):
    df = spark.createDataFrame([(topic,)], "topic string")
    df = df.withColumn("keys", crypto.key_ring_column(ring))
    keys = crypto.candidate_keys(topic_channel(F.col("topic")), F.col("keys"))
    return [bytes(k) for k in df.select(keys).first()[0]]


def test_candidate_order(spark):
    wx = bytes(range(16))
    ring = crypto.make_key_ring(spark, [("Wx", base64.b64encode(wx).decode()), ("", "AQ==")])
    sha = lambda *parts: hashlib.sha256(b"".join(parts)).digest()
    assert candidates(spark, "m/r/2/e/LongFast/g", ring) == [
        DEFAULT, sha(DEFAULT, b"LongFast"), wx, sha(wx, b"LongFast"), sha(wx, b"Wx"), b"\x01",
        sha(b"\x01", b"LongFast"),
    ]
    assert candidates(spark, "m/r/2/e/e/g", ring) == [DEFAULT, wx, sha(wx, b"Wx"), b"\x01"]


def test_bad_base64_becomes_a_zero_key(spark):
    ring = crypto.make_key_ring(spark, [("Wx", "AQ="), ("Ok", "AQ==")], default_key="nonsense=a")
    found = candidates(spark, "m/r/2/e/Chan/g", ring)
    assert found[:5] == [bytes(32)] * 5
    assert found[5] == b"\x01"


def test_keys_stay_out_of_plans(spark):
    df = spark.createDataFrame([("m/r/2/e/Chan/g",)], "topic string")
    ring = crypto.make_key_ring(spark, [("Secret", base64.b64encode(b"s" * 16).decode())])
    df = df.withColumn("keys", crypto.key_ring_column(ring))
    df = df.select(crypto.candidate_keys(F.lit("c"), F.col("keys")).alias("c"))
    df.collect()
    text = df._jdf.queryExecution().toString()
    for secret in ((b"s" * 16).hex(), DEFAULT.hex(), "ssss", "Secret"):
        assert secret.lower() not in text.lower()
