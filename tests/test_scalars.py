from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from radiolake.functions import scalars
from radiolake.operators.filters import topic_matches, topic_regex


def each(spark, values, kind, column):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_topic_parts(spark):
    topics = ["a/b/c", "a/b/c/json", "m/r/2/e/Wx/!1", "m/r/2/e/e/!1", "m/r/2/c/c", "m/r/2/e/!aa/x", "m/r/2/e/"]
    assert each(spark, topics, "string", scalars.topic_message_type) == [
        None, "json", "e", "e", "c", "e", "e",
    ]
    assert each(spark, topics, "string", scalars.topic_channel) == ["", "", "Wx", "", "", "", ""]


def test_hex_ids(spark):
    given = {
        "!abcdef12": 0xABCDEF12, "!!ABCDEF12": 0xABCDEF12, "ff": 255, "!" + "0" * 30 + "ff": 255,
        "7fffffffffffffff": 2**63 - 1, "8000000000000000": None, "1" * 17: None, "000": 0,
        "": None, "!": None, "^zz": None, "0x1f": None, "1_0": None, "-1": None, " 1": None,
        "1\n": None, "a!b": None, None: None,
    }
    assert each(spark, list(given), "string", scalars.hex_to_node_id) == list(given.values())


def test_enum_name_null_for_unknown_and_local_broadcast(spark):
    df = spark.createDataFrame([(0,), (4,), (999,), (None,)], "n bigint")
    named = scalars.enum_name(df, F.col("n"), {0: "UNKNOWN_APP", 4: "NODEINFO_APP"}, "name")
    assert {(r.n, r.name) for r in named.collect()} == {
        (0, "UNKNOWN_APP"), (4, "NODEINFO_APP"), (999, None), (None, None),
    }
    assert "BroadcastHashJoin" in named._jdf.queryExecution().executedPlan().toString()


def test_large_lookup_is_not_broadcast(spark):
    names = spark.range(50).select(F.col("id").alias("number"), F.lit("x").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        df = scalars.enum_name(spark.range(100), F.col("id"), names, "name")
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_labels(spark):
    assert each(spark, ["UNSET", "A_UNSET_B", "TBEAM", None], "string", scalars.hw_label) == [
        "Unknown", "A_Unknown_B", "TBEAM", None,
    ]
    macs = [bytes([0, 0xAB, 0xFF]), b"\x01", b"", None]
    assert each(spark, macs, "binary", scalars.mac_text) == ["00:ab:ff", "01", None, None]
    assert each(spark, ["", "a", None], "string", scalars.empty_to_null) == [None, "a", None]
    assert each(spark, [10, 0xDEADBEEF], "bigint", scalars.node_label) == ["!0000000a", "!deadbeef"]
    assert each(spark, ["", "!a"], "string", scalars.gateway_label) == ["unknown", "!a"]
    pairs = spark.createDataFrame([("", ""), ("L", "S"), ("", "S")], "l string, s string")
    shown = pairs.select(scalars.display_name(F.col("l"), F.col("s"))).collect()
    assert [r[0] for r in shown] == ["No name", "L", "S"]


def test_payload_defaults(spark):
    df = spark.createDataFrame([(None,), (b"",), (b"ab",)], "p binary")
    rows = df.select(*scalars.payload_columns(F.col("p"))).collect()
    assert [(r.payload_length, bytes(r.raw_payload)) for r in rows] == [(0, b""), (0, b""), (2, b"ab")]


def test_arrival_timestamp(spark):
    stamps = [1700000000.123456, 0.0000005, 1.5, 1704067207.179575]
    made = [dt.datetime.fromtimestamp(s, tz=dt.timezone.utc) for s in stamps]
    got = each(spark, stamps, "double", lambda x: F.unix_micros(scalars.arrival_timestamp(x)))
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    assert got == [(m - epoch) // dt.timedelta(microseconds=1) for m in made]
    now = each(spark, [None], "double", scalars.arrival_timestamp)[0]
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 3600 * 24


@pytest.mark.parametrize(
    ("pattern", "topic", "expected"),
    [
        ("msh/+/+/+/#", "msh/a/b/c", True),
        ("msh/+/+/+/#", "msh/a/b/c/d/e", True),
        ("msh/+/+/+/#", "msh/a/b", False),
        ("msh/+/+/+/#", "xmsh/a/b/c", False),
        ("msh/+/+/+/#", "msh//b/c\n", True),
        ("msh/#", "msh", True),
        ("msh/#", "mshx", False),
        ("#", "anything/at/all", True),
        ("#", "$SYS/x", False),
        ("+/x", "$SYS/x", False),
        ("+/x", "a/x", True),
        ("+/x", "/x", True),
        ("+", "a", True),
        ("a.c", "abc", False),
        ("msh/+", "msh/a/b", False),
    ],
)
def test_topic_patterns(spark, pattern, topic, expected):
    assert each(spark, [topic], "string", lambda x: topic_matches(x, pattern)) == [expected]


@pytest.mark.parametrize("pattern", ["a/#/b", "a+/b", "a/b#"])
def test_bad_patterns(pattern):
    with pytest.raises(ValueError):
        topic_regex(pattern)
