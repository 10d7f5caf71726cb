"""The plans that scale depends on."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from radiolake.functions.crypto import make_key_ring
from radiolake.operators import dedup, nodes
from radiolake.plans.tables import decoded_messages, node_directory, packet_history, routed_rows
from radiolake.schemas import RAW_MESSAGES
from radiolake.operators.decrypt import ring_steps
from radiolake.operators.filters import storable
from radiolake.operators.packets import packet_rows
from radiolake.session import check_local, scratch_dir, stage
from radiolake.sources.history import append_history
from radiolake.sources.keys import earlier_keys
from radiolake.sources.messages import read_messages
from radiolake_checks.records import SETTINGS


@pytest.fixture(scope="module")
def stored(spark, raw):
    path = scratch_dir(spark, "plans")
    raw([("msh/EU/2/e/x/g", b"")]).write.parquet(path)
    return read_messages(spark, path)


@pytest.fixture(scope="module")
def decoded(spark, stored):
    return stage(decoded_messages(stored, SETTINGS, make_key_ring(spark)), "plans")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan_and_decoding_is_narrow(spark, stored):
    ring = make_key_ring(spark, [("Wx", "AQ==")])
    text = plan(decoded_messages(stored, SETTINGS, ring))
    assert "Exchange" not in text and "Join" not in text
    assert "StringStartsWith(topic,msh/)" in text and "StringContains(topic,/json/)" in text
    assert text.count("ArrowEvalPython") == 3
    assert text.index("parse_envelope") < text.index("RLIKE")
    assert plan(decoded_messages(stored, SETTINGS, make_key_ring(spark))).count("ArrowEvalPython") == 2


def test_each_record_is_parsed_once_per_table(spark, stored):
    whole = decoded_messages(stored, SETTINGS, make_key_ring(spark))
    text = plan(packet_history(stage(whole, "whole"), SETTINGS))
    assert "parse_envelope" not in text
    assert plan(packet_rows(whole, SETTINGS.ports)).count("parse_envelope") == 1


def test_history_reads_and_parses_its_input_once(spark, stored):
    whole = decoded_messages(stored, SETTINGS, make_key_ring(spark, [("Wx", "AQ==")]))
    text = plan(packet_history(whole, SETTINGS))
    assert text.count("FileScan") == 1 and text.count("ArrowEvalPython") == 3


def test_dedup_has_one_exchange_and_cuts_hot_keys_before_it(decoded):
    text = plan(packet_history(decoded, SETTINGS))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    before = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"WindowGroupLimit.*Partial", before)
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_hot_key_leaves_one_row_per_input_partition(spark):
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("mesh_packet_id"),
        F.lit("g").alias("gateway_id"),
        F.col("id").alias("seq"),
        F.timestamp_seconds("id").alias("timestamp"),
    )
    once = dedup.first_arrival(df)
    assert once.count() == 40_000 - len(range(0, 40_000, 3)) + 1
    assert once.filter("mesh_packet_id = 0").first().seq == 0


def test_keyless_rows_spread_evenly(spark):
    df = spark.range(0, 8_000, 1, 4).select(
        F.lit(None).cast("bigint").alias("mesh_packet_id"),
        F.lit("").alias("gateway_id"),
        F.col("id").alias("seq"),
        F.timestamp_seconds("id").alias("timestamp"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:  # they stay in the partitions they came in
        sizes = dedup.first_arrival(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 8_000
    assert max(r["count"] for r in sizes) < 8_000 / 2


def test_fold_meets_all_rows_in_a_hash_table(decoded):
    """Below the first exchange equal changes become one, without a sort."""
    text = plan(node_directory(decoded, SETTINGS))
    assert text.count("parse_user") == 1 and "partial_max_by" in text
    lowest = text[text.rindex("Exchange hashpartitioning(node_id") :]
    assert "HashAggregate(keys=[node_id" in lowest and "Sort" not in lowest and "partial_max(" in lowest


def test_hot_keys_are_cut_before_the_state(spark):
    schema = "mesh_packet_id bigint, gateway_id string, seq bigint, timestamp timestamp"
    source = scratch_dir(spark, "hot")
    spark.range(0, 30_000, 1, 2).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("mesh_packet_id"),
        F.lit("g").alias("gateway_id"),
        (30_000 - F.col("id")).alias("seq"),
        F.timestamp_seconds("id").alias("timestamp"),
    ).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    once = dedup.first_arrival_stream(stream, order=("seq",))
    query = once.writeStream.format("memory").queryName("hot").option(
        "checkpointLocation", scratch_dir(spark, "progress")
    )
    run = query.trigger(availableNow=True).start()
    run.awaitTermination()
    text = spark._jvm.PythonSQLUtils.explainString(once._jdf.queryExecution(), "simple")
    state = run.lastProgress["stateOperators"][0]
    assert spark.table("hot").count() == 10_000 == state["numRowsTotal"]
    assert state["customMetrics"]["numDroppedDuplicateRows"] < 10
    assert text.index("StreamingDeduplicate") < text.index("Exchange") < text.index("MapInArrow")


def test_gateway_part_reads_three_columns(decoded):
    text = plan(nodes.gateway_edges(decoded))
    (read,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert read == "ingest_ts:timestamp,seq:bigint,env:struct<gateway_id:string>"


def test_gateway_part_combines_in_a_hash_table(decoded):
    text = plan(nodes.gateway_edges(decoded))
    assert "HashAggregate" in text and "Sort" not in text[text.index("Exchange") :]


def test_key_check_reads_no_history(spark, decoded):
    """A second batch meets the key table and nothing that the first one stored."""
    out = scratch_dir(spark, "history")
    kept, _ = storable(packet_rows(decoded, SETTINGS.ports))
    append_history(kept, out, 0)
    text = plan(dedup.first_new(kept, earlier_keys(kept, f"{out}_keys", 1)))
    places = re.findall(r"Location: \w+(?: \[|\(1 paths\)\[)(.*?)\]", text)
    assert places and not any(f"{out}/" in p or p.endswith(out) for p in places)
    assert "LeftAnti" in text and "WindowGroupLimit" in text


def test_stored_keys_are_not_exchanged_for_a_small_batch(spark, decoded):
    out = scratch_dir(spark, "history")
    kept, _ = storable(packet_rows(decoded, SETTINGS.ports))
    append_history(kept, out, 0)
    known = earlier_keys(kept, f"{out}_keys", 1)
    known.collect()
    text = plan(known)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_a_batch_is_read_once_for_all_rows_it_stores(spark, decoded):
    """Stored, rejected and refused rows come from one scan, but for the keys of the batch."""
    out = scratch_dir(spark, "routed")
    rows = routed_rows(decoded, SETTINGS)
    assert plan(rows).count("FileScan") == 1 and plan(rows).count("Generate") == 1
    stays = F.col("table") == "packet_history"
    known = earlier_keys(rows.filter(stays), f"{out}_keys", 0)
    text = plan(dedup.first_new(rows, known, apart=~stays))
    scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
    assert len(scans) == 2  # the other one is for the keys
    assert len(re.findall(r"WindowGroupLimit.*Partial", text)) == 1


def test_dedup_and_key_check_share_one_exchange(spark):
    schema = "mesh_packet_id bigint, gateway_id string, topic string, seq bigint, timestamp timestamp"
    path = scratch_dir(spark, "history")
    spark.range(3).selectExpr(
        "id AS mesh_packet_id", "'g' AS gateway_id", "'t' AS topic", "id AS seq", "current_timestamp() AS timestamp"
    ).write.parquet(path)
    history = spark.read.schema(schema).parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = dedup.first_new(history, history)
        text = plan(df)
        assert len(re.findall(r"Exchange hashpartitioning\((.*?)\), ENSURE", text)) == 2
        assert "WindowGroupLimit" in text and "LeftAnti" in text
        assert df.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ring_goes_to_python_in_growing_steps(spark, stored):
    """Python evaluations grow with the logarithm of the ring: 4, 16 and 30 of 50 entries."""
    for entries, steps in ((4, 1), (9, 2), (20, 2), (50, 3)):
        ring = make_key_ring(spark, [(f"n{i}", "AQ==") for i in range(entries)])
        assert plan(decoded_messages(stored, SETTINGS, ring)).count("ArrowEvalPython") == 2 + steps


def test_ring_steps_take_each_entry_once_in_order():
    for size in (0, 1, 4, 5, 20, 21, 50, 84, 85, 1000):
        taken = [i for first, count in ring_steps(size) for i in range(first, first + count)]
        assert taken == list(range(size))
    assert len(ring_steps(5000)) == 6


def test_scratch_needs_a_shared_folder_on_a_cluster():
    for master in ("local", "local[4]", "local[*]"):
        check_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            check_local(master)


def test_input_schema_is_never_inferred(stored):
    assert stored.schema.fieldNames() == RAW_MESSAGES.fieldNames()
