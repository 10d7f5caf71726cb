"""Whole tables against brute force; order, replay and stream against batch."""

from __future__ import annotations

from pathlib import Path

import pytest
from fx import START
from model import random_messages, sequential, to_pair
from pyspark.sql import functions as F

from radiolake.functions.crypto import make_key_ring
from radiolake.operators import dedup, nodes
from radiolake.operators.filters import storable
from radiolake.operators.packets import packet_rows
from radiolake.plans.tables import (
    decoded_messages,
    directory_changes,
    load_batch,
    node_directory,
    packet_history,
    write_tables,
)
from radiolake.schemas import NODE_INFO, NODE_VALUES, PACKET_HISTORY, RAW_MESSAGES, conform, ensure_table
from radiolake.session import scratch_dir, stage
from radiolake.sources.directory import drop_old_snapshots, drop_snapshot, read_nodes, write_nodes
from radiolake.sources.history import append_history, last_batch, read_history, read_rejected
from radiolake.sources.keys import compact_keys, drop_keys, earlier_keys, write_keys
from radiolake.sources.ledger import Ledger
from radiolake.sources.messages import messages_from_kafka, read_messages
from radiolake.sources.storage import delete, finished_versions, numbered, read_text, replace_text, write_new
from radiolake.streaming.directory import compact_directory, read_directory, start_directory
from radiolake.streaming.ingest import start_first_arrival, start_ingest, stream_writer
from radiolake_checks.records import SETTINGS

COUNT = 240


@pytest.fixture(scope="module")
def ring(spark):
    return make_key_ring(spark)


@pytest.fixture(scope="module")
def sample(raw):
    messages = random_messages(COUNT, seed=3)
    return messages, raw([to_pair(m) for m in messages]).repartition(3)


@pytest.fixture(scope="module")
def decoded(sample, ring):
    return stage(decoded_messages(sample[1], SETTINGS, ring), "decoded")


def number(moment) -> int:
    return int((moment.replace(tzinfo=None) - START).total_seconds())


def check_history(df, messages):
    stored, _ = sequential(messages)
    assert sorted(number(r.timestamp) for r in df.collect()) == sorted(stored)


def check_nodes(df, messages):
    _, expected = sequential(messages)
    rows = {r.node_id: r for r in df.collect()}
    assert set(rows) == set(expected)
    for node, want in expected.items():
        got = rows[node]
        assert {c: got[c] for c in NODE_VALUES} == {c: want.get(c) for c in NODE_VALUES}
        assert (number(got.first_seen), number(got.last_updated)) == (want["first"], want["last"])


def test_history_equals_brute_force(sample, decoded):
    check_history(packet_history(decoded, SETTINGS), sample[0])


def test_directory_equals_brute_force(sample, decoded):
    check_nodes(node_directory(decoded, SETTINGS), sample[0])


def test_gateway_edges_fold_like_all_changes(decoded):
    full = nodes.fold_nodes(nodes.gateway_changes(decoded))
    thin = nodes.fold_nodes(nodes.gateway_edges(decoded))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, thin.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_order_of_rows_does_not_matter(sample, decoded, seed):
    shuffled = decoded.repartition(7, F.rand(seed))
    check_history(packet_history(shuffled, SETTINGS), sample[0])
    check_nodes(node_directory(shuffled, SETTINGS), sample[0])


def test_batch_job(spark, sample, ring):
    out = scratch_dir(spark, "batch")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    load_batch(sample[1].filter("seq < 50"), SETTINGS, ring, f"{out}/plain")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    check_history(read_history(spark, f"{out}/plain/table=packet_history"), sample[0][:50])
    load_batch(sample[1], SETTINGS, ring, out)
    check_history(read_history(spark, f"{out}/table=packet_history"), sample[0])
    check_nodes(read_nodes(spark, f"{out}/node_info"), sample[0])
    reasons = {r.reject_reason for r in read_rejected(spark, f"{out}/table=rejected").collect()}
    assert reasons == {"portnum has no name", "rx_time out of range"}
    assert read_history(spark, f"{out}/table=packet_history").columns == PACKET_HISTORY.fieldNames()
    assert read_nodes(spark, f"{out}/node_info").columns == NODE_INFO.fieldNames()


def test_batches_in_turn_and_again(spark, sample, decoded):
    """Four batches, the last two run twice as after a failure: the tables do not change."""
    out = scratch_dir(spark, "turns")
    for batch in (0, 1, 2, 1, 2, 3, 3):
        part = decoded.filter(F.floor(F.col("seq") / (COUNT // 4)) == batch)
        write_tables(part, SETTINGS, out, "writer", batch)
    check_history(read_history(spark, f"{out}/table=packet_history"), sample[0])
    check_nodes(read_nodes(spark, f"{out}/node_info"), sample[0])


def test_a_failed_batch_goes_before_the_next_writer(spark, sample, decoded):
    """The first writer fails after its history is written; another writer comes; the first one again."""
    out = scratch_dir(spark, "failed")
    half = F.col("seq") < COUNT // 2
    first, second = decoded.filter(half), decoded.filter(~half)
    claim = Ledger(spark, out).claim("a", 0)
    kept, _ = storable(packet_rows(first, SETTINGS.ports))
    append_history(kept, f"{out}/table=packet_history", claim.number)
    write_tables(second, SETTINGS, out, "b", 0)
    assert read_history(spark, f"{out}/table=packet_history").filter(F.col("mesh_packet_id").isNull()).count() < COUNT
    assert write_tables(first, SETTINGS, out, "a", 0)
    assert not write_tables(first, SETTINGS, out, "a", 0)
    once = scratch_dir(spark, "once")
    write_tables(decoded, SETTINGS, once, "c", 0)
    keys = ("mesh_packet_id", "gateway_id")
    stored, wanted = (read_history(spark, f"{p}/table=packet_history").select(*keys) for p in (out, once))
    assert stored.count() == wanted.count()
    assert stored.exceptAll(wanted).count() == 0


def test_numbers_are_claimed_once(spark):
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    assert ledger.last() == -1
    a = ledger.claim("a", 0)
    assert (a.number, a.done, a.left_over) == (0, False, None)
    assert ledger.claim("a", 0).left_over == 0
    ledger.finish(0)
    assert ledger.claim("a", 0).done
    assert ledger.claim("b", 0).number == 1
    later = ledger.claim("a", 1)
    assert (later.number, later.left_over) == (2, 1)
    ledger.drop(1)
    ledger.finish(2)
    assert ledger.claim("b", 0).number == 3


def cut_off(path):
    assert Path(path).stat().st_size > 0
    Path(path).write_text("")
    for crc in Path(path).parent.glob(f".{Path(path).name}.crc"):
        crc.unlink()


def state_files(out):
    return {"/".join(p.relative_to(out).parts): p for p in Path(out).rglob("*") if p.is_file() and p.suffix not in (".crc", ".parquet") and p.name != "_SUCCESS"}


def test_state_files_cut_to_nothing(spark, sample, decoded):
    """Every state file in turn is emptied; later batches and batches that come again store the same."""
    out = scratch_dir(spark, "cut")
    half = F.col("seq") < COUNT // 2
    write_tables(decoded.filter(half), SETTINGS, out, "w", 0)
    compact_keys(spark, f"{out}/table=packet_history_keys")
    names = set(state_files(out))
    assert {"_ledger/last", "_ledger/claim/w/0", "_ledger/number/0", "_ledger/done/0", "table=packet_history/_last"} <= names
    assert not any(n.endswith(".tmp") for n in names)
    for name in sorted(names - {"_ledger/number/0"}):
        cut_off(state_files(out)[name])
        assert not write_tables(decoded.filter(half), SETTINGS, out, "w", 0), name
    assert write_tables(decoded.filter(~half), SETTINGS, out, "v", 0)
    for name in ("_ledger/last", "_ledger/claim/v/0", "table=packet_history/_last"):
        cut_off(state_files(out)[name])
    assert not write_tables(decoded.filter(~half), SETTINGS, out, "v", 0)
    assert last_batch(spark, f"{out}/table=packet_history") == 1
    check_history(read_history(spark, f"{out}/table=packet_history"), sample[0])
    check_nodes(read_nodes(spark, f"{out}/node_info"), sample[0])


def test_a_compaction_that_failed_changes_nothing(spark):
    keys = scratch_dir(spark, "keys")
    every = spark.createDataFrame([(i, "a") for i in range(9)], "mesh_packet_id bigint, gateway_id string")
    for i in range(3):
        write_keys(every.filter(F.col("mesh_packet_id") == i), keys, i)
    write_keys(every, f"{keys}/v=1", 0)  # a version without its mark
    assert sorted(r.mesh_packet_id for r in earlier_keys(every, keys, 3).collect()) == [0, 1, 2]
    compact_keys(spark, keys)
    cut_off(f"{keys}/v=1/_whole")
    assert sorted(r.mesh_packet_id for r in earlier_keys(every, keys, 3).collect()) == [0, 1, 2]


def test_a_stream_without_its_name_is_refused(spark):
    place = scratch_dir(spark, "progress")
    name = stream_writer(spark, place)
    assert stream_writer(spark, place) == name
    cut_off(f"{place}/writer")
    with pytest.raises(ValueError, match="is empty"):
        stream_writer(spark, place)


def test_text_files_are_whole(spark):
    place = scratch_dir(spark, "texts")
    assert write_new(spark, f"{place}/a", "1") and not write_new(spark, f"{place}/a", "2")
    replace_text(spark, f"{place}/a", "3")
    replace_text(spark, f"{place}/b", "4")
    assert (read_text(spark, f"{place}/a"), read_text(spark, f"{place}/b"), read_text(spark, f"{place}/c")) == ("3", "4", None)
    assert sorted(p.name for p in Path(place).iterdir() if p.suffix != ".crc") == ["a", "b"]


def test_older_batches_are_refused(spark, decoded):
    out = scratch_dir(spark, "older")
    kept, _ = storable(packet_rows(decoded, SETTINGS.ports))
    changes = directory_changes(decoded, SETTINGS)
    append_history(kept, f"{out}/h", 1)
    write_nodes(changes, f"{out}/n", 1)
    with pytest.raises(ValueError, match="comes after"):
        append_history(kept, f"{out}/h", 0)
    with pytest.raises(ValueError, match="comes after"):
        write_nodes(changes, f"{out}/n", 0)


def test_a_rerun_replaces_all_dates_of_its_batch(spark, decoded):
    out = scratch_dir(spark, "rerun")
    kept, _ = storable(packet_rows(decoded.filter("seq < 20"), SETTINGS.ports))
    other_day = kept.withColumn("timestamp", F.expr("timestamp + INTERVAL 3 DAYS"))
    append_history(kept, out, 0)
    count = read_history(spark, out).count()
    append_history(other_day, out, 0)
    assert read_history(spark, out).count() == count


def test_old_snapshots_are_dropped_when_asked(spark, decoded):
    out = scratch_dir(spark, "versions")
    changes = directory_changes(decoded, SETTINGS)
    for batch in range(4):
        write_nodes(changes, out, batch)
    assert finished_versions(spark, out) == [0, 1, 2, 3]
    drop_old_snapshots(spark, out, keep=2)
    assert finished_versions(spark, out) == [2, 3]


def _heard(spark, rows):
    """Changes (node_id, second, long_name) as write_nodes takes them."""
    values = {"long_name": "name"}
    made = spark.createDataFrame(rows, "node_id long, second long, name string")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("second"))
    return made.select(
        "node_id",
        *[
            (F.col(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in NODE_INFO.fields
            if f.name in NODE_VALUES
        ],
        at.alias("first_seen"),
        at.alias("last_updated"),
        F.col("second").alias("seq"),
        F.lit(1).alias("step"),
    )


def _folders(spark, out):
    return {b: numbered(spark, f"{out}/batch={b}", "bucket") for b in numbered(spark, out, "batch")}


def _names(spark, out):
    return {r.node_id: r.long_name for r in read_nodes(spark, out).collect()}


def test_a_batch_rewrites_only_the_buckets_it_touches(spark):
    out = scratch_dir(spark, "buckets")
    write_nodes(_heard(spark, [(n, n, f"n{n}") for n in range(200)]), out, 0)
    write_nodes(_heard(spark, [(7, 250, "seven")]), out, 1, bucket_rows=13)
    assert _folders(spark, out) == {0: [0], 1: list(range(16))}  # all nodes are dealt anew
    write_nodes(_heard(spark, [(7, 300, "new")]), out, 2, bucket_rows=13)
    assert len(_folders(spark, out)[2]) == 1
    rewritten = spark.read.parquet(f"{out}/batch=2")
    assert len(rewritten.inputFiles()) == 1 and 1 <= rewritten.count() < 40
    write_nodes(_heard(spark, [(7, 400, None), (1000, 401, "late")]), out, 3, bucket_rows=13)
    assert 1 <= len(_folders(spark, out)[3]) <= 2
    want = {n: f"n{n}" for n in range(200)} | {7: "new", 1000: "late"}
    assert _names(spark, out) == want
    write_nodes(_heard(spark, []), out, 4, bucket_rows=13)
    assert _folders(spark, out)[4] == [] and _names(spark, out) == want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_buckets_double_as_nodes_grow(spark, adaptive):
    out = scratch_dir(spark, "grow")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    for batch in range(4):
        rows = [(n, batch, f"b{batch}") for n in range(batch * 20, batch * 20 + 40)]
        write_nodes(_heard(spark, rows), out, batch, bucket_rows=10)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    numbers = {b: {r.buckets for r in spark.read.parquet(f"{out}/v={b}").collect()} for b in range(4)}
    assert numbers == {0: {1}, 1: {4}, 2: {8}, 3: {8}}  # 0, 40, 60 and 80 nodes stored
    assert sum(r.rows for r in spark.read.parquet(f"{out}/v=3").collect()) == 100
    assert _names(spark, out) == {n: f"b{min(n // 20, 3)}" for n in range(100)}


def test_a_batch_cut_off_before_its_snapshot_leaves_the_last_one(spark):
    out = scratch_dir(spark, "cut")
    write_nodes(_heard(spark, [(1, 1, "a"), (2, 2, "b")]), out, 0)
    write_nodes(_heard(spark, [(1, 3, "c")]), out, 1)
    delete(spark, f"{out}/v=1/_SUCCESS")  # its rows are written, its snapshot is not finished
    assert _names(spark, out) == {1: "a", 2: "b"}
    write_nodes(_heard(spark, [(2, 4, "d")]), out, 1)  # comes again, and has other rows
    assert _names(spark, out) == {1: "a", 2: "d"}
    drop_snapshot(spark, out, 1)
    assert _names(spark, out) == {1: "a", 2: "b"}


def test_dropped_snapshots_take_the_buckets_that_nobody_has(spark):
    out = scratch_dir(spark, "aged")
    write_nodes(_heard(spark, [(n, n, f"n{n}") for n in range(50)]), out, 0)
    for batch in range(1, 5):
        write_nodes(_heard(spark, [(7, 100 + batch, f"b{batch}")]), out, batch, bucket_rows=15)
    (hot,) = _folders(spark, out)[2]
    rest = [b for b in range(4) if b != hot]
    drop_old_snapshots(spark, out, keep=2)
    assert finished_versions(spark, out) == [3, 4]
    assert _folders(spark, out) == {0: [], 1: rest, 2: [], 3: [hot], 4: [hot]}
    assert _names(spark, out) == {n: f"n{n}" for n in range(50)} | {7: "b4"}
    write_nodes(_heard(spark, [(7, 200, "b5")]), out, 5, bucket_rows=15, keep_hours=-1)  # any age is too old
    assert finished_versions(spark, out) == [4, 5]
    assert _folders(spark, out) == {0: [], 1: rest, 2: [], 3: [], 4: [hot], 5: [hot]}
    write_nodes(_heard(spark, [(7, 201, "b5")]), out, 5, bucket_rows=15)  # the last batch can run again
    assert _names(spark, out)[7] == "b5"


def test_stream_batch_job_and_the_stream_again(spark, sample, ring):
    source, out = scratch_dir(spark, "incoming"), scratch_dir(spark, "tables")
    progress = scratch_dir(spark, "progress")
    place = F.floor(F.col("seq") / (COUNT // 5))

    def stream(*pieces):
        for piece in pieces:
            part = conform(sample[1].filter(place == piece), RAW_MESSAGES)
            part.coalesce(1).write.mode("append").parquet(source)
        read = read_messages(spark, source, streaming=True, max_files_per_trigger=1)
        start_ingest(read, SETTINGS, ring, out, progress).awaitTermination()

    stream(0, 1)
    assert load_batch(sample[1].filter(place == 2), SETTINGS, ring, out, job="middle")
    stream(3, 4)
    assert not load_batch(sample[1].filter(place == 2), SETTINGS, ring, out, job="middle")
    check_history(read_history(spark, f"{out}/table=packet_history"), sample[0])
    check_nodes(read_nodes(spark, f"{out}/node_info"), sample[0])
    assert finished_versions(spark, f"{out}/node_info") == [0, 1, 2, 3, 4]


def test_directory_held_in_state(spark, sample, decoded):
    """The fold as a streaming aggregate, in four runs from one checkpoint, compacted now and then."""
    source, progress, out = (scratch_dir(spark, n) for n in ("changes", "progress", "state"))
    full = nodes.node_changes(
        nodes.gateway_changes(decoded), nodes.nodeinfo_changes(decoded, SETTINGS.spec, SETTINGS.names)
    )
    assert read_directory(spark, out).count() == 0
    for quarter in range(4):
        part = full.filter(F.floor(F.col("seq") / (COUNT // 4)) == quarter)
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(full.schema).parquet(source)
        start_directory(stream, out, progress).awaitTermination()
        if quarter % 2:
            compact_directory(spark, out)
        seen = [m for m in sample[0][: (quarter + 1) * COUNT // 4]]
        check_nodes(read_directory(spark, out), seen)
    assert numbered(spark, out, "batch") == [3] and numbered(spark, out, "base") == [2]
    # A compaction that failed: its base lacks the mark and does not count.
    read_directory(spark, out).limit(0).write.parquet(f"{out}/base=3")
    (Path(out) / "base=3" / "_SUCCESS").unlink()
    check_nodes(read_directory(spark, out), sample[0])


def test_a_micro_batch_writes_only_the_nodes_it_touches(spark):
    source, progress, out = (scratch_dir(spark, n) for n in ("changes", "progress", "state"))
    none = [f"CAST(NULL AS {NODE_INFO[c].dataType.simpleString()}) AS {c}" for c in NODE_VALUES if c != "hex_id"]
    for first, count in ((0, 500), (7, 1)):
        changes = spark.range(first, first + count).selectExpr(
            "id AS node_id", "concat('!', id) AS hex_id", *none, "current_timestamp() AS first_seen",
            "current_timestamp() AS last_updated", "id AS seq", "0 AS step",
        )
        changes.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(changes.schema).parquet(source)
        start_directory(stream, out, progress).awaitTermination()
    assert [spark.read.parquet(f"{out}/batch={n}").count() for n in (0, 1)] == [500, 1]
    assert read_directory(spark, out).count() == 500


def test_endless_dedup_keeps_the_earlier_batch(spark):
    source, out = scratch_dir(spark, "keys"), scratch_dir(spark, "once")
    schema = "mesh_packet_id bigint, gateway_id string, seq bigint"
    progress = scratch_dir(spark, "progress")
    for rows in ([(1, "a", 0), (None, "", 1)], [(1, "a", 2), (None, "", 3), (2, "a", 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = dedup.first_arrival_stream(spark.readStream.schema(schema).parquet(source))
        writer = stream.writeStream.option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [0, 1, 3, 4]


def test_bounded_endless_dedup(spark):
    source, out = scratch_dir(spark, "keys"), scratch_dir(spark, "once")
    schema = "mesh_packet_id bigint, gateway_id string, seq bigint, timestamp timestamp"
    rows = [(1, "a", 0, START), (1, "a", 1, START), (None, "", 2, START), (None, "", 3, START)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    writer = dedup.first_arrival_stream(stream, within="1 hour").writeStream
    writer = writer.option("checkpointLocation", scratch_dir(spark, "progress"))
    writer.trigger(availableNow=True).start(out).awaitTermination()
    stored = spark.read.parquet(out).collect()
    assert len(stored) == 3 and {r.seq for r in stored} >= {2, 3}


def test_new_only(spark):
    schema = "mesh_packet_id bigint, gateway_id string, seq bigint"
    history = spark.createDataFrame([(1, "a", 0), (None, "", 1), (3, None, 2), (0, "", 3)], schema)
    batch = spark.createDataFrame(
        [(1, "a", 4), (1, "b", 5), (None, "", 6), (3, None, 7), (0, "", 8), (2, "a", 9)], schema
    )
    keys = scratch_dir(spark, "keys")
    write_keys(history.limit(1), keys, 0)
    write_keys(history, keys, 1)
    for _ in range(2):
        for stored in (history, earlier_keys(batch, keys, 2)):
            left = dedup.new_only(batch, stored)
            assert sorted(r.seq for r in left.collect()) == [5, 6, 7, 9]
        assert earlier_keys(batch, keys, 0).count() == 0
        compact_keys(spark, keys)


@pytest.mark.parametrize("dropped", [True, False])
def test_keys_of_earlier_batches_outlive_a_compacted_failed_one(spark, dropped):
    schema = "mesh_packet_id bigint, gateway_id string"
    keys = scratch_dir(spark, "keys")
    batches = [spark.createDataFrame([(i, "a")], schema) for i in range(4)]
    for i, batch in enumerate(batches):
        write_keys(batch, keys, i)
    compact_keys(spark, keys)  # batch 3 was not finished
    if dropped:
        drop_keys(spark, keys, 3)
    write_keys(spark.createDataFrame([(7, "a")], schema), keys, 3)
    every = spark.createDataFrame([(i, "a") for i in range(9)], schema)
    for _ in range(2):
        assert sorted(r.mesh_packet_id for r in earlier_keys(every, keys, 4).collect()) == [0, 1, 2, 7]
        assert sorted(r.mesh_packet_id for r in earlier_keys(every, keys, 3).collect()) == [0, 1, 2]
        compact_keys(spark, keys)


def test_keyless_rows_stay_when_they_repeat(spark):
    schema = "mesh_packet_id bigint, gateway_id string, seq bigint, timestamp timestamp"
    rows = [(None, "", 7, START)] * 3 + [(1, "a", 8, START), (1, "a", 9, START)]
    once = dedup.first_arrival(spark.createDataFrame(rows, schema))
    assert sorted(r.seq for r in once.collect()) == [7, 7, 7, 8]


def test_endless_first_arrival_inside_a_micro_batch(spark):
    source, out = scratch_dir(spark, "keys"), scratch_dir(spark, "once")
    schema = "mesh_packet_id bigint, gateway_id string, seq bigint"
    progress = scratch_dir(spark, "progress")
    for rows in ([(1, "a", 5), (1, "a", 0), (None, "", 1), (None, "", 1)], [(1, "a", 2), (2, "a", 4), (2, "a", 3)]):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        start_first_arrival(stream, out, progress, order=("seq",)).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [0, 1, 1, 3]


def test_merge_with_nothing_stored_and_nothing_new(spark, decoded):
    changes = nodes.gateway_changes(decoded)
    empty = spark.createDataFrame([], NODE_INFO)
    folded = sorted(map(tuple, nodes.fold_nodes(changes).collect()))
    assert sorted(map(tuple, nodes.merge_nodes(empty, changes).collect())) == folded
    stored = nodes.fold_nodes(changes)
    kept = nodes.merge_nodes(stored, changes.limit(0))
    assert sorted(map(tuple, kept.collect())) == folded


def test_kafka_rows(spark):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    rows = [(b"msh/a", b"x", "t", p, o, START) for p in (0, 1) for o in (0, 1, 2**40)]
    df = messages_from_kafka(spark.createDataFrame(rows, schema))
    got = df.collect()
    two = [(None, b"x", t, p, o, START) for t in ("t", "u") for p in (0, 1) for o in (0, 1, 2**40)]
    several = messages_from_kafka(spark.createDataFrame(two, schema), ("t", "u")).collect()
    assert len({r.seq for r in several}) == 12 and several[0].topic == ""
    with pytest.raises(Exception, match="topic not listed"):
        messages_from_kafka(spark.createDataFrame(two, schema), ("t",)).collect()
    assert len({r.seq for r in got}) == 6 and got[0].topic == "msh/a"
    assert df.schema.fieldNames() == RAW_MESSAGES.fieldNames()


def test_declared_tables(spark, decoded):
    place = scratch_dir(spark, "declared")
    for _ in range(2):
        ensure_table(spark, "declared_nodes", NODE_INFO, place)
    conform(node_directory(decoded, SETTINGS), NODE_INFO).write.insertInto("declared_nodes")
    stored = spark.table("declared_nodes")
    assert [f.dataType for f in stored.schema] == [f.dataType for f in NODE_INFO]
    assert stored.count() == node_directory(decoded, SETTINGS).count()
    spark.sql("DROP TABLE declared_nodes")
