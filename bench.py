"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Building binary messages from the `events` table is preparation and is not timed. Every timed
query runs in full (the noop sink), once to warm up and then BENCH_RUNS times; the best counts.
`rows_per_sec` is raw messages over that time.
"""

from __future__ import annotations

import base64
import itertools
import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolake.functions.crypto import make_key_ring
from radiolake.operators.dedup import first_arrival
from radiolake.operators.filters import storable
from radiolake.operators.nodes import fold_nodes
from radiolake.operators.packets import packet_rows
from radiolake.plans.tables import (
    decoded_messages,
    directory_changes,
    load_batch,
    node_directory,
    packet_history,
)
from radiolake.schemas import RAW_MESSAGES, conform
from radiolake.session import local_session, scratch_dir, ship_package, stage
from radiolake.sources.history import append_history
from radiolake.sources.messages import read_messages
from radiolake.streaming.ingest import start_ingest
from radiolake_checks.records import SETTINGS
from radiolake_checks.views import CHANNEL_KEYS, key_ring, messages_from, packets

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def _ring(spark: SparkSession, extra: int) -> DataFrame:
    """The three fixture keys that open packets come last, after keys that open none."""
    if extra == 0:
        return make_key_ring(spark)
    if extra == 1:
        return make_key_ring(spark, CHANNEL_KEYS[:1])
    idle = [(f"idle{i}", base64.b64encode(bytes([i]) * 16).decode()) for i in range(extra - 3)]
    return make_key_ring(spark, idle + CHANNEL_KEYS)


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, "bench", **{"spark.sql.shuffle.partitions": CPUS})
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark, "radiolake", "radiolake_checks")

    start = time.time()
    # One file per core, as a landing zone written by several receivers would look.
    spread = packets(spark, SF_DIR).repartition(int(CPUS))
    raw = stage(messages_from(spread), "bench_raw").withColumn(
        "ingest_ts", F.col("ingest_ts").cast("timestamp")
    )
    count = raw.count()
    decoded = stage(decoded_messages(raw, SETTINGS, key_ring(spark)), "bench_decoded")
    rows = stage(storable(packet_rows(decoded, SETTINGS.ports))[0], "bench_rows")
    changes = stage(directory_changes(decoded, SETTINGS), "bench_changes")
    filled, number = scratch_dir(spark, "bench_history"), itertools.count(1)
    append_history(rows, filled, 0)
    files = max(4, int(CPUS) // 4 * 4)
    landing = scratch_dir(spark, "bench_landing")
    conform(raw, RAW_MESSAGES).repartition(files).write.parquet(landing)
    prepared = time.time() - start

    queries = {
        "o17_decrypt_0_keys": lambda: _run(decoded_messages(raw, SETTINGS, _ring(spark, 0))),
        "o17_decrypt_1_key": lambda: _run(decoded_messages(raw, SETTINGS, _ring(spark, 1))),
        "o17_decrypt_8_keys": lambda: _run(decoded_messages(raw, SETTINGS, _ring(spark, 8))),
        "o17_decrypt_50_keys": lambda: _run(decoded_messages(raw, SETTINGS, _ring(spark, 50))),
        "o18_o32_history_from_decoded": lambda: _run(packet_history(decoded, SETTINGS)),
        "o32_first_arrival": lambda: _run(first_arrival(rows)),
        "o34_o35_directory_from_decoded": lambda: _run(node_directory(decoded, SETTINGS)),
        "o35_fold_nodes": lambda: _run(fold_nodes(changes)),
        "history_from_raw": lambda: _run(
            packet_history(decoded_messages(raw, SETTINGS, key_ring(spark)), SETTINGS)
        ),
        "load_batch_all_tables": lambda: load_batch(
            raw, SETTINGS, key_ring(spark), scratch_dir(spark, "bench_tables")
        ),
        "second_batch_against_a_filled_history": lambda: append_history(rows, filled, next(number)),
        "stream_four_batches": lambda: start_ingest(
            read_messages(spark, landing, streaming=True, max_files_per_trigger=files // 4),
            SETTINGS,
            key_ring(spark),
            scratch_dir(spark, "bench_stream"),
            scratch_dir(spark, "bench_progress"),
        ).awaitTermination(),
    }
    seconds = {}
    for name, run in queries.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.time()
            run()
            times.append(time.time() - start)
        seconds[name] = round(min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {n: round(count / s) for n, s in seconds.items()},
                "messages": count,
                "prepare_sec": round(prepared, 3),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
