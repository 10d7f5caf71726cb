"""Every registered query against its SQL on the smallest tables, and the known counts at sf0.01."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from radiolake_checks.oracle import all_sql
from radiolake_checks.queries import all_queries
from radiolake.functions.scalars import enum_name
from radiolake.operators import dedup, filters
from radiolake_checks.compare import difference, tables
from radiolake_checks.records import PORTS
from radiolake_checks.views import packets
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return tables(SMALL)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, connection, name):
    assert difference(all_queries()[name](spark, SMALL), connection, all_sql()[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_operator_is_registered():
    numbers = {name[:3] for name in all_queries() if name.startswith("o")}
    assert numbers == {f"o{n:02d}" for n in range(1, 38)}
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(driver.queries())


def test_known_counts(spark):
    every = packets(spark, MIDDLE)
    topic = F.col("topic")
    heard = filters.skip_json(every.filter(filters.topic_matches(topic)))
    assert every.count() == 10_000
    assert every.filter(topic.contains("/json/")).count() == 1_788
    assert every.filter(~filters.topic_matches(topic)).count() == 910
    assert heard.count() == 7_302
    assert heard.filter("mesh_packet_id IS NULL").count() == 1_833
    assert dedup.first_arrival(heard, order=("ingest_ts", "seq")).count() == 6_771
    assert every.filter("rx_time > 2147483647").count() == 79
    assert enum_name(every, F.col("portnum"), PORTS, "n").filter("portnum = 999").count() == 78
    assert every.filter(filters.topic_matches(topic) & (F.col("portnum") == 4)).count() == 1_836
