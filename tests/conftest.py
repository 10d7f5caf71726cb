from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from fx import START  # noqa: E402
from radiolake.schemas import RAW_MESSAGES  # noqa: E402
from radiolake.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session, "radiolake", "radiolake_checks")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Build raw messages from (topic, payload) pairs, one second apart."""

    def make(pairs, first: int = 0):
        rows = [
            (topic, bytes(payload), START + dt.timedelta(seconds=first + i), first + i)
            for i, (topic, payload) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, RAW_MESSAGES)

    return make
