"""Session settings, the shared scratch folder, and shipping this package to the workers."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from radiolake.sources.storage import delete

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_shipped: set[tuple[str, str]] = set()
_own_scratch: dict[str, str] = {}


def local_session(cores: str = "8", app: str = "radiolake", **settings: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    options = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        **settings,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def check_local(master: str) -> None:
    """Raise unless driver and executors are one process."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share; master is {master}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint folder.

    Without that setting a session on one machine gets a local folder of its own. On a cluster each
    executor would write to its own disk and a later read would miss files, so that is refused.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        check_local(spark.sparkContext.master)
        application = spark.sparkContext.applicationId
        if application not in _own_scratch:
            _own_scratch[application] = tempfile.mkdtemp(prefix="radiolake-")
        base = _own_scratch[application]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, lineage cut.

    Unlike a cached frame it survives the loss of any executor, and readers prune its columns.
    """
    path = path or scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """stage() for the length of a block; the folder goes when the block ends, either way."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    try:
        yield stage(df, name, path)
    finally:
        delete(spark, path)


def ship_package(spark: SparkSession, *names: str) -> None:
    """Send packages next to this one to the Python workers, once per application."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    for name in names or ("radiolake",):
        if (context.applicationId, name) in _shipped:
            continue
        archive = Path(tempfile.mkdtemp(prefix="radiolake-ship-")) / f"{name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / name).rglob("*.py")):
                out.write(file, file.relative_to(root))
        context.addPyFile(str(archive))
        _shipped.add((context.applicationId, name))
