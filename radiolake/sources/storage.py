"""Questions about folders that readers of parquet cannot answer: is it there, which version is done."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _open(spark, path)
    return files.exists(folder)


def finished_times(spark: SparkSession, path: str) -> dict[int, int]:
    """Numbers N for which path/v=N holds the mark of a finished write, and when it came, in milliseconds."""
    files, pattern = _open(spark, f"{path}/v=*/_SUCCESS")
    marks = {s.getPath().getParent().getName(): s.getModificationTime() for s in files.globStatus(pattern) or []}
    return {int(name[2:]): time for name, time in marks.items() if re.fullmatch(r"v=\d+", name)}


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers N, ascending, for which path/v=N holds the mark of a finished write."""
    return sorted(finished_times(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this application wrote."""
    files, folder = _open(spark, path)
    files.delete(folder, True)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers N, ascending, of the folders and files path/name=N, whatever is in them."""
    files, pattern = _open(spark, f"{path}/{name}=*")
    names = [status.getPath().getName() for status in files.globStatus(pattern) or []]
    return sorted(int(m.group(1)) for m in map(re.compile(rf"{name}=(\d+)").fullmatch, names) if m)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None where there is none, and for an empty one.

    No value is empty, so an empty file is one that a failure cut off: it says nothing, and the
    caller finds its value again from the folders.
    """
    files, file = _open(spark, path)
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode() or None
    finally:
        stream.close()


def _write_beside(spark: SparkSession, path: str, text: str):
    """The text in a new file beside `path`, closed: what is renamed from there is whole."""
    files, beside = _open(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return files, beside


def _rename(spark: SparkSession, beside, path: str, mode: str) -> None:
    """One step of the file system: readers see the old file or the new one, never a part."""
    jvm = spark._jvm
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = getattr(option, mode)
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        beside.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(beside, target, options)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file; False, and nothing changed, if it is there already."""
    files, file = _open(spark, path)
    if files.exists(file):
        return False
    files, beside = _write_beside(spark, path, text)
    try:
        _rename(spark, beside, path, "NONE")
    except Py4JJavaError:
        files.delete(beside, False)
        if files.exists(file):  # another writer was faster
            return False
        raise
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in the place of another, or of none, in one step."""
    files, beside = _write_beside(spark, path, text)
    try:
        _rename(spark, beside, path, "OVERWRITE")
    except Py4JJavaError:
        files.delete(beside, False)
        raise
