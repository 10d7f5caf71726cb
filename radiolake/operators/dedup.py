"""First arrival wins: within a frame, against stored rows, and over an endless stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolake.schemas import PACKET_KEY


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def keyed_rows(df: DataFrame, keys: Sequence[str] = PACKET_KEY) -> DataFrame:
    """Rows whose key is whole."""
    return df.filter(~_any_null(keys))


def keyless_rows(df: DataFrame, keys: Sequence[str] = PACKET_KEY) -> DataFrame:
    """Rows with a NULL key part: no other row is ever equal to them."""
    return df.filter(_any_null(keys))


_SALT = "__salt"


def _salted(
    df: DataFrame, keys: Sequence[str], unique: bool = True, apart: Column | None = None
) -> DataFrame:
    """Add a part of the key that makes each keyless row a key of its own; 0 and up for those, else -1.

    So are rows for which `apart` holds.

    The number is a row's place in its input partition, so rows that are equal in all columns differ
    too. It only tells keyless rows apart and spreads them.
    """
    place = F.monotonically_increasing_id() if unique else F.lit(0).cast("bigint")
    own = _any_null(keys) if apart is None else _any_null(keys) | apart
    return df.withColumn(_SALT, F.when(own, place).otherwise(F.lit(-1).cast("bigint")))


def _first(salted: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys, _SALT).orderBy(*order)
    ranked = salted.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def first_arrival(
    df: DataFrame,
    keys: Sequence[str] = PACKET_KEY,
    order: Sequence[str] = ("timestamp", "seq"),
) -> DataFrame:
    """Keep the first row per key; a NULL key part equals nothing, so such rows all stay.

    One pass and one exchange. The rank filter runs before it too (WindowGroupLimit), so a key that
    holds a third of all rows leaves one row per input partition. A row without a whole key is a key
    of its own, so those rows spread evenly. The frame should come from a scan, as messages and staged
    tables do: a task that runs again must meet its rows in the same order.
    """
    return _first(_salted(df, keys), keys, order).drop(_SALT)


def new_only(batch: DataFrame, stored: DataFrame, keys: Sequence[str] = PACKET_KEY) -> DataFrame:
    """Drop rows whose key is stored already; rows with a NULL key part match nothing and all stay.

    `stored` may be any frame with the key columns. Spark chooses the join from real sizes; in an
    exchange the rows without a whole key spread evenly.
    """
    return _salted(batch, keys).join(_known(stored, keys), [*keys, _SALT], "left_anti").drop(_SALT)


def _known(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Not a literal -1: the optimizer would take it out of the join, and the batch be exchanged twice.
    return _salted(keyed_rows(stored, keys).select(*keys), keys, unique=False)


def first_new(
    batch: DataFrame,
    stored: DataFrame,
    order: Sequence[str] = ("timestamp", "seq"),
    apart: Column | None = None,
) -> DataFrame:
    """first_arrival, then new_only, on packet keys: rows are read and exchanged once for both.

    Rows for which `apart` holds go through as they are.
    """
    once = _first(_salted(batch, PACKET_KEY, apart=apart), PACKET_KEY, order)
    return once.join(_known(stored, PACKET_KEY), [*PACKET_KEY, _SALT], "left_anti").drop(_SALT)


def cut_hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row per key of each Arrow batch, in `order` or as they come; a narrow step for streams.

    Streams have no window to rank rows by, and the state takes rows one by one after the exchange. A
    key with a third of all rows leaves one row per batch of some thousands, before that exchange.
    """
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if order:
                rows = rows.sort_by([(name, "ascending") for name in order])
            placed = rows.select(names).append_column("__place", pa.array(np.arange(len(rows))))
            first = placed.group_by(names).aggregate([("__place", "min")]).column("__place_min")
            yield from rows.take(first).to_batches()

    return df.mapInArrow(run, df.schema)


def first_arrival_stream(
    df: DataFrame,
    keys: Sequence[str] = PACKET_KEY,
    within: str | None = None,
    time_column: str = "timestamp",
    order: Sequence[str] = (),
) -> DataFrame:
    """Endless dedup held in Spark's own state: one small entry per key, cost per batch only.

    Rows with a NULL key part bypass the state. A hot key is cut before the exchange to the state, to
    the first row in `order` of each Arrow batch. Across micro-batches the first arrival wins; which of
    several Arrow batches' rows inside one micro-batch stays is up to Spark; where that matters use
    radiolake.streaming.ingest.start_first_arrival. `within` bounds the state: a key is then unique
    within that time only, and rows later than that are dropped.
    """
    keyed = cut_hot_keys(keyed_rows(df, keys), keys, order)
    if within is None:
        once = keyed.dropDuplicates(list(keys))
    else:
        once = keyed.withWatermark(time_column, within).dropDuplicatesWithinWatermark(list(keys))
    return once.unionByName(keyless_rows(df, keys))
