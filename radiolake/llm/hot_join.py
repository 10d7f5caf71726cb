"""Lookups in a table with one row per key, where a few keys may have a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys with this part of all rows or more are broadcast; there are HOT of them at most.
HOT = 2_048


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """Inner join of `left` with `right`, which has a row per key and, in column `rows`, how many rows
    of `left` have that key. Keys are not NULL.

    Hot keys are met where the rows lie, by a broadcast of HOT rows at most; what is left for the
    exchange has no key with more than a HOT-th of the rows. `left` is read twice.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    is_hot: Column = F.col(rows) * F.lit(HOT) >= F.lit(total)
    hot = F.broadcast(right.filter(is_hot))
    found = left.join(hot, keys)
    rest = left.join(hot.select(*keys), keys, "left_anti").join(right.filter(~is_hot), keys)
    return found.unionByName(rest)
