"""Ranks of all rows within groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolake.llm.text import join_same
from radiolake.session import stage


def ranked(df: DataFrame, group: str, *order: str) -> tuple[DataFrame, DataFrame]:
    """df range-sorted by group and order with the column rank, from 0 in each group; and the
    number of rows n per group.

    One exchange; ranges cut through groups, so a group of any size is sorted by many tasks. A
    row's place in its partition is known as it is written; the rank needs only the number of
    rows of its group in the partitions before, of which there is a row per partition and group.
    Rows equal in group and order get different ranks, in any order.
    """
    sorted_rows = stage(
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_part", F.spark_partition_id())
        # monotonically_increasing_id counts a partition's rows in its lower 33 bits.
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "range_sorted",
    )
    runs = sorted_rows.groupBy("_part", group).agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first")
    )
    before = F.expr(
        f"sum(_n) OVER (PARTITION BY `{group}` ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    shifts = runs.select("_part", group, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    with_rank = (
        join_same(sorted_rows, shifts, ["_part", group])
        .withColumn("rank", F.col("_place") + F.col("_shift"))
        .select(*df.columns, "rank")
    )
    return with_rank, runs.groupBy(group).agg(F.sum("_n").alias("n"))
