"""Whole-table order without a single task: cut points, parts, neighbours.

A table is cut into ranges of an integer key at quantiles of that key. Only
the quantiles, one per part, come to the driver; rows are shuffled once, to
the part of their range, and sorted there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def part_count(spark: SparkSession) -> int:
    """As many parts as the session shuffles into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, key: str, parts: int) -> list[int]:
    """Ascending keys at which the parts begin; the first is the smallest key.

    Each is a key of the table, so no part is empty. Empty for a table without keys.
    """
    wanted = [i / parts for i in range(parts)]
    found = df.select(
        F.min(key).alias("least"), F.percentile_approx(key, wanted, 10_000).alias("cuts")
    ).first()
    if found.least is None:
        return []
    return sorted({found.least, *found.cuts})


def part_of(key: Column, cuts: list[int]) -> Column:
    """Index of the range a key lies in; null keys belong to the first.

    A binary search written out, so that a row costs a few comparisons.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(key < F.lit(cuts[middle]), search(low, middle - 1)).otherwise(
            search(middle, high)
        )

    if len(cuts) < 2:
        return F.lit(0)
    return F.when(key.isNull(), F.lit(0)).otherwise(search(0, len(cuts) - 1))


def to_parts(df: DataFrame, part: str, parts: int, *order: str) -> DataFrame:
    """Rows with equal ``part`` (0 to ``parts`` - 1) in one task, in order, nulls first."""
    return df.repartitionById(max(1, parts), F.col(part)).sortWithinPartitions(part, *order)
