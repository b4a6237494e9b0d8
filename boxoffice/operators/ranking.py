"""Best rows and most frequent values per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _PART = "__rank", "__part"
# Spark's own threshold for cutting groups before a shuffle, and the parts of a group beyond it.
LIMITED = 1000
PARTS = 64


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every group; ``order`` must be total for a fixed answer.

    Up to ``LIMITED`` rows Spark cuts each group to ``k`` rows per map task before the shuffle, so a
    large group is never gathered whole. Beyond that it does not, so each group is first cut in
    ``PARTS`` parts, dealt by a hash of the row; only what is left of them meets.
    """
    if k > LIMITED:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))
        inner = Window.partitionBy(*group, _PART).orderBy(*order)
        df = df.withColumn(_PART, part).withColumn(_RANK, F.row_number().over(inner))
        df = df.where(F.col(_RANK) <= k).drop(_PART, _RANK)
    ranked = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(ranked)).where(F.col(_RANK) <= k).drop(_RANK)


def mode_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """The most frequent value per group with its count; ties go to the lowest value."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("frequency"))
    return top_k_per_group(counted, group, [F.desc("frequency"), F.asc(value)])
