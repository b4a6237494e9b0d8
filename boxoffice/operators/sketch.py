"""Distinct counts that can be merged: one small sketch a group, kept instead of the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers are 2 to this number; a sketch has at most 4 KB at 12, whatever it has counted.
LOG_REGISTERS = 12


def distinct_sketches(df: DataFrame, grain: Sequence[str], column: str, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """One sketch of the distinct values of ``column`` per group; null is no value.

    Sketches are filled in the map tasks, so a group of any size is shuffled as one sketch a task.
    """
    return df.groupBy(*grain).agg(F.hll_sketch_agg(column, F.lit(log_registers)).alias("sketch"))


def merged_sketches(sketches: DataFrame, grain: Sequence[str]) -> DataFrame:
    """``estimate`` of distinct values at a coarser grain, from stored sketches alone."""
    merged = sketches.groupBy(*grain).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("estimate", F.hll_sketch_estimate("sketch"))


def error_bound(log_registers: int = LOG_REGISTERS, deviations: float = 4.0) -> Column:
    """Relative error that an estimate stays within, as a literal: some standard deviations of the method."""
    return F.lit(deviations * 1.04 / 2 ** (log_registers / 2))
