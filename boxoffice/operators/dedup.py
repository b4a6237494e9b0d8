"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__version_rank"


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, audit: str | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """The newest version of every key.

    The order is total: rows equal in ``newest`` are ranked by all their other columns, so a
    re-run, or another split into partitions, picks the same row. Of rows equal but for their
    ``audit`` timestamp, which does not describe the record, the one loaded last is kept. Ranking with the ``= 1``
    filter in one query lets Spark keep a single row per key in each map task, before the
    shuffle, so a key repeated across a third of the input costs one row per task.

    ``within`` names columns that the key determines: rows that lie by them already are not shuffled again.
    """
    rest = [F.col(name).asc_nulls_first() for name in df.columns if name not in {*keys, *within, newest, audit}]
    last = [F.col(audit).desc_nulls_last()] if audit in df.columns else []
    ranked = Window.partitionBy(*keys, *within).orderBy(F.col(newest).desc_nulls_last(), *rest, *last)
    return df.withColumn(_RANK, F.row_number().over(ranked)).where(F.col(_RANK) == 1).drop(_RANK)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where no column tells versions apart: the lowest row, for a fixed answer."""
    rest = [F.col(name).asc_nulls_first() for name in df.columns if name not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*(rest or [F.col(name) for name in keys]))
    return df.withColumn(_RANK, F.row_number().over(ranked)).where(F.col(_RANK) == 1).drop(_RANK)
