"""Tables written in the shared folder, so that lineage ends there and a lost executor costs no recomputation."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.session import scratch_path

# A side of a join may be broadcast up to this many narrow rows (a few tens of MB); counted, not guessed.
BROADCAST_ROWS = 1_000_000


# Bytes of a batch of rows for Python. Executor and worker both hold one for every running task.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, plans hand rows to Python in batches of ``BATCH_BYTES`` at most (or one wider row); then as before.

    Spark's own bound is 64 MB, outside of the heap of the executor, and again in the worker.
    """
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: computed once, stable afterwards.

    What was shuffled for it is of no more use then; Spark removes those files when the driver
    collects its garbage, so that is asked for here instead of at the next half hour.
    """
    path = scratch_path(df.sparkSession, purpose)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow stored table, marked for broadcast when its counted rows fit the bound; else left to the planner."""
    return F.broadcast(df) if df.count() <= rows else df


# Bits of the filter before a join: 8 MB, whatever the tables; about 60 million keys fill it.
FILTER_BITS = 1 << 26
_BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions


def likely(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows of ``df`` whose key may be among those of ``wanted``: all that are, and few others.

    A bitmap of fixed size goes to every executor, so that wide rows which a join would drop are not
    shuffled for it, and no worker of Python is needed. A full bitmap lets all rows pass; the join that follows decides.
    """
    bit = F.pmod(F.xxhash64(wanted_key), F.lit(FILTER_BITS))
    maps = (
        wanted.select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / _BITMAP_BITS).alias("__part"))
        .agg(F.bitmap_construct_agg(F.col("bit") % _BITMAP_BITS).alias("__bits"))
    )  # FILTER_BITS / 32768 rows of 4 KB at most
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    at = (bit % _BITMAP_BITS).cast("int")
    byte = F.substring("__bits", F.shiftright(at, 3) + 1, F.lit(1))
    there = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(7)) == 1
    placed = df.withColumn("__part", F.floor(bit / _BITMAP_BITS))
    return placed.join(F.broadcast(maps), "__part").where(there).select(*df.columns)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
