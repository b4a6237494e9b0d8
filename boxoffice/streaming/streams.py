"""Silver tables fed by a stream of raw records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from boxoffice.operators.conform import conform
from boxoffice.operators.dedup import any_per_key
from boxoffice.plans.incremental import Shape, upsert
from boxoffice.schemas import RAW
from boxoffice.sources.store import LayerStore, arranged, in_parts

# Partition columns of the output of dedup_replays.
_DAY, _BATCH = "arrival_day", "batch"


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream of Parquet files below a folder; ``path`` may also name one file of it."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder, _, name = path.rstrip("/").rpartition("/")
    if _is_file(spark, path):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def raw_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw records of a landing folder, in their declared shape."""
    return conform(file_stream(spark, f"{folder}/{name}", RAW[name], files_per_batch), RAW[name])


def stream_upsert(
    source: DataFrame, store: LayerStore, name: str, shape: Shape, checkpoint: str
) -> StreamingQuery:
    """Upsert every micro-batch of a raw stream into a silver table, then stop when drained.

    The state keeps every key, so no watermark is needed and a record may arrive any time later.
    Batches may hold older versions: the newest version wins, so the table ends as a full refresh
    of the same records would leave it. A batch's number is stored in the same step as its rows,
    under the name of the checkpoint, so a batch that is repeated after a failure is skipped; one that
    stopped half-way is first rolled forward.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(store, batch, name, shape, checkpoint, batch_id)

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_exact(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drops repeats of a key; the first arrival is kept, however late it is.

    For records sent twice unchanged. It does not replace ``latest_per_key``: a corrected
    version arrives later and would be the one dropped. The state holds every key ever seen,
    spread over the shuffle partitions; with the RocksDB state store it lies on disk. Where
    repeats carry the same time of arrival, ``dedup_replays`` needs no state.
    """
    return stream.dropDuplicates(list(keys))


def dedup_replays(
    stream: DataFrame, out: str, keys: Sequence[str], arrived: str, checkpoint: str
) -> StreamingQuery:
    """Appends every record to ``out`` once, then stops when drained; read it with ``read_deduplicated``.

    For records that are sent again unchanged, so that a repeat has the time of arrival of the
    record it repeats, however late it comes. The output is kept by day of arrival and is its own
    memory: a micro-batch is held against the stored keys of its own days only, a list bounded by the calendar.
    So a first record is kept and a repeat dropped at any age, and no state is held in memory.
    A batch's rows lie in a folder of its number, which a repeated batch replaces.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = any_per_key(batch.withColumn(_DAY, F.to_date(arrived)), [*keys, _DAY]).persist()
        try:
            days = [row[0] for row in rows.select(_DAY).distinct().collect()]
            fresh = rows
            if _exists(spark, out):
                schema = rows.withColumn(_BATCH, F.lit(0).cast("bigint")).schema
                before = spark.read.schema(schema).parquet(out).where(in_parts(F.col(_DAY), days))
                before = before.where(F.col(_BATCH) != batch_id).select(*keys, _DAY)
                same = reduce(and_, [rows[name].eqNullSafe(before[name]) for name in (*keys, _DAY)])
                fresh = rows.join(before, same, "left_anti")
            placed = fresh.withColumn(_BATCH, F.lit(batch_id).cast("bigint"))
            by_day = arranged(placed, [_DAY], keys).write.partitionBy(_BATCH, _DAY)
            by_day.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(out)
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_deduplicated(spark: SparkSession, out: str) -> DataFrame:
    """The records that ``dedup_replays`` has kept."""
    return spark.read.parquet(out).drop(_BATCH, _DAY)


def dedup_within(stream: DataFrame, keys: Sequence[str], arrived: str, delay: str = "3 days") -> DataFrame:
    """Like ``dedup_exact`` with a state that forgets keys after ``delay``.

    The price: a record that arrives later than ``delay`` after the newest one is dropped even
    if it is the first of its key. Use it where such records are known to be repeats.
    """
    return stream.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(list(keys))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path) and fs.getFileStatus(jvm_path).isFile()
