"""Raw tables: files in their declared shape, landed by day of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from boxoffice.operators.conform import conform
from boxoffice.operators.merge import INGEST_DAY
from boxoffice.schemas import RAW
from boxoffice.sources.store import write_rows
from boxoffice.tables import Tables

ARRIVED = "ingested_at"


def land(rows: DataFrame, folder: str, name: str) -> None:
    """Append raw rows to ``<folder>/<table>``, one folder a day of arrival (UTC), sorted by arrival within.

    Tables without a time of arrival land in one folder.
    """
    rows = conform(rows, RAW[name])
    if ARRIVED in rows.columns:
        rows = rows.withColumn(INGEST_DAY, F.to_date(ARRIVED))
        write_rows(rows, f"{folder}/{name}", "append", [INGEST_DAY], [ARRIVED])
    else:
        write_rows(rows, f"{folder}/{name}", "append")


def read_raw(spark: SparkSession, folder: str) -> Tables:
    """Parquet folders ``<folder>/<table>``, read with the declared schemas (nothing is inferred).

    A record appears once per arrival, so keys repeat. A table that was landed by day keeps the
    day as a last column, by which ``lookback`` leaves whole folders out.
    """

    def reader(name: str):
        def read() -> DataFrame:
            path = f"{folder}/{name}"
            schema = RAW[name]
            if _by_day(spark, path):
                schema = StructType([*schema.fields, StructField(INGEST_DAY, DateType())])
            return conform(spark.read.schema(schema).parquet(path), schema)

        return read

    return Tables({name: reader(name) for name in RAW})


def _by_day(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{INGEST_DAY}=*")))
