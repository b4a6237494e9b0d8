"""Seed tables."""

from __future__ import annotations

import csv
import datetime as dt
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from boxoffice.operators.conform import conform
from boxoffice.schemas import SEED


# The rows of data/currency_rates.csv.


def read_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Currency rates from a CSV file with header, typed by declaration.

    Without a path the file shipped with the package is used. It lies on the driver only, so
    its few rows travel inside the plan, where Spark knows their size.
    """
    if path:
        return conform(spark.read.schema(SEED).option("header", True).csv(path), SEED)
    return conform(spark.createDataFrame(pa.Table.from_pylist(packaged_rates())), SEED)


def packaged_rates() -> list[dict]:
    text = resources.files("boxoffice").joinpath("data/currency_rates.csv").read_text(encoding="utf-8")
    return [
        {**row, "rate": float(row["rate"]), "effective_date": dt.date.fromisoformat(row["effective_date"])}
        for row in csv.DictReader(text.splitlines())
    ]
