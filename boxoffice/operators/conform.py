"""Bring a DataFrame to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType, lenient: bool = False) -> DataFrame:
    """The declared columns, in order, cast to their types, with their metadata.

    A value that does not fit its type fails the job; ``lenient`` turns it into NULL instead.
    Whether required values are present is a check on the rows, see ``missing_required``.
    """
    cast = "TRY_CAST" if lenient else "CAST"
    return df.select(
        *[
            F.expr(f"{cast}(`{field.name}` AS {field.dataType.simpleString()})").alias(
                field.name, metadata=field.metadata
            )
            for field in schema.fields
        ]
    )


def required_columns(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


def missing_required(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows that lack a value the schema requires (file reads do not enforce it)."""
    lacking = F.lit(False)
    for name in required_columns(schema):
        lacking = lacking | F.col(name).isNull()
    return df.where(lacking)
