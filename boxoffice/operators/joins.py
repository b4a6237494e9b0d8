"""Joins of many rows with a table that is unique on the join key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# A table is broadcast only after its bytes were added up and found within this bound.
BROADCAST_BYTES = 64 << 20
# Beyond it, the frequent keys of the other side are found by a sketch of so many counters ...
HOT_KEYS = 256
COUNTERS = 16 * HOT_KEYS
# ... and each is spread so that a sub-key holds about this part of a shuffle partition's even share.
PART_OF_SHARE = 0.5

_SALT, _TABLE_SALT = "__salt", "__table_salt"
_HOT, _SPREAD = "__hot", "__spread"
_KEY = "__key"


@dataclass(frozen=True)
class Dimension:
    """A table that holds each key once, and whether it was found small enough to broadcast."""

    df: DataFrame
    small: bool

    def select(self, *columns: str) -> Dimension:
        return Dimension(self.df.select(*columns), self.small)


def dimension(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Dimension:
    """Measures the table: its rows at the width of their types, and its texts at their lengths."""
    return Dimension(df, bytes_of(df) <= broadcast_bytes)


def bytes_of(df: DataFrame) -> int:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType | BinaryType)]
    # 8 bytes hold any other simple value and the header of a text; a row has a header of 16.
    fixed = F.count(F.lit(1)) * (16 + 8 * len(df.columns))
    lengths = [F.coalesce(F.sum(F.octet_length(name)), F.lit(0)) for name in texts]
    return df.agg(reduce(add, [fixed, *lengths]).alias("bytes")).first()["bytes"]


def lookup(facts: DataFrame, table: Dimension, key: str, how: str, table_key: str | None = None) -> DataFrame:
    """``facts`` joined to the ``table`` row of their key; ``how`` is inner, left, left_semi or left_anti.

    A small table is broadcast and the facts stay where they are. Otherwise both sides shuffle by
    key and salt. The table's key is kept under ``table_key`` if that is
    given. For rows already aggregated by the key see ``attach``.
    """
    right = table.df.withColumnRenamed(table_key or key, _KEY)
    if table.small:
        joined = facts.join(F.broadcast(right), F.col(key) == F.col(_KEY), how)
    else:
        joined = _salted_lookup(facts, right, key, how)
    if _KEY not in joined.columns:
        return joined
    return joined.withColumnRenamed(_KEY, table_key) if table_key else joined.drop(_KEY)


def attach(rows: DataFrame, table: Dimension, key: str, how: str) -> DataFrame:
    """Columns of a table joined to rows that are an aggregate by its key and more.

    Finding hot keys would compute the aggregate twice, so beyond the broadcast bound this is
    a plain join. What follows shuffles by other keys, so adaptive execution may split it.
    """
    return rows.join(F.broadcast(table.df) if table.small else table.df, key, how)


def frequent_keys(facts: DataFrame, key: str, partitions: int) -> DataFrame:
    """(key, sub-keys) of keys that hold more than ``PART_OF_SHARE`` of a partition's even share of the rows.

    One pass over the key column fills a sketch of fixed size in each task, and the sketches are merged:
    nothing is shuffled by key. Counts may be too high, never so low that a key with a share of
    more than 1 / ``COUNTERS`` is missed; the result has at most ``HOT_KEYS`` rows.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {COUNTERS})")
    found = facts.where(F.col(key).isNotNull()).agg(sketch.alias("top"), F.count(F.lit(1)).alias("rows"))
    keys = found.select("rows", F.explode("top").alias("top")).select("rows", "top.item", "top.count")
    share = F.greatest(F.col("rows") * F.lit(PART_OF_SHARE / partitions), F.lit(1.0))
    spread = F.least(F.ceil(F.col("count") / share), F.lit(2 * partitions)).cast("int")
    return keys.select(F.col("item").alias(_HOT), spread.alias(_SPREAD)).where(F.col(_SPREAD) > 1)


def _salted_lookup(facts: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Exact for any distribution of keys.

    Only frequent keys are salted, each by as many sub-keys as its estimated rows need, so ``right``
    grows by a few rows a partition. The salt is a hash of the row, not a random number: a
    task that runs again after a lost executor sends its rows to the same place.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = F.broadcast(frequent_keys(facts, key, partitions))
    row_hash = F.xxhash64(*facts.columns)
    spread = facts.join(frequent, F.col(key) == F.col(_HOT), "left")
    # NULL keys match nothing, but would all land in one task.
    pieces = F.when(F.col(key).isNull(), F.lit(partitions)).otherwise(F.coalesce(_SPREAD, F.lit(1)))
    spread = spread.withColumn(_SALT, F.pmod(row_hash, pieces.cast("bigint"))).drop(_HOT, _SPREAD)

    copies = right.join(frequent, F.col(_KEY) == F.col(_HOT), "left")
    salts = F.sequence(F.lit(0), F.coalesce(_SPREAD, F.lit(1)) - 1).cast("array<bigint>")
    copies = copies.withColumn(_TABLE_SALT, F.explode(salts)).drop(_HOT, _SPREAD)

    condition = (F.col(key) == F.col(_KEY)) & (F.col(_SALT) == F.col(_TABLE_SALT))
    # Both sides go by key and salt, whatever Spark thinks of their sizes: it knows nothing of the hot keys.
    joined = spread.hint("shuffle_merge").join(copies.hint("shuffle_merge"), condition, how)
    return joined.drop(_SALT, _TABLE_SALT)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is given but not found in the parent."""
    keys = parent.select(F.col(parent_key).alias(foreign_key)).where(F.col(foreign_key).isNotNull()).distinct()
    return lookup(child.where(F.col(foreign_key).isNotNull()), dimension(keys), foreign_key, "left_anti")


def orphan_counts(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Missing parent keys with the number of child rows; hot keys are counted before the join."""
    used = child.where(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("child_rows"))
    keys = parent.select(F.col(parent_key).alias(foreign_key)).where(F.col(foreign_key).isNotNull())
    return used.join(keys, foreign_key, "left_anti")
