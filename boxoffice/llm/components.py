"""Connected components of a link table by repeated local contraction.

A link hangs its larger node on the smaller. In each round a link goes to a task by its lower
node, spread over ``SALTS`` tasks by its upper one (over one for every ``TASK_LINKS`` links of a
node that has many), and to the tasks of its upper node; each task
joins what it has and hangs every node on the smallest it can reach. So a node learns where its
parent hangs, two parents of a node learn of each other, and the ties get shorter until none
changes. So no task holds a fixed share of one component; links never reach the driver, only their count
and a checksum. Each round's result is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.scratch import small, stored

SALTS = 4
# About so many links of one node go to one task, some MB there.
TASK_LINKS = 20_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component."""
    ties = stored(_oriented(links.select("a", "b")), "ties")
    kind = ties.schema["a"].dataType.simpleString()
    before, now = None, _state(ties)
    while before != now and now[0]:
        hot = _hot(ties) if now[0] > SALTS * TASK_LINKS else None
        salt = F.pmod(F.xxhash64("a"), F.col("salts"))
        below = _salted(ties, hot, "b").select(F.col("b").alias("key"), salt.alias("salt"), "a", "b")
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
        own = _salted(ties, hot, "a").select(F.col("a").alias("key"), each.alias("salt"), "a", "b")
        met = below.union(own).repartition("key", "salt").select("a", "b")
        ties = stored(_oriented(met.mapInArrow(_contract, f"a {kind}, b {kind}")), "ties")
        before, now = now, _state(ties)
    return ties.select(F.col("a").alias("node"), F.col("b").alias("root")).union(ties.select("b", "b").distinct())


def _hot(ties: DataFrame) -> DataFrame:
    """(hot, salts) of the nodes that are the lower end of too many ties for ``SALTS`` tasks."""
    counted = ties.groupBy(F.col("b").alias("hot")).agg(F.count("*").alias("links")).where(F.col("links") > SALTS * TASK_LINKS)
    return small(stored(counted.select("hot", F.ceil(F.col("links") / TASK_LINKS).cast("long").alias("salts")), "ties-hot"))


def _salted(ties: DataFrame, hot: DataFrame | None, end: str) -> DataFrame:
    """``ties`` with the number of tasks over which the links of the node at this end are spread."""
    usual: Column = F.lit(SALTS).cast("long")
    if hot is None:
        return ties.withColumn("salts", usual)
    return ties.join(hot, ties[end] == hot["hot"], "left").select("a", "b", F.coalesce("salts", usual).alias("salts"))


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hangs every node of the links of a task on the smallest node that these links tie it to."""
    above: dict = {}

    def root(node):
        while (up := above.get(node, node)) != node:
            above[node] = node = above.get(up, up)
        return node

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((root(a), root(b)))
            if low != high:
                above[high] = low
    if above:
        nodes = list(above)
        columns = [pa.array(column, field.type) for column, field in zip((nodes, [root(n) for n in nodes]), schema)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
