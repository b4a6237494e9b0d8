"""Exact token counts: a histogram of encoded lengths whose suffix sums answer for every context limit.

Each whole text is encoded (null: empty) and only its length is kept. The histogram has a row for
every length that occurs. Suffix sums are taken within blocks of lengths and over the blocks, so
no task holds more than a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.llm.scratch import stored
from boxoffice.llm.tokens import byte_level_encoder, cut_spaced, per_text
from boxoffice.llm.words import pieces, utf8

BLOCK = 1024


def token_count(text: Column, tokenizer: str) -> Column:
    """Number of ids of every text."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        encoder = byte_level_encoder(tokenizer)
        found = [np.zeros(0, np.int64)]
        for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), "text", 1 << 20):
            buffer, offsets = utf8(piece.column("text"))
            starts, ends, first = cut_spaced(buffer, offsets)
            found.append(per_text(encoder.counts(buffer, starts, ends), first))
        return pa.array(np.concatenate(found), pa.int64())

    return counted(text.cast("string"))


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs) for every length; an empty table has none."""
    lengths = docs.select(token_count(F.col(text_col), tokenizer).alias("n_tokens"))
    return stored(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-histogram")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what lies at or above each length, and the ids left when texts are cut there.

    ``docs_at_least``, ``tokens_at_least``: texts of this length or more, and their ids.
    ``tokens_within``: ids of all texts when each is cut to ``n_tokens``.
    """
    sized = histogram.select(
        "n_tokens",
        "n_docs",
        (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / BLOCK).alias("block"),
    )
    blocks = sized.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("tokens_above"),
        F.sum("block_tokens").over(every).alias("total"),
    )
    upto = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    docs = F.sum("n_docs").over(upto) + F.col("docs_above")
    tokens = F.sum("tokens").over(upto) + F.col("tokens_above")
    placed = sized.join(blocks, "block").withColumn("docs_at_least", docs).withColumn("tokens_at_least", tokens)
    within = F.col("total") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return placed.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", within.alias("tokens_within"))


def total_within(sums: DataFrame, limit: int) -> DataFrame:
    """One row, ``tokens``: ids of all texts when each is cut to ``limit``; 0 for an empty table."""
    # From the shortest length at or above the limit; without one, nothing is cut.
    above = F.min(F.when(F.col("n_tokens") >= limit, F.struct("n_tokens", "docs_at_least", "tokens_at_least")))
    total = F.max("tokens_at_least")
    found = sums.agg(above.alias("above"), total.alias("total"))
    cut = F.col("total") - F.col("above.tokens_at_least") + limit * F.col("above.docs_at_least")
    return found.select(F.coalesce(cut, F.col("total"), F.lit(0)).alias("tokens"))


def length_quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row, ``n_tokens``: the least length that at least ``share`` of the texts do not exceed; null if there is none."""
    docs = F.max("docs_at_least").alias("docs")
    reach = sums.join(F.broadcast(sums.agg(docs)))  # one row
    enough = F.col("docs") - F.col("docs_at_least") + F.col("n_docs") >= F.ceil(F.col("docs") * F.lit(float(share)))
    return reach.agg(F.min(F.when(enough, F.col("n_tokens"))).alias("n_tokens"))
