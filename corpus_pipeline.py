"""A training corpus from raw documents, stage by stage; each stage reads what the one before has written.

Toxic documents go, then copies, then near copies; sources are mixed to their target weights, and
what is left is encoded. Stages know rows by id and text, so ids may repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.llm import bpe
from boxoffice.llm.exact_dedup import exact_dedup
from boxoffice.llm.mixing import mix
from boxoffice.llm.ngram_join import ngram_join
from boxoffice.llm.queries import tokenizer
from boxoffice.llm.scratch import small, stored, table
from boxoffice.llm.toxicity import classify, train_on

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_ROW = "pipeline__row"


def _row() -> Column:
    """Orders by id, and tells rows of one id apart; equal rows are one."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not call toxic."""
    model = train_on(docs, table(spark, folder, "labels"))
    return classify(docs, model).where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts that are equal, white space aside, one row stays."""
    return exact_dedup(docs).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents tied by links of 80 % of their five-word shingles, the one with the smallest id stays."""
    found = ngram_join(docs.select(_row().alias(_ROW), "text"), id_col=_ROW, width=5, percent=80)
    gone = small(stored(found.where(F.col(_ROW) != F.col("component_id")).select(_ROW), "near-copies"))
    return docs.withColumn(_ROW, _row()).join(gone, _ROW, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    taken = mix(docs.select(_row().alias(_ROW), "text", "source"), id_col=_ROW).where("times > 0")
    times = small(stored(taken.groupBy(_ROW).agg(F.max("times").cast("int").alias("times")), "mix-times"))
    mixed = docs.withColumn(_ROW, _row()).join(times, _ROW)
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer("word_bpe_49k.json"))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("BPE encoding", encode),
]

# A trained classifier and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, folder, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{number + 1}")
    return docs
