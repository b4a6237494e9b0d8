"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.llm import bpe, chat, merkle, quality, turn_repair
from boxoffice.llm import statements as sql
from boxoffice.llm.exact_dedup import exact_dedup
from boxoffice.llm.html_text import visible_text
from boxoffice.llm.lengths import length_histogram, suffix_sums
from boxoffice.llm.mixing import mix
from boxoffice.llm.ngram_join import ngram_join
from boxoffice.llm.scratch import table
from boxoffice.llm.search import top_k
from boxoffice.llm.toxicity import classify, is_held_out, train_on
from boxoffice.llm.wavelet import read_documents, write_shards
from boxoffice.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written as wavelet shards and read back from them."""
    docs = table(spark, folder, "documents")
    shards = write_shards(docs, tokenizer("byte_bpe_50k.json"), scratch_path(spark, "wavelet-shards"))
    return read_documents(shards)


def op2_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents nearest by BM25 to every document whose id is divisible by 20."""
    docs = table(spark, folder, "documents")
    queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query"), "text")
    return top_k(docs, queries).select(F.col("query").alias("query_id"), "rank", "doc_id", "score")


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose sets of three-word shingles are 90 % alike, as components."""
    found = ngram_join(table(spark, folder, "documents"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents say the same, white space aside, and which of them stays."""
    found = exact_dedup(table(spark, folder, "documents"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and the text they decode to, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_digests(bpe.encode(docs, tokenizer("word_bpe_49k.json"), decoded=True))


def token_digests(encoded: DataFrame) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenizer(name: str) -> str:
    """Where an installed public tokenizer file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """For every encoded length: documents, and the ids a context limit there would keep."""
    docs = table(spark, folder, "documents")
    return suffix_sums(length_histogram(docs, tokenizer("byte_bpe_50k.json")))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every document, learnt outside the held-out third of the labels."""
    docs = table(spark, folder, "documents")
    scored = classify(docs, train_on(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted and read back, with one that is full of control strings."""
    turns = chat.turns_of_table(table(spark, folder, "conversations"), "conv_id")
    said = "\\### Assistant: </turn> ok"
    hard = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns = turns.unionByName(spark.createDataFrame(hard, "key long, turn long, role string, text string"))
    formatted = chat.format_turns(turns)
    rows = chat.read_turns(formatted)
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    back = rows.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("turn", line.alias("line"), "loss_text"))).alias("all"))
    loss = F.array_join(F.col("all.loss_text"), "")
    digests = back.select(
        "key",
        F.size("all").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.col("all.line"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
    )
    sizes = formatted.select("key", F.length("formatted").cast("long").alias("formatted_chars"))
    return digests.join(sizes, digests["key"].eqNullSafe(sizes["key"])).select(
        digests["key"].alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    found = mix(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The visible text of every page."""
    pages = table(spark, folder, "pages").select("page_id", visible_text(F.col("html")).alias("text"))
    return pages.select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document, learnt from pairs outside the held-out quarter of the labels."""
    docs = table(spark, folder, "documents")
    scored = quality.classify(docs, quality.train_on(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged at random, with its faults and its cheapest repair."""
    rows = turn_repair.damaged(table(spark, folder, "conversations"))
    return turn_repair.digests(turn_repair.repair(rows))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof of membership, tested with every fifth text tampered with."""
    docs = table(spark, folder, "documents")
    before = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select(
        "doc_id",
        "source",
        merkle.leaf_hash([*before, F.col("text")]).alias("leaf"),
        F.when(tampered, merkle.leaf_hash([*before, lowered])).alias("claim"),
    )
    proofs = merkle.prove(merkle.build(rows, "source", "doc_id", "leaf", "claim"))
    return proofs.withColumnRenamed("key", "doc_id")


def registered() -> dict[str, Query]:
    return {
        "op1_wavelet": op1_wavelet,
        "op2_search": op2_search,
        "op3_ngram_join": op3_ngram_join,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_bpe": op5_bpe,
        "op6_lengths": op6_lengths,
        "op7_toxicity": op7_toxicity,
        "op8_chat": op8_chat,
        "op9_mixing": op9_mixing,
        "op10_html_text": op10_html_text,
        "op11_quality": op11_quality,
        "op12_turn_repair": op12_turn_repair,
        "op13_merkle": op13_merkle,
    }


def statements() -> dict[str, str]:
    """The same rows as SQL, where SQL can express the operator."""
    return {
        "op4_exact_dedup": EXACT_DEDUP,
        "op8_chat": CHAT,
        "op9_mixing": MIXING,
        "op12_turn_repair": sql.turn_repair(),
        "op13_merkle": sql.merkle(),
    }


EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS said
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY said) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(said) AS text_sha256
FROM d
WINDOW best AS (PARTITION BY said ORDER BY points DESC, doc_id)
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), c AS (
  SELECT *, CASE WHEN lower(role) IN ('human', 'prompter') THEN 'user'
                 WHEN lower(role) IN ('gpt', 'bot', 'model') THEN 'assistant' ELSE role END AS name
  FROM t
), s AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(name || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, name, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, name, text) FILTER (name = 'assistant'), '') AS learnt,
         sum(4 + length(regexp_replace(name, '([\\#<\n])', '..', 'g')) + 1
             + length(regexp_replace(text, '([\\#<])', '..', 'g')) + 9)::BIGINT AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars,
       sha256(learnt) AS loss_sha256, formatted_chars
FROM s
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(md5('17:' || doc_id::VARCHAR), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496 AS u
  FROM documents
), k AS (
  SELECT *, -ln(u) / (0.5 + least(size, 100) / 200::DOUBLE) AS sample_key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS full_at FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size) OVER earlier, 0) * 3.0::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level,
         row_number() OVER (ORDER BY full_at, source NULLS LAST) AS place
  FROM f
  WINDOW earlier AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), o AS (
  SELECT arg_min(level, place) AS open_level FROM l WHERE full_at >= level
), t AS (
  SELECT source, source_size, least(source_size * 3.0::DOUBLE, coalesce(open_level, 'inf'::DOUBLE) * weight) AS target
  FROM f LEFT JOIN o ON true
), p AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.sample_key, k.doc_id, k.size
                           ROWS UNBOUNDED PRECEDING) - k.size / 2::DOUBLE AS middle
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (least(epochs + CASE WHEN middle < target - epochs * source_size THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM p
"""
