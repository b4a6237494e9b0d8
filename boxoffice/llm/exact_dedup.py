"""Exact dedup by progressive refinement: length, then a hash of the head, then the full hash.

Two texts are equal when they are identical after all ASCII white space is deleted; null counts
as empty. Rows whose length, or length and head, nobody shares are unique and are never hashed
in full. Of equal texts the one with the most code points stays, then the smallest id (null
last), then, among repeated rows, one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.scratch import small, stored

SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
# Code points of the normalised text that the middle step hashes.
HEAD = 64

_ID, _POINTS, _LENGTH, _HEAD, _SHA, _ROW, _HIT = (
    f"dedup__{name}" for name in ("id", "points", "length", "head", "sha", "row", "hit")
)


def normalised(text: Column) -> Column:
    out = F.coalesce(text.cast("string"), F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``text_sha256`` is the digest of the normalised text; without ``digest_all`` it is null for
    rows that the first two steps proved unique. Clashing column names of ``docs`` are replaced.
    An empty table gives an empty result.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    docs = docs.drop(*[name for name in added if name not in (id_col, text_col)])
    text = normalised(F.col(text_col))
    marked = docs.withColumns(
        {
            _ID: F.col(id_col),
            _POINTS: F.length(F.coalesce(F.col(text_col), F.lit(""))),
            _LENGTH: F.length(text),
            _HEAD: F.xxhash64(F.substring(text, 1, HEAD)),
        }
    )
    if digest_all:
        marked = marked.withColumn(_SHA, F.sha2(text, 256))
    keys = small(_shared_heads(marked))
    marked = marked.join(keys.withColumn(_HIT, F.lit(True)), [_LENGTH, _HEAD], "left")
    alone = marked.where(F.col(_HIT).isNull()).withColumns(
        {
            "keep_id": F.col(_ID),
            "group_size": F.lit(1).cast("long"),
            "kept": F.lit(True),
            "text_sha256": F.col(_SHA) if digest_all else F.lit(None).cast("string"),
        }
    )
    rest = marked.where(F.col(_HIT))
    if not digest_all:
        rest = rest.withColumn(_SHA, F.sha2(text, 256))
    # Row numbers hold once the rows are written; they only tell repeated rows apart.
    rest = stored(rest.withColumn(_ROW, F.monotonically_increasing_id()), "exact-dedup-rows")
    winner = F.min(F.struct(-F.col(_POINTS), F.col(_ID).isNull(), F.col(_ID), F.col(_ROW))).alias("winner")
    groups = stored(rest.groupBy(_LENGTH, _SHA).agg(F.count("*").alias("group_size"), winner), "exact-dedup-groups")
    same = rest.join(groups, [_LENGTH, _SHA]).withColumns(
        {
            "keep_id": F.col(f"winner.{_ID}"),
            "kept": F.col(f"winner.{_ROW}") == F.col(_ROW),
            "text_sha256": F.col(_SHA),
        }
    )
    names = [*docs.columns, *[name for name in added if name not in docs.columns]]
    return alone.select(*names).unionByName(same.select(*names))


def _shared_heads(marked: DataFrame) -> DataFrame:
    """The (length, head hash) that at least two rows have; lengths nobody shares go first."""
    facts = stored(marked.select(_LENGTH, _HEAD), "exact-dedup-facts")
    lengths = facts.groupBy(_LENGTH).agg(F.count("*").alias("n")).where("n > 1").select(_LENGTH)
    heads = facts.join(lengths, _LENGTH, "left_semi").groupBy(_LENGTH, _HEAD).agg(F.count("*").alias("n"))
    return stored(heads.where("n > 1").select(_LENGTH, _HEAD), "exact-dedup-heads")
