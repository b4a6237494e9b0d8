"""BPE encoding and decoding through a transducer of the corpus's frequent words.

1. Frequent words are counted over all texts: each few MB of text report the words they hold
   ``LEAST`` times or more, and the reports are added up.
2. The most frequent ``LEXICON`` words are encoded once by the tokenizers library and compiled
   into a minimal automaton with their ids as outputs. The file has a few MB whatever the corpus.
3. Every whole text is cut at ASCII white space, where the tokenizer's own rules never look
   across. Words in the automaton get its ids; unseen words are merged by the library, once for
   each worker while it remembers them. Both ways give the ids of the whole text exactly.

White space is dropped by the tokenizer, so ``decode`` gives its tokens with spaces between.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.lexicon import Lexicon, compile_lexicon
from boxoffice.llm.tokens import Encoder, cut_words, encoder_for, library_encode, per_text
from boxoffice.llm.words import distinct, hashes, pieces, utf8

LEXICON = 1 << 16
LEAST = 4
PIECE = 4 << 20
SEPARATOR = "<|endoftext|>"


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON, least: int = LEAST) -> list[bytes]:
    """The ``most`` most frequent words at most, ties by bytes; reports of fewer than ``least`` in 4 MB are left out."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                buffer, offsets = utf8(piece.column("text"))
                starts, ends, _ = cut_words(buffer, offsets)
                _, first, went = distinct(hashes(buffer, starts, ends))
                counts = np.bincount(went, minlength=len(first))
                often = counts >= least
                raw = buffer.tobytes()
                words = [raw[a:b] for a, b in zip(starts[first[often]].tolist(), ends[first[often]].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(counts[often].astype(np.int64))], ["word", "n"]
                )

    reports = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(report, "word binary, n long")
    totals = reports.where(F.length("word") <= 64).groupBy(F.hex("word").alias("word")).agg(F.sum("n").alias("n"))
    return [bytes.fromhex(row[0]) for row in totals.orderBy(F.desc("n"), "word").limit(most).collect()]


def build_lexicon(words: list[bytes], path: str, separator: str = SEPARATOR) -> bytes:
    """The automaton's file for these words, with ids from the tokenizer file at ``path``."""
    if not words:
        return compile_lexicon({})
    ids, counts = library_encode(path, separator, lower=True)(words)
    return compile_lexicon(dict(zip(words, np.split(ids, np.cumsum(counts)[:-1]))))


def mapped(raw: bytes) -> Lexicon:
    """The file, memory-mapped by this worker; its name goes at once, its space when the worker lets go of it."""
    with tempfile.NamedTemporaryFile(prefix="lexicon-") as file:
        file.write(raw)
        file.flush()
        return Lexicon.open(file.name)


def tokens_of(path: str) -> np.ndarray:
    """The token string of every id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    table = np.full(max(tokenizer.get_vocab().values()) + 1, "", object)
    for token, at in tokenizer.get_vocab().items():
        table[at] = token
    return table


def encode(docs: DataFrame, path: str, text_col: str = "text", decoded: bool = False, lexicon: int = LEXICON) -> DataFrame:
    """``docs`` without its text, with ``ids`` (array<int>) and, if asked, ``decoded`` (string).

    ``path`` is a tokenizer file whose words have an end mark and whose white space is dropped.
    Null counts as empty: no ids, and an empty string. Columns of those names are replaced.
    """
    raw = build_lexicon(frequent_words(docs, text_col, lexicon), path)
    shared = docs.sparkSession.sparkContext.broadcast(raw)  # LEXICON words of 64 bytes at most
    rest = [name for name in docs.columns if name not in (text_col, "ids", "decoded")]
    types = {field.name: field.dataType.simpleString() for field in docs.schema}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("word", path, hashlib.sha256(shared.value).hexdigest())
        encoder = encoder_for(key, lambda: Encoder(library_encode(path, SEPARATOR, lower=True), mapped(shared.value)))
        strings = tokens_of(path) if decoded else None
        for batch in batches:
            for piece in pieces(batch, "__text", 1 << 20):
                ids, counts, first = encoded(encoder, piece.column("__text"))
                ends = np.concatenate([[0], np.cumsum(per_text(counts, first))])
                columns = [piece.column(name) for name in rest]
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
                if decoded:
                    columns.append(pa.array(decode(ids, ends, strings), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*rest, "ids", *["decoded"] * decoded])

    schema = ", ".join([*[f"`{name}` {types[name]}" for name in rest], "ids array<int>", *["decoded string"] * decoded])
    return docs.select(*rest, F.col(text_col).cast("string").alias("__text")).mapInArrow(make, schema)


def encoded(encoder: Encoder, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buffer, offsets = utf8(column)
    starts, ends, first = cut_words(buffer, offsets)
    ids, counts = encoder(buffer, starts, ends)
    return ids, counts, first


def decode(ids: np.ndarray, ends: np.ndarray, strings: np.ndarray) -> list[str]:
    """The text of each run of ids, as the library decodes without a decoder: tokens with a space between."""
    tokens = strings[ids].tolist()
    return [" ".join(tokens[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
