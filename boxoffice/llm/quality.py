"""A quality score learnt from preference pairs (Bradley-Terry).

A document is a short vector of shares: capitals, symbols, exclamation marks and digits, words
without letters or with symbols at their end, words, word pairs and lines that repeat, and lengths.
A labelled document of label 1 is preferred to one of label 0. The chance of a preference is the
logistic function of a linear score's difference, so the weights are fitted by the logistic loss on
differences of vectors of pairs; no intercept is learnt. The cut lies at the quantile of
the training scores that leaves below it as many rows as have label 0, and scores are moved so that
it is ``THRESHOLD``.

Every whole text is read once by the scoring tasks; the model is a few dozen numbers. Null and
empty texts are a vector like any other (all shares 0). Only the text is ever an input. Without
labels every score is 0.5; with labels of one kind, all scores are that label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.words import ASCII_SPACE, LOWER, distinct, hashes, mix, pieces, spans, utf8

# The model is fitted on this many labelled rows at most, chosen by a hash of their id,
# and on this many pairs a row of the larger class.
TRAIN_ROWS = 20_000
PAIRS = 8
RIDGE = 1e-3
THRESHOLD = 0.7

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_LETTER = _UPPER | (_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 128)
_BANG = _BYTE == ord("!")
_POINT = np.isin(_BYTE, [ord(c) for c in ".,;:?'\"()-"])
_SYMBOL = ~(_LETTER | _DIGIT | _POINT | _BANG | ASCII_SPACE)
_LINE = _BYTE == 10


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    shift: float  # added to the linear score, so that the cut gets THRESHOLD


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features_of(column: pa.Array) -> np.ndarray:
    """One row of numbers a text, all from 0 to 1."""
    buffer, offsets = utf8(column)
    n = len(column)
    letters, upper, digits, bangs, points, symbols = (
        _sums(kind[buffer], offsets) for kind in (_LETTER, _UPPER, _DIGIT, _BANG, _POINT, _SYMBOL)
    )
    said = letters + digits + bangs + points + symbols
    starts, ends, first = spans(buffer, offsets, ASCII_SPACE)
    words = np.diff(first)
    rows = np.repeat(np.arange(n), words)
    codes = hashes(LOWER[buffer], starts, ends)
    odd = np.concatenate([[0], np.cumsum((_SYMBOL | _BANG)[buffer])])
    plain = np.concatenate([[0], np.cumsum((_LETTER | _DIGIT)[buffer])])
    odd, plain = odd[ends] - odd[starts], plain[ends] - plain[starts]

    def count(flags: np.ndarray, of: np.ndarray = rows) -> np.ndarray:
        return np.bincount(of[flags], minlength=n)

    def repeats(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        """How many values of a text occurred earlier in it."""
        seen = distinct(mix(values ^ mix(of.astype(np.uint64))))[1]
        again = np.ones(len(values), bool)
        again[seen] = False
        return count(again, of)

    together = rows[1:] == rows[:-1]
    same = np.concatenate([[False], together & (codes[1:] == codes[:-1])]) if len(codes) else np.zeros(0, bool)
    with np.errstate(over="ignore"):
        doubles = mix(codes[:-1] + np.uint64(1))[together] ^ codes[1:][together] if len(codes) else codes
    doubled = rows[1:][together] if len(codes) else rows
    low, high, line = spans(buffer, offsets, _LINE)
    lines = np.diff(line)
    shares = [
        _share(upper, letters),
        _share(symbols, said),
        _share(bangs, said),
        _share(digits, said),
        _share(points, said),
        _share(count(plain == 0), words),
        _share(count((plain > 0) & (odd > 1)), words),
        _share(count(same), words),
        _share(repeats(doubles, doubled), np.maximum(words - 1, 0)),
        _share(repeats(hashes(buffer, low, high), np.repeat(np.arange(n), lines)), lines),
        _share(lines, words),
    ]
    shares = [np.clip(share, 0, 1) for share in shares]
    sizes = [np.minimum(_share(said, words) / 50, 1), np.minimum(np.log1p(words) / 20, 1)]
    return np.column_stack([*shares, *[np.sqrt(share) for share in shares], *sizes])


def pairs_of(good: int, bad: int, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Which good row is compared with which bad one: every row of the larger class ``pairs`` times, the others evenly."""
    larger, smaller = max(good, bad), min(good, bad)
    at = np.arange(larger * min(pairs, smaller))
    row = at % larger
    other = (row + at // larger) % smaller
    return (row, other) if good >= bad else (other, row)


def fit(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, steps: int = 30) -> Model:
    """Newton steps on the logistic loss of pair differences, with a ridge on scaled weights."""
    if not len(rows):  # no labels
        return Model(np.zeros(features_of(pa.array([""])).shape[1]), 0.0)
    good, bad = rows[labels == 1], rows[labels == 0]
    if not len(good) or not len(bad):
        return Model(np.zeros(rows.shape[1]), np.inf if len(good) else -np.inf)
    one, two = pairs_of(len(good), len(bad), pairs)
    scale = np.maximum(rows.std(axis=0), 1e-3)
    gaps = (good[one] - bad[two]) / scale
    weights = np.zeros(rows.shape[1])
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(gaps @ weights, -500, 500)))  # chance of the wrong preference
        slope = -(gaps * lost[:, None]).mean(axis=0) + ridge * weights
        bend = (gaps * (lost * (1 - lost))[:, None]).T @ gaps / len(gaps) + ridge * np.eye(len(weights))
        weights = weights - np.linalg.solve(bend, slope)
    weights = weights / scale
    ranked = np.sort(rows @ weights)
    cut = (ranked[len(bad) - 1] + ranked[len(bad)]) / 2
    return Model(weights, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut))


def score_texts(column: pa.Array, model: Model) -> np.ndarray:
    if not len(column):
        return np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(features_of(column) @ model.weights + model.shift, -700, 700)))


def is_held_out(identifier: Column) -> Column:
    """Rows that are never learnt from: the crc32 of their id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(identifier.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Fit on labelled documents outside the held-out quarter. Contradicting labels of an id count as 0.

    At most ``train_rows`` ids, and as many different rows (id and text), are learnt from; a hash chooses them.
    """
    wanted = (
        labels.where(~is_held_out(F.col(id_col)))
        .where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_rows)  # so many narrow rows at most are broadcast
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(wanted), "id").withColumn("hash", F.xxhash64("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                vectors = pa.array(list(features_of(piece.column("text"))), pa.list_(pa.float64()))
                columns = [piece.column("id"), piece.column("hash"), piece.column("label"), vectors]
                yield pa.RecordBatch.from_arrays(columns, ["id", "hash", "label", "vector"])

    kind = docs.schema[id_col].dataType.simpleString()
    vectors = found.select("id", "hash", "label", "text").mapInArrow(make, f"id {kind}, hash long, label int, vector array<double>")
    once = vectors.groupBy("id", "hash").agg(F.min("label").alias("label"), F.max("vector").alias("vector"))
    rows = once.orderBy(F.xxhash64("id", "hash"), "id", "hash").limit(train_rows).collect()  # <= train_rows short vectors
    return fit(np.array([row["vector"] for row in rows]), np.array([row["label"] for row in rows], int))


def quality_score(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of every text; one Arrow batch at a time, a few MB of text at once."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [score_texts(piece.column("text"), model) for piece in pieces(batch, "text")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text.cast("string"))


def classify(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on); columns of these names are replaced."""
    scored = docs.withColumn("score", quality_score(F.col(text_col), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
