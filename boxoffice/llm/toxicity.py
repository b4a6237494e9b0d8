"""A linear toxicity classifier with counterfactual regularisation.

Features are words (runs of letters, digits and non-ASCII bytes, lower-cased in A-Z) and their
first four to six bytes, as hashes. A bounded sample of labelled rows chooses those that are
associated with the label, and a logistic regression is fitted on them. Sentences that name an
identity group are rewritten with every other group of the same kind, and the squared change of
a row's logit is added to the loss, so a neutral mention of a group can hardly move the score.

Scoring reads every whole text once, in the JVM's tasks, with a model of at most ``FEATURES``
weights. Null and empty texts get the score of the intercept. Only the text is ever an input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.scratch import stored
from boxoffice.llm.words import LOWER, PIECE, distinct, hashes, mix, pieces, spans, utf8

# The model is fitted on this many labelled rows at most, chosen by a hash of their id.
TRAIN_ROWS = 20_000
FEATURES = 4096
# A feature is kept when it is in so many rows and its chi-square statistic is so large.
LEAST_ROWS = 4
LEAST_CHI2 = 25.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7

# Groups whose members take each other's place in counterfactual sentences.
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("men", "women"),
    ("man", "woman"),
    ("male", "female"),
    ("boys", "girls"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees"),
    ("disabled", "blind", "deaf", "old", "young"),
)

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[48:58] = _NOT_WORD[65:91] = _NOT_WORD[97:123] = _NOT_WORD[128:] = False


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # ascending hashes
    weights: np.ndarray
    intercept: float


def features_of(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers and feature hashes of all texts, kind by kind; a feature may repeat within a row."""
    buffer, offsets = utf8(column)
    starts, ends, first = spans(buffer, offsets, _NOT_WORD)
    rows = np.repeat(np.arange(len(column)), np.diff(first))
    lower = LOWER[buffer]
    yield rows, hashes(lower, starts, ends)
    for length in PREFIXES:
        long = ends - starts > length
        yield rows[long], mix(hashes(lower, starts[long], starts[long] + length) ^ np.uint64(length))


def _hits(column: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature number) of the model's features."""
    there = np.zeros(1 << 20, bool)
    there[(features >> np.uint64(44)).astype(np.int64)] = True
    found = [np.zeros(0, np.int64)]
    for rows, codes in features_of(column):
        maybe = there[(codes >> np.uint64(44)).astype(np.int64)]
        rows, codes = rows[maybe], codes[maybe]
        at = np.minimum(np.searchsorted(features, codes), max(len(features) - 1, 0))
        if len(features):
            same = features[at] == codes
            found.append(rows[same] * len(features) + at[same])
    both = np.unique(np.concatenate(found))
    return both // max(len(features), 1), both % max(len(features), 1)


def score_texts(column: pa.Array, model: Model) -> np.ndarray:
    rows, at = _hits(column, model.features)
    logits = model.intercept + np.bincount(rows, model.weights[at] if len(at) else None, minlength=len(column))
    return 1 / (1 + np.exp(-np.clip(logits, -700, 700)))


def counterfactuals(text: str, identities: Sequence[Sequence[str]] = IDENTITIES) -> list[str]:
    """The text with the identity terms of its sentences exchanged: one variant for each other member of a group."""
    places = {term: (group, at) for group in identities for at, term in enumerate(group)}
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, places)) + r")\b", re.IGNORECASE)
    sentences = re.split(r"(?<=[.!?\n])", text)
    if not any(pattern.search(s) for s in sentences):
        return []

    def exchanged(step: int) -> str:
        def other(found: re.Match) -> str:
            group, at = places[found[0].lower()]
            return group[(at + step) % len(group)]

        return "".join(pattern.sub(other, s) for s in sentences)

    variants = [exchanged(step) for step in range(1, max(len(group) for group in identities))]
    return [v for v in dict.fromkeys(variants) if v.lower() != text.lower()]


def _statistics(sample: DataFrame) -> np.ndarray:
    """The features most associated with the label, by chi-square over the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                toxic = piece.column("toxic").to_numpy(zero_copy_only=False) == 1
                for rows, codes in features_of(piece.column("text")):
                    # One count for each row that has the feature.
                    once = distinct(mix(codes ^ mix(rows.astype(np.uint64))))[1]
                    rows, codes = rows[once], codes[once]
                    found, _, went = distinct(codes)
                    ones = np.bincount(went, toxic[rows], minlength=len(found)).astype(np.int64)
                    both = np.bincount(went, minlength=len(found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array(ones), pa.array(both)], ["feature", "ones", "both"]
                    )

    counts = sample.mapInArrow(count, "feature long, ones long, both long").groupBy("feature")
    totals = sample.agg(F.count("*").alias("rows"), F.sum("toxic").alias("toxic"))
    rows, toxic = F.col("rows").cast("double"), F.col("toxic").cast("double")
    # ones, both - ones, toxic - ones, rest of the rows: the four cells of the table
    off = F.col("ones") * (rows - toxic - F.col("both") + F.col("ones")) - (F.col("both") - F.col("ones")) * (
        toxic - F.col("ones")
    )
    chi2 = rows * off * off / (F.col("both") * (rows - F.col("both")) * toxic * (rows - toxic))
    chosen = (
        counts.agg(F.sum("ones").alias("ones"), F.sum("both").alias("both"))
        .where(F.col("both") >= LEAST_ROWS)
        .join(F.broadcast(totals))  # one row
        .where((rows > F.col("both")) & (toxic > 0) & (toxic < rows))
        .withColumn("chi2", chi2)
        .where(F.col("chi2") >= LEAST_CHI2)
        .orderBy(F.desc("chi2"), "feature")
        .limit(FEATURES)
    )
    return np.sort(np.array([r[0] for r in chosen.select("feature").collect()], np.int64).view(np.uint64))


def _examples(sample: DataFrame, features: np.ndarray, identities: Sequence[Sequence[str]]) -> list:
    """(toxic, its features, features of each counterfactual) of every sampled row; a few numbers a row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                own = _lists(piece.column("text"), features)
                swapped = []
                for text in piece.column("text").to_pylist():
                    variants = counterfactuals(text or "", identities)
                    swapped.append(_lists(pa.array(variants, pa.string()), features) if variants else [])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("toxic"), pa.array(own, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.list_(pa.int32())))],
                    ["toxic", "own", "swapped"],
                )

    return sample.mapInArrow(make, "toxic int, own array<int>, swapped array<array<int>>").collect()  # <= TRAIN_ROWS


def _lists(column: pa.Array, features: np.ndarray) -> list[np.ndarray]:
    rows, at = _hits(column, features)
    return np.split(at, np.searchsorted(rows, np.arange(1, len(column)))) if len(column) else []


def fit(
    examples: Sequence[tuple[int, Sequence[int], Sequence[Sequence[int]]]],
    features: np.ndarray,
    penalty: float = 1.0,
    ridge: float = 1e-5,
    steps: int = 800,
) -> Model:
    """Logistic regression by accelerated gradient steps; ``penalty`` weighs squared logit changes of counterfactuals."""
    if not examples:
        return Model(features, np.zeros(len(features)), 0.0)
    y = np.array([e[0] for e in examples], float)
    rows = np.repeat(np.arange(len(y)), [len(e[1]) for e in examples])
    at = np.concatenate([np.asarray(e[1], np.int64) for e in examples]).astype(np.int64)
    changes = [(e[1], variant) for e in examples for variant in e[2]]
    # A row of differences for each pair: +1 for features it has lost, -1 for those it has got.
    pair = np.concatenate([np.full(len(a) + len(b), i) for i, (a, b) in enumerate(changes)] or [np.zeros(0)]).astype(int)
    moved = np.concatenate([[*a, *b] for a, b in changes] or [np.zeros(0)]).astype(int)
    sign = np.concatenate([[1.0] * len(a) + [-1.0] * len(b) for a, b in changes] or [np.zeros(0)])
    size, k = len(y), len(features)
    weights = look = np.zeros(k + 1)  # the last is the intercept
    # Steps by feature: the curvature along each is at most the summed lengths of the rows that have it.
    length = np.bincount(rows, minlength=size) + 1.0
    bend = np.concatenate([np.bincount(at, length[rows], minlength=k)[:k], [length.sum()]]) * 0.25 / size + ridge
    if len(changes):
        spread = np.bincount(pair, minlength=len(changes)).astype(float)
        bend[:k] += np.bincount(moved, spread[pair], minlength=k)[:k] * (2 * penalty / len(changes))
    for step in range(steps):
        logits = look[k] + np.bincount(rows, look[at], minlength=size)
        error = (1 / (1 + np.exp(-np.clip(logits, -700, 700))) - y) / size
        slope = np.concatenate([np.bincount(at, error[rows], minlength=k)[:k] + ridge * look[:k], [error.sum()]])
        if len(changes):
            shift = np.bincount(pair, sign * look[moved], minlength=len(changes)) * (2 * penalty / len(changes))
            slope[:k] += np.bincount(moved, sign * shift[pair], minlength=k)[:k]
        following = look - slope / bend
        look = following + step / (step + 3) * (following - weights)
        weights = following
    return Model(features, weights[:k], float(weights[k]))


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int | None = TRAIN_ROWS,
    identities: Sequence[Sequence[str]] = IDENTITIES,
    penalty: float = 1.0,
) -> Model:
    """Fit on at most ``train_rows`` rows of ``labelled`` with a label of 0 or 1, chosen by a hash of the id.

    None stands for all of them, where the caller has bounded their number.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("toxic")
    ).where("toxic in (0, 1)")
    if train_rows is not None:
        rows = rows.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    sample = stored(rows, "toxicity-sample")
    if train_rows is not None:  # one file after a limit; spread it over the cores again
        sample = sample.repartition(2 * sample.sparkSession.sparkContext.defaultParallelism)
    features = _statistics(sample)
    return fit([tuple(r) for r in _examples(sample, features, identities)], features, penalty)


def train_on(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, **options
) -> Model:
    """Fit on labelled documents outside the held-out third. Contradicting labels of an id count as 1.

    At most ``train_rows`` ids and as many rows are learnt from. Where ids repeat beyond that,
    rows of one id and text count once, and a hash of both chooses among them.
    """
    chosen = (
        labels.where(~is_held_out(F.col(id_col)))
        .where("toxic in (0, 1)")
        .groupBy(id_col)
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(train_rows)  # so many narrow rows at most may be broadcast
    )
    found = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)
    return train(_bounded(found, id_col, text_col, train_rows), id_col, text_col, "toxic", None, **options)


def _bounded(rows: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """All rows if they are at most so many, else so many different ones by a hash of id and text."""
    if rows.count() <= most:
        return rows
    marked = rows.withColumn("toxicity__hash", F.xxhash64(text_col))
    key = [id_col, "toxicity__hash"]
    chosen = marked.select(*key).distinct().orderBy(F.xxhash64(*key), *key).limit(most)
    return marked.join(F.broadcast(chosen), key).dropDuplicates(key).drop("toxicity__hash")


def is_held_out(identifier: Column) -> Column:
    """Rows that are never learnt from: the crc32 of their id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(identifier.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity_score(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of every text; one Arrow batch at a time, a few MB of text at once."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [score_texts(piece.column("text"), model) for piece in pieces(batch, "text", PIECE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text.cast("string"))


def classify(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on); columns of these names are replaced."""
    scored = docs.withColumn("score", toxicity_score(F.col(text_col), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
