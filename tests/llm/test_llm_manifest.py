"""The Merkle manifest against a plain tree, and the pairwise quality classifier."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxoffice.llm import merkle, quality
from boxoffice.llm.queries import op11_quality, op13_merkle
from conftest import SF

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text=None):
    fields = [*row[:4], row[4] if text is None else text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(nodes):
    """Levels from the leaves up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h("".join(row[i : i + 16])) for i in range(0, len(row), 16)])
    return levels


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    climbed = {}
    for source in order:
        members = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        climbed[source] = (members, climb([leaf(r) for r in members]))
    upper = climb([climbed[source][1][-1][0] for source in order])
    found = []
    for place, source in enumerate(order):
        members, levels = climbed[source]
        for at, row in enumerate(members):
            claim = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                claim = leaf(row, lowered(row[4]))
            proof, now = "", claim
            for steps, index in ((levels, at), (upper, place)):
                for level in steps[:-1]:
                    low = index // 16 * 16
                    run = level[low : low + 16]
                    beside = run[: index - low], run[index - low + 1 :]
                    proof += "".join(beside[0] + beside[1])
                    now = h("".join([*beside[0], now, *beside[1]]))
                    index //= 16
            root = upper[-1][0]
            found.append((row[0], leaf(row), levels[-1][0], root, h(proof), now, now == root))
    return sorted(found, key=str)


def proofs(docs, **options):
    before = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.withColumn("leaf", merkle.leaf_hash([*before, F.col("text")]))
    rows = rows.withColumn("claim", F.when(hit, merkle.leaf_hash([*before, low])))
    return merkle.prove(merkle.build(rows, "source", "doc_id", "leaf", "claim", **options))


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_a_layout(levels):
    most = 16 ** (levels - 1)
    for leaves in sorted({1, 2, most, max(1, most - 1), max(1, most // 2), max(1, most // 16), max(1, most // 16 + 1)} & set(range(1, most + 1))):
        if levels > 1 and merkle.width(levels, leaves, 0) != 1:
            continue
        places = np.concatenate(
            [merkle.address(levels, leaves, d, np.arange(merkle.width(levels, leaves, d))) for d in range(levels)]
        )
        assert sorted(places.tolist()) == list(range(len(places)))
        # The upper half lies before the lower trees, and each of those is one stretch.
        top = levels // 2
        upper = sum(merkle.width(levels, leaves, d) for d in range(top))
        assert set(places[:upper].tolist()) == set(range(upper))
        for tree in range(merkle.width(levels, leaves, top) if levels > 1 else 0):
            inside = []
            for d in range(top, levels):
                index = np.arange(merkle.width(levels, leaves, d))
                inside += merkle.address(levels, leaves, d, index[index >> 4 * (d - top) == tree]).tolist()
            assert max(inside) - min(inside) + 1 == len(inside)


def random_docs(rng, n):
    sources = ["b", "a", "é", "", "Z", None, "=", "one"]
    rows = [
        (rng.choice([None, *range(400)]), rng.choices(sources, [60, 9, 9, 2, 1, 4, 1, 0])[0], rng.choice(["en", None]),
         rng.choice([None, 3, -5]), rng.choice([None, "", "Ab C", "é Ü", "x" * 500, "low"]))
        for _ in range(n)
    ]
    return rows + [(1, "one", "en", 1, "Alone")]


@pytest.mark.parametrize("levels", [2, 4])
def test_manifest_equals_a_plain_tree(spark, levels):
    rows = random_docs(random.Random(levels), 900)
    rows += [rows[0]] * 300  # one row repeated
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert sorted_rows(proofs(docs, block_levels=levels)) == brute(rows)


def test_manifest_of_many_sources_and_of_one_row(spark):
    rows = [(i, f"s{i}", "en", i, f"T{i}") for i in range(300)]
    assert sorted_rows(proofs(spark.createDataFrame(rows, DOCS), block_levels=2)) == brute(rows)
    assert sorted_rows(proofs(spark.createDataFrame(rows[:1], DOCS))) == brute(rows[:1])


def test_manifest_of_an_empty_table_and_clashing_columns(spark):
    assert proofs(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(i, "a", "en", 1, "x") for i in range(20)]
    clash = spark.createDataFrame(rows, DOCS)
    for name in ("tree", "pos", "size", "digest", "part", "nth", "block", "key", "row", "root"):
        clash = clash.withColumn(name, F.lit("z"))
    assert sorted_rows(proofs(clash)) == brute(rows)


def test_proofs_can_be_folded_by_a_reader(spark):
    rows = [(i, "ab"[i % 2], "en", 1, f"t{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", merkle.leaf_hash([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    found = merkle.prove(merkle.build(docs, "source", "doc_id", "leaf"), with_proof=True).collect()
    assert len(found) == 40 and all(r.verified and h(r.proof) == r.proof_sha256 and len(r.proof) % 64 == 0 for r in found)
    assert len({r.root for r in found}) == 1 and len({r.subroot for r in found}) == 2


def test_query_equals_a_plain_tree_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted_rows(op13_merkle(spark, SF)) == brute(rows)


# quality


def test_features_of_odd_texts():
    texts = pa.array([None, "", " \n", "A", "the cat sat.", "THE!! CAT!!", "x $$$ y%%%", "a a a a", "é" * 30, "l\nl\nl", "😀"])
    rows = quality.features_of(texts)
    assert rows.shape[0] == len(texts) and np.isfinite(rows).all() and (rows >= 0).all() and (rows <= 1).all()
    assert (rows[0] == rows[1]).all()
    assert np.allclose(rows[[4, 5, 7]], np.concatenate([quality.features_of(texts[i : i + 1]) for i in (4, 5, 7)]))
    assert quality.features_of(pa.array([], pa.string())).shape[0] == 0


def test_pairs_use_every_row_and_both_kinds():
    for good, bad in ((5, 2), (2, 5), (1, 1), (40, 40), (3, 1)):
        one, two = quality.pairs_of(good, bad)
        assert set(one.tolist()) == set(range(good)) and set(two.tolist()) == set(range(bad))
        assert len(set(zip(one.tolist(), two.tolist()))) == len(one) <= quality.PAIRS * max(good, bad)


def test_fit_equals_plain_gradient_descent():
    rng = np.random.default_rng(2)
    rows = rng.random((60, 3))
    labels = (rows[:, 0] - rows[:, 1] + rng.normal(0, 0.4, 60) > 0).astype(int)
    model = quality.fit(rows, labels)
    good, bad = rows[labels == 1], rows[labels == 0]
    scale = rows.std(axis=0)
    weights = np.zeros(3)
    one, two = quality.pairs_of(len(good), len(bad))
    for _ in range(4000):
        slope = quality.RIDGE * weights
        for g, b in zip(one, two):
            gap = (good[g] - bad[b]) / scale
            slope = slope - gap / (1 + np.exp(gap @ weights)) / len(one)
        weights = weights - 2.0 * slope
        if np.abs(slope).max() < 1e-7:
            break
    assert np.allclose(model.weights * scale, weights, atol=1e-3)
    scores = 1 / (1 + np.exp(-(rows @ model.weights + model.shift)))
    assert (scores >= quality.THRESHOLD).sum() == labels.sum()


def test_one_kind_of_label_and_none(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a", None, "", "b!!"])], "doc_id long, text string")
    for label, score in ((1, 1.0), (0, 0.0), (None, 0.5)):
        labels = spark.createDataFrame([(i, label) for i in range(4)], "doc_id long, quality int")
        found = quality.classify(docs, quality.train_on(docs, labels)).collect()
        assert {round(r.score, 6) for r in found} == {score} and len(found) == 4


def test_training_is_bounded_and_ignores_held_out_rows(spark):
    docs = spark.createDataFrame([(i % 50, ("fine words here. " if i % 2 else "BAD!! $$$ ") * (1 + i)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] * 3, "doc_id long, quality int")
    whole = quality.train_on(docs, labels)
    ids = [r[0] for r in docs.where(~quality.is_held_out(F.col("doc_id"))).select("doc_id").distinct().collect()]
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids) and len(ids) < 50
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.allclose(whole.weights, quality.train_on(docs, flipped).weights)
    assert quality.train_on(docs, labels, train_rows=4).weights.shape == whole.weights.shape
    clash = docs.withColumn("score", F.lit("s")).withColumn("label", F.lit(9)).withColumn("vector", F.lit(1)).withColumn("id", F.lit(1))
    assert np.allclose(whole.weights, quality.train_on(clash, labels).weights)
    assert quality.classify(clash, whole).schema["score"].dataType.simpleString() == "double"
    assert quality.classify(docs.limit(0), whole).count() == 0


def test_query_on_held_out_labels(spark):
    folder = SF.replace("0.001", "0.1")
    scored = op11_quality(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").join(scored, "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in labels]
    assert len(right) > 500 and np.mean(right) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert scored.count() == docs.count()
    model = quality.train_on(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    some = docs.orderBy("doc_id").limit(50).collect()
    found = {r.doc_id: r.score for r in scored.collect()}
    for row in some:  # one text at a time, plainly
        logit = float(quality.features_of(pa.array([row.text]))[0] @ model.weights + model.shift)
        assert abs(found[row.doc_id] - 1 / (1 + np.exp(-logit))) < 1e-9
