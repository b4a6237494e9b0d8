"""Exact dedup, the n-gram join and mixing against brute force."""

import hashlib
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxoffice.llm import components as components_module
from boxoffice.llm import ngram_join as ngram
from boxoffice.llm.components import components
from boxoffice.llm.exact_dedup import exact_dedup
from boxoffice.llm.mixing import mix, source_targets
from boxoffice.llm.ngram_join import ngram_join
from boxoffice.llm.scratch import BATCH_BYTES, likely, stored

DOC = "doc_id long, text string"


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_equals_brute_force(spark):
    texts = ["a b", "ab", " a\tb\x0b", "A b", None, "", " \n", "x" * 70 + "1", "x" * 70 + "2", "x" * 70 + " 1", " ab", "ab́"]
    rows = [(i, text) for i, text in enumerate(texts)] + [(1, "ab"), (None, "a  b"), (3, None), (50, "é" * 3), (51, "é é é")]
    found = exact_dedup(spark.createDataFrame(rows, DOC), digest_all=True).collect()
    assert len(found) == len(rows)
    groups = {}
    for row in rows:
        groups.setdefault(squeezed(row[1]), []).append(row)
    for said, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        mine = [r for r in found if r.text_sha256 == hashlib.sha256(said.encode()).hexdigest()]
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in mine) == sorted((m[0] is None, m[0] or 0) for m in members)
        assert {r.keep_id for r in mine} == {best[0]} and {r.group_size for r in mine} == {len(members)}
        kept = [r for r in mine if r.kept]
        assert len(kept) == 1 and (kept[0].doc_id, len(kept[0].text or "")) == (best[0], len(best[1] or ""))


def test_exact_dedup_hashes_only_what_shares_length_and_head(spark):
    rows = [(1, "same"), (2, "sa me"), (3, "other"), (4, "fore")]
    found = {r.doc_id: r for r in exact_dedup(spark.createDataFrame(rows, DOC)).collect()}
    assert [found[i].text_sha256 is not None for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert [found[i].kept for i in (1, 2, 3, 4)] == [False, True, True, True]


def test_exact_dedup_of_empty_tables_and_clashing_columns(spark):
    assert exact_dedup(spark.createDataFrame([], DOC)).count() == 0
    rows = spark.createDataFrame([(1, "a", "x", 7), (2, " a", "y", 8)], DOC + ", kept string, group_size int")
    found = {r.doc_id: r for r in exact_dedup(rows).collect()}
    assert found[2].kept is True and found[1].kept is False and found[1].group_size == 2


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, width, percent):
    sets = [shingles(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    out = []
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in group]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 60))] for _ in range(12)]
    passage = [rng.choice(words) for _ in range(25)]
    rows = []
    for i in range(110):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.2:
            text = text[: rng.randint(1, len(text))]
        if rng.random() < 0.2:
            text += passage
        rows.append((rng.randint(0, 100), rng.choice([" ", "  ", "\n"]).join(text).title()))
    return rows


@pytest.mark.parametrize("seed, width, percent", [(1, 3, 90), (2, 5, 80), (3, 2, 60), (4, 1, 100)])
def test_ngram_join_equals_brute_force(spark, seed, width, percent):
    rows = corpus(seed) + [(200, None), (201, ""), (202, " \t"), (203, "w1"), (204, "W1"), (None, "w1"), (None, "alone here")]
    found = ngram_join(spark.createDataFrame(rows, DOC), width=width, percent=percent).drop("set_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_components(rows, width, percent)


def test_ngram_join_of_many_near_copies(spark):
    """One line of links, not all pairs, ties a large group; a chain is followed to its end."""
    words = [f"t{i}" for i in range(80)]
    rows = [(i, " ".join(words[:40] + [f"x{i}"] + words[41:])) for i in range(300)]
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(i, i + 60))) for i in range(40)]
    found = ngram_join(spark.createDataFrame(rows, DOC), width=3, percent=90).collect()
    assert {r.component_id for r in found if r.doc_id < 1000} == {0}
    assert {r.component_id for r in found if r.doc_id >= 1000} == {1000}


def test_ngram_join_ties_members_of_a_group_without_its_head(spark):
    """Three texts with one rare core, so one prefix and size; two of them link, whichever is first."""
    other, same = ([f"{name}{i}" for i in range(85)] for name in "xy")
    rows = []
    for i in range(12):
        core = [f"core{i}-{j}" for j in range(13)] + ["s", "t"]
        rows += [(3 * i + j, " ".join(core + tail)) for j, tail in enumerate([other, same, same[:-1] + ["z"]])]
    found = ngram_join(spark.createDataFrame(rows, DOC), width=3, percent=90).drop("set_id").collect()
    want = brute_components(rows, 3, 90)
    assert len({component for _, _, component in want}) == 24
    assert sorted((tuple(r) for r in found), key=str) == want


def test_ngram_join_meets_one_text_a_set_when_ids_repeat(spark, monkeypatch):
    words = [f"t{i}" for i in range(60)]
    texts = [" ".join(f"{w}-{k}" for w in words) + f" x{i}" for k in range(8) for i in range(4)]
    rows = [(i, text) for i in (None, 7) for text in texts[::2]] + [(7, texts[1])] * 40 + [(9, text) for text in texts]
    read, frame = [], type(spark.range(0))
    real = frame.mapInArrow

    def counting(self, make, schema, *more):
        if "grams" in str(schema):
            read.append(self.count())
        return real(self, make, schema, *more)

    monkeypatch.setattr(frame, "mapInArrow", counting)
    found = ngram_join(spark.createDataFrame(rows, DOC).repartition(3), width=3, percent=90).drop("set_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_components(rows, 3, 90)
    assert 0 < sum(read) <= len(texts)


def test_signatures_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(5)
    for size in (0, 1, 7, 60, 300, 5000):
        for changed in (0, 1, size // 20, size // 2, size):
            grams = np.unique(rng.integers(0, 1 << 63, size + changed, dtype=np.uint64))
            one, two = grams[:size], grams[len(grams) - size :]
            words = ngram.signature(one) ^ ngram.signature(two)
            bits = sum(int(w).bit_count() for w in words.view(np.uint64))
            folded = words[: ngram.WORDS // 2] ^ words[ngram.WORDS // 2 :]
            assert sum(int(w).bit_count() for w in folded.view(np.uint64)) <= bits <= len(np.setxor1d(one, two))


def test_ngram_join_of_an_empty_table_and_wrong_bounds(spark):
    assert ngram_join(spark.createDataFrame([], DOC)).count() == 0
    with pytest.raises(ValueError):
        ngram_join(spark.createDataFrame([], DOC), percent=0)


def test_components_of_a_long_path_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_links_of_one_node_are_spread_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(components_module, "TASK_LINKS", 50, raising=False)
    held, frame = [], type(spark.range(0))
    real = frame.mapInArrow

    def counting(self, *more):
        held.append(max(r["count"] for r in self.groupBy(F.spark_partition_id().alias("task")).count().collect()))
        return real(self, *more)

    monkeypatch.setattr(frame, "mapInArrow", counting)
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        links = spark.range(2000).selectExpr("id + 10 AS a", "9L AS b").union(spark.createDataFrame([(9, 3)], "a long, b long"))
        found = dict(components(links).collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found == {3: 3, 9: 3, **{i + 10: 3 for i in range(2000)}}
    assert held[0] < 2000 // 4


def test_likely_keeps_all_that_is_wanted(spark):
    wanted = spark.range(0, 1000, 7).toDF("k")
    found = {r[0] for r in likely(spark.range(1000), F.col("id"), wanted, F.col("k")).collect()}
    assert set(range(0, 1000, 7)) <= found and len(found) < 200


def brute_targets(sizes, weights, most):
    """Shares the rest by weight again and again, until no source is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s] + 1e-9]
        if not over:
            return {**{s: most * sizes[s] for s in full}, **share}
        full |= set(over)


@pytest.mark.parametrize("seed", range(5))
def test_targets_equal_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 5000]) for i in range(9)} | {None: 40, "": 3, "é": 77}
    found = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes, (5, 2, 1), 3)
    assert all(math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6) for r in found)


def test_mix_takes_whole_epochs_and_then_a_sample(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(600)]
    rows += [(900, None, "a"), (None, "x y", "b"), (3, "same id", "c"), (3, "same id", "c")]
    docs = spark.createDataFrame(rows, DOC + ", source string").repartition(5)
    found = mix(docs).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = brute_targets(sizes, (5, 2, 1), 3)
    by_target = {}
    for r in found:
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"]) and r.times * r["size"] == r.taken
        by_target.setdefault((r.source_size, round(r.target, 3)), []).append(r)
    for source, size in sizes.items():
        mine = by_target[(size, round(targets[source], 3))]
        assert abs(sum(r.taken for r in mine) - targets[source]) <= 16
        assert max(r.times for r in mine) - min(r.times for r in mine) <= 1
    again = mix(docs.repartition(2)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_mix_prefers_quality_and_takes_an_empty_table(spark):
    rows = [(i, "w " * 10, "big" if i % 10 else "a") for i in range(2000)]
    docs = spark.createDataFrame(rows, DOC + ", source string")
    good = F.when(F.col("doc_id") < 1000, F.lit(20.0)).otherwise(F.lit(1.0))
    found = [r for r in mix(docs, quality=good, weights=(1, 1)).collect() if r.target < r.source_size]
    # The share taken of each side: the target is 1,400 texts, of which 900 are good.
    shares = []
    for side in (True, False):
        times = [r.times for r in found if (r.doc_id < 1000) == side]
        shares.append(sum(times) / len(times))
    assert found and shares[0] > 0.9 > 0.7 > shares[1]
    assert mix(spark.createDataFrame([], DOC + ", source string")).count() == 0


def test_mix_of_an_id_that_holds_most_rows(spark):
    """The rows that one task sorts are as many as ids and sizes, and the budget is met to the text."""
    rows = [(7 if i % 3 else i, "w " * (4 + i % 2), "big" if i % 10 else "a") for i in range(6000)]
    rows += [(None, "x y", "big")] * 50
    docs = spark.createDataFrame(rows, DOC + ", source string").repartition(6)
    found = mix(docs, weights=(1, 1)).collect()
    assert len(found) == len(rows)
    for source_size, target in {(r.source_size, r.target) for r in found}:
        mine = [r for r in found if r.source_size == source_size]
        assert abs(sum(r.taken for r in mine) - target) <= 3
    again = mix(docs.repartition(3), weights=(1, 1)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_ngram_join_verifies_by_texts_not_by_whole_sets(spark, monkeypatch):
    """Nothing as large as the hashes of all sets is written for the pairs, whose texts are smaller."""
    sizes = {}
    kept = ngram.stored

    def spy(df, purpose):
        table = kept(df, purpose)
        sizes[purpose] = sizes.get(purpose, 0) + sum(os.path.getsize(name.removeprefix("file://")) for name in table.inputFiles())
        return table

    monkeypatch.setattr(ngram, "stored", spy)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(2000)) for _ in range(20)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(100 + i, text + " end") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join(docs, width=3, percent=90).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == sorted((i, i % 100) for i, _ in rows)
    whole = 8 * sum(len(text.split()) for _, text in rows)
    assert max(sizes.values()) < whole / 3, sizes


def test_likely_runs_without_python(spark):
    kept = likely(spark.range(10), F.col("id"), spark.range(3).toDF("k"), F.col("k"))
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()
    assert likely(spark.range(10), F.col("id"), spark.range(0).toDF("k"), F.col("k")).count() == 0


def test_stored_hands_wide_rows_to_python_in_small_batches(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "size"])

    wide = spark.range(0, 24, 1, 1).selectExpr("repeat('x', 1048576) AS text")
    found = stored(wide.mapInArrow(sizes, "rows long, size long"), "test-batches").collect()
    assert sum(r["rows"] for r in found) == 24 and max(r["size"] for r in found) <= BATCH_BYTES + (2 << 20)
    assert spark.conf.get(setting) == before


def test_groups_are_named_by_prefix_and_size_in_one_long(spark):
    rows = [(1, "a b c d"), (2, "A b  c d"), (3, "a b c e"), (4, "a b c d e"), (5, "")]
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("hash", F.xxhash64("text"))
    sets = ngram._sets(docs, 3, 90)
    assert dict(sets.dtypes)["group_id"] == "bigint"  # shuffled with every prefix shingle
    name = {r.id: r.group_id for r in sets.collect()}
    assert name[1] == name[2] and len(set(name.values())) == 4
