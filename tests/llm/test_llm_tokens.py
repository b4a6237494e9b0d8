"""Tokenizers, lexicon, wavelet shards and length histogram against the library and plain arrays."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boxoffice.llm import bpe, lengths, tokens, wavelet, words
from boxoffice.llm.lexicon import Lexicon, compile_lexicon
from conftest import SF

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOC = "doc_id long, text string"

HARD = [
    None,
    "",
    " ",
    "a",
    "  two  spaces \n\n lines\r\n\ttab ",
    "it's we're 'S  don't,x'll",
    "Hello, WORLD!! foo,bar (baz)... $$$ a|b x<|endoftext|>y <|endoftext|> <|startoftext|>|>",
    "é É ñ ß Üb wide  　  x  \u0085 y​",
    "é Å, ≠ ≮ ´́",
    "数字１２３ ٣ Ⅷ ½ x²3 12,345.67",
    "\U0001f600\U0001f468‍\U0001f469 힣 İstanbul ΣΑΣ ǅ ﬀ",
    "\x00\x01 \x1c\x1d a\x1fb \x0b\x0c",
    "x" * 5000 + " " + "ab" * 3000,
    "\n Word \n,mark ,'s",
    "w\n w\n\nw \nw",
]


def columns(texts):
    return words.utf8(pa.array(texts, pa.string()))


@pytest.mark.parametrize("path, cut, lower", [(BYTES, tokens.cut_spaced, False), (WORDS, tokens.cut_words, True)])
def test_pieces_give_the_ids_of_whole_texts(path, cut, lower):
    rng = random.Random(3)
    alphabet = ["a", "b", "Z", "é", " ", " ", "\n", ",", ".", "'", "s", "1", " ", "́", "<|endoftext|>", "|", "-", "\t", "ſ", "中"]
    texts = HARD + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(1500)]
    library = Tokenizer.from_file(path)
    encoder = tokens.Encoder(tokens.library_encode(path, "<|endoftext|>", lower))
    for some in (texts[:700], texts[700:], texts):
        buffer, offsets = columns(some)
        starts, ends, first = cut(buffer, offsets)
        ids, counts = encoder(buffer, starts, ends)
        assert (encoder.counts(buffer, starts, ends) == counts).all()
        edges = np.concatenate([[0], np.cumsum(tokens.per_text(counts, first))])
        for text, a, b in zip(some, edges[:-1], edges[1:]):
            assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_encoder_forgets_and_stays_exact(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    encoder = tokens.Encoder(tokens.library_encode(BYTES, "<|endoftext|>"))
    library = Tokenizer.from_file(BYTES)
    for i in range(10):
        text = " ".join(f"word{j}" for j in range(i, i + 30))
        buffer, offsets = columns([text])
        starts, ends, _ = tokens.cut_spaced(buffer, offsets)
        assert encoder(buffer, starts, ends)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_hashes_depend_on_the_bytes_alone(monkeypatch):
    text = ("ab cd " * 50 + "x" * 300 + " end").encode()
    buffer = np.frombuffer(text, np.uint8)
    starts, ends, _ = words.spans(buffer, np.array([0, len(buffer)]), words.ASCII_SPACE)
    whole = words.hashes(buffer, starts, ends)
    monkeypatch.setattr(words, "WINDOW", 64)
    assert (words.hashes(buffer, starts, ends) == whole).all()
    assert len(set(whole.tolist())) == len(set(text.split()))


def test_distinct_also_when_the_high_bits_agree():
    values = np.array([5, 7, 5, 6, 2**63, 2**63 + 1, 2**63, 7], np.uint64)
    found, first, went = words.distinct(values)
    assert (found[went] == values).all() and (values[first] == found).all() and len(found) == 5


def test_lexicon_is_minimal_and_finds_every_word(tmp_path):
    rng = random.Random(1)
    chosen = {"".join(rng.choices("abc", k=rng.randint(1, 7))).encode() + rng.choice([b"", b"ing", b"ed"]) for _ in range(800)}
    entries = {word: [i, i + 1][: 1 + i % 2] for i, word in enumerate(sorted(chosen))}
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon.open(str(path))
    asked = sorted(chosen) + [b"zzz", b"ab" * 9, b"a\xff", b"in"]
    buffer, offsets = columns([word.decode("latin-1") for word in asked if word != b"a\xff"])
    at = lexicon.find(buffer, offsets[:-1], offsets[1:])
    for word, place in zip([w for w in asked if w != b"a\xff"], at.tolist()):
        if word not in entries:
            assert place == -1
        else:
            begin, count = int(lexicon.begin[place]), int(lexicon.count[place])
            assert lexicon.ids[begin : begin + count].tolist() == entries[word]
    # As many states as there are different sets of endings.
    endings = {frozenset(w[len(p) :] for w in chosen if w.startswith(p)) for w in chosen for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lexicon.final) == len(endings)
    assert len(Lexicon(compile_lexicon({}))) == 0


def test_bpe_encodes_and_decodes_like_the_library(spark):
    library = Tokenizer.from_file(WORDS)
    rows = [(i, text) for i, text in enumerate(HARD)] + [(99, "the same word " * 200), (99, "the same word " * 200), (None, "x")]
    found = bpe.encode(spark.createDataFrame(rows, DOC + "").withColumn("ids", F.lit("old")), WORDS, decoded=True).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, ((r.doc_id, r.ids, r.decoded) for r in found))) == sorted(map(str, want))
    assert bpe.encode(spark.createDataFrame([], DOC), WORDS).count() == 0


def test_frequent_words_are_counted_over_all_texts(spark):
    rows = [(i, "often often often rare" + str(i)) for i in range(20)]
    assert bpe.frequent_words(spark.createDataFrame(rows, DOC).coalesce(2)) == [b"often"]


@pytest.mark.parametrize("high", [2, 300, 50_257, 70_000])
def test_wavelet_access_count_and_select(high, tmp_path):
    rng = np.random.default_rng(high)
    ids = (rng.integers(0, high, 150_000) * (rng.random(150_000) < 0.6)).astype(np.uint32)
    table = pa.RecordBatch.from_arrays([pa.array([None, 5]), pa.array([len(ids) - 1, 1])], ["doc_id", "n_tokens"])
    path = tmp_path / "shard"
    path.write_bytes(wavelet.build_shard(ids, table))
    shard = wavelet.WaveletShard.open(str(path))
    assert (shard.ids() == ids).all() and shard.documents().equals(table)
    for at in (0, 1, 65_535, 65_536, 131_071, 149_999, *rng.integers(0, 150_000, 5).tolist()):
        assert shard.access(at) == ids[at]
        assert shard.rank(int(ids[at]), at) == (ids[:at] == ids[at]).sum()
    for value in {0, 1, int(ids.max()), int(ids[777]), high - 1}:
        places = np.flatnonzero(ids == value)
        assert shard.count(value) == len(places)
        assert shard.count(value, 1000, 90_000) == ((places >= 1000) & (places < 90_000)).sum()
        for k in {0, len(places) // 2, len(places) - 1} if len(places) else ():
            assert shard.select(value, k) == places[k]
        with pytest.raises(IndexError):
            shard.select(value, len(places))
    assert shard.count(1 << 20) == 0
    with pytest.raises(IndexError):
        shard.access(len(ids))


def encoded(rows):
    library = Tokenizer.from_file(BYTES)
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_shards_are_read_back_in_order(spark, tmp_path, shard_tokens):
    rows = [(100 - i, text) for i, text in enumerate(HARD)] + [(7, "twice"), (7, "twice"), (None, "no id")]
    shards = wavelet.write_shards(spark.createDataFrame(rows, DOC), BYTES, str(tmp_path / "s"), shard_tokens=shard_tokens)
    found = wavelet.read_documents(shards, with_ids=True).orderBy("start").collect()
    assert [tuple(r) for r in found] == encoded(rows)
    zero = wavelet.occurrences(shards, 0).agg(F.sum("n")).first()[0]
    assert zero == sum(ids.count(0) for *_, ids in encoded(rows))


def test_shards_of_an_empty_table(spark, tmp_path):
    shards = wavelet.write_shards(spark.createDataFrame([], DOC), BYTES, str(tmp_path / "s"))
    assert shards.count() == 0 and wavelet.read_documents(shards).count() == 0


def test_length_histogram_answers_for_every_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-2, "")], DOC))
    library = Tokenizer.from_file(BYTES)
    sizes = np.array(sorted(len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()))
    sums = lengths.suffix_sums(lengths.length_histogram(docs, BYTES)).cache()
    for r in sums.collect():
        above = sizes[sizes >= r.n_tokens]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == ((sizes == r.n_tokens).sum(), len(above), above.sum())
        assert r.tokens_within == np.minimum(sizes, r.n_tokens).sum()
    for limit in (0, 1, 17, 2048, 10**7):
        assert lengths.total_within(sums, limit).first()[0] == np.minimum(sizes, limit).sum()
    for share in (0.0, 0.25, 0.5, 0.999, 1.0):
        assert lengths.length_quantile(sums, share).first()[0] == sizes[max(int(np.ceil(share * len(sizes))) - 1, 0)]
    empty = lengths.suffix_sums(lengths.length_histogram(spark.createDataFrame([], DOC), BYTES))
    assert empty.count() == 0 and lengths.total_within(empty, 5).first()[0] == 0
    assert lengths.length_quantile(empty, 0.5).first()[0] is None


def test_an_id_that_holds_a_third_of_the_rows_is_in_several_parts(spark, tmp_path):
    rows = [(7 if i % 3 == 0 else i, f"word{i % 50} and more {i if i % 2 else ''}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("wavelet__row", F.lit("z")).repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = wavelet.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "shards"))
        found = wavelet.read_documents(shards).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r.n_docs for r in shards.collect()]
    assert len(sizes) >= 4 and max(sizes) < 1200
    assert sorted(r.doc_id for r in found) == sorted(row[0] for row in rows)
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids)
