"""N-gram Jaccard join: a grouped prefix join over the distinct word shingles of every text.

Shingles are ordered from rare to frequent, by a table of fixed size that counts all shingles of
all texts in hashed cells, ties by hash. Two sets of similarity t or more share a shingle among
the first n - ceil(t n) + 1 of each, so only those are shuffled.

1. Texts with the same set become one node; nodes with the same prefix and size become a group.
2. Within each prefix shingle, groups are ordered by size, and once at random, and tied to their
   ``LAGS`` neighbours and to the first one only; pairs that pass the size, the position and the
   signature filter are verified exactly.
3. Their links give components. Only shingles that still touch several components are joined in
   full, and only pairs of different components are verified. Pairs inside a component cannot
   change it, so thousands of near copies cost a line, not a square.

The signature of a set has one bit for each of ``BITS`` cells: whether an odd number of its
shingles fall there. Every bit in which two signatures differ stands for a shingle that only one
of the sets has, so a pair that differs in more bits than linked sets of these sizes differ in
shingles is no link. The filter never drops a link; sets of thousands of shingles all pass it.

Pairs meet as compressed texts, from which the sets are made anew: a set of hashes takes more room than
its text and does not compress.

Sets are compared as 64-bit shingle hashes; two different shingles of one pair share a hash with
a chance of about 2^-44 for sets of a thousand shingles.
Groups are known by 64 bits as well, since a group's name is shuffled with every prefix shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from boxoffice.llm.components import components
from boxoffice.llm.scratch import likely, stored
from boxoffice.llm.words import ASCII_SPACE, LOWER, PIECE, hashes, mix, pieces, spans, utf8

# Cells of the frequency table and the slices in which it is added up; both are fixed, so it has 4 MB at any size.
CELLS = 1 << 22
SLICES = 64
# Bits of a signature, in words of 64; in the join of all pairs it is folded to half of them.
WORDS = 8
BITS = 64 * WORDS
# Neighbours on one side to which a group is tied in each order.
LAGS = 3


def shingle_sets(column: pa.Array, width: int, repeated: bool = False) -> list[np.ndarray]:
    """For each text the hashes of its distinct ``width``-word shingles, ascending (or all of them, in order)."""
    buffer, offsets = utf8(column)
    starts, ends, first = spans(buffer, offsets, ASCII_SPACE)
    words = hashes(LOWER[buffer], starts, ends)
    odd = [np.uint64(mix(np.uint64([i + 11]))[0] | np.uint64(1)) for i in range(width)]
    with np.errstate(over="ignore"):
        padded = np.concatenate([words, np.zeros(width, np.uint64)])
        grams = sum(padded[i : i + len(words)] * odd[i] for i in range(width)) if len(words) else words
        grams = mix(grams)
        out = []
        for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
            if high - low >= width:
                own = grams[low : high - width + 1]
            elif high > low:
                few = sum(words[low + i] * odd[i] for i in range(high - low))
                own = mix(np.array([few + np.uint64(high - low)], np.uint64))
            else:
                own = words[:0]
            out.append(own if repeated else _unique(own))
    return out


def _unique(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(42)).astype(np.int64)


def _add(total: np.ndarray, grams: np.ndarray) -> None:
    cells, counts = np.unique(_cells(grams), return_counts=True)
    total[cells] += counts.astype(np.uint32)


def _frequencies(docs: DataFrame, width: int) -> bytes:
    """How often each cell's shingles occur in all texts, on a logarithmic scale of one byte."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.uint32)  # a task has fewer than 2^32 shingles
        waiting, held = [], 0
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                grams = shingle_sets(piece.column("text"), width, repeated=True)
                waiting += grams
                held += sum(map(len, grams))
                if held > CELLS // 8:
                    _add(total, np.concatenate(waiting))
                    waiting, held = [], 0
        if waiting:
            _add(total, np.concatenate(waiting))
        if total.any():
            parts = total.reshape(SLICES, -1)
            packed = [pa.compress(p.astype("<u4").tobytes(), "zstd", asbytes=True) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(packed, pa.binary())], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = pa.decompress(packed.as_py(), CELLS // SLICES * 4, "zstd", asbytes=True)
                counts = totals.setdefault(part, np.zeros(CELLS // SLICES, np.int64))
                counts += np.frombuffer(raw, "<u4")
        scaled = [np.minimum(np.rint(8 * np.log2(1.0 + c)), 255).astype(np.uint8).tobytes() for c in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(scaled, pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    added = docs.select("text").mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema)
    table = bytearray(CELLS)
    for row in added.collect():  # always SLICES rows, CELLS bytes
        table[row[0] * (CELLS // SLICES) : (row[0] + 1) * (CELLS // SLICES)] = row[1]
    return bytes(table)


def _prefix_length(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


def signature(grams: np.ndarray) -> np.ndarray:
    """``WORDS`` words: for each cell of shingle hashes whether it holds an odd number of them."""
    odd = np.bincount((grams & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


_SETS = "id {id_type}, hash long, n long, set_id binary, group_id long, prefix array<long>, signature array<long>"


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Size, identity and prefix of the set of every text."""
    table = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, width))  # 4 MB, always
    id_type = docs.schema["id"].dataType

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                sizes, names, groups, prefixes, signatures = [], [], [], [], []
                for own in shingle_sets(piece.column("text"), width):
                    sizes.append(len(own))
                    names.append(blake2b(own.tobytes(), digest_size=16).digest())
                    take = _prefix_length(len(own), percent) if len(own) else 0
                    prefix = own[np.argsort(frequency[_cells(own)], kind="stable")[:take]]
                    group = blake2b(prefix.tobytes(), digest_size=8, salt=len(own).to_bytes(8, "little")).digest()
                    groups.append(int.from_bytes(group, "little", signed=True))
                    prefixes.append(prefix.view(np.int64))
                    signatures.append(signature(own))
                ends = np.cumsum([0, *map(len, prefixes)])
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        piece.column("hash"),
                        pa.array(sizes, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(groups, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                        pa.ListArray.from_arrays(
                            pa.array(range(0, WORDS * len(sizes) + 1, WORDS), pa.int32()),
                            pa.array(np.concatenate(signatures) if signatures else np.zeros(0, np.int64)),
                        ),
                    ],
                    ["id", "hash", "n", "set_id", "group_id", "prefix", "signature"],
                )

    return stored(docs.mapInArrow(make, _SETS.format(id_type=id_type.simpleString())), "ngram-sets")


def _may_link(n1: Column, pos1: Column, n2: Column, pos2: Column, percent: int) -> Column:
    """Size and position filter: the shingle is common, and at most the rest of the smaller tail is."""
    bound = 1 + F.least(n1 - pos1 - 1, n2 - pos2 - 1)
    sizes = (n1 * 100 >= n2 * percent) & (n2 * 100 >= n1 * percent)
    return sizes & (bound * (100 + percent) >= percent * (n1 + n2))


def _alike(n1: Column, words1: list[Column], n2: Column, words2: list[Column], percent: int) -> Column:
    """Signature filter: linked sets of these sizes may differ in so many shingles."""
    differ = sum((F.bit_count(one.bitwiseXOR(two)) for one, two in zip(words1, words2)), F.lit(0))
    return differ * (100 + percent) <= (n1 + n2) * (100 - percent)


def _words(signed: str) -> list[Column]:
    return [F.col(signed)[i] for i in range(WORDS)]


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, set_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links; two texts link when 100 * (common
    shingles) >= ``percent`` * (all shingles of both). Words are runs of bytes other than ASCII
    white space, lower-cased in A-Z only. With fewer than ``width`` words the whole sequence is
    one shingle; a text without words, or null, has none and is its own component. Rows that
    repeat an id are rows of their own. Null ids never name a component unless it has no other.
    """
    if not 0 < percent <= 100 or width < 1:
        raise ValueError("percent is within 1 and 100, width at least 1")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text"))  # ids may repeat: id and hash tell texts apart
    sets = _sets(docs, width, percent)
    named_by = [
        F.min("id").alias("first_id"),
        F.min(F.struct("id", "hash")).alias("member"),
        F.first("signature").alias("signature"),
    ]
    nodes = stored(sets.where("n > 0").groupBy("set_id", "group_id", "n").agg(*named_by), "ngram-nodes")
    several = (F.min("set_id") != F.max("set_id")).alias("several")
    prefixes = sets.where("n > 0").groupBy("group_id").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), several)
    tokens = _shared_tokens(prefixes)
    pairs = stored(_neighbours(tokens, nodes, percent), "ngram-pairs")
    texts = _texts(docs, _members(pairs, nodes), width)
    checked = _verified(pairs, texts, width, percent)
    links = checked.where("linked").select("a", "b")
    roots = stored(components(links), "ngram-roots")
    crossing = _crossing(tokens, nodes, roots, percent).join(checked.select("a", "b"), ["a", "b"], "left_anti")
    crossing = stored(crossing, "ngram-crossing")
    ends = _members(crossing, nodes)
    unread = ends.join(texts.select("set_id"), "set_id", "left_anti")
    read = likely(texts, F.col("set_id"), ends, F.col("set_id"))
    more = _verified(crossing, read.union(_texts(docs, unread, width)), width, percent).where("linked").select("a", "b")
    joined = more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(
        roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left"
    )
    bridges = joined.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    above = stored(components(bridges), "ngram-bridges")
    named = _named(nodes, roots, above)
    return (
        sets.join(named, "set_id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
            "set_id",
        )
    )


def _named(nodes: DataFrame, roots: DataFrame, above: DataFrame) -> DataFrame:
    """(set_id, component): the smallest id in the component of every node."""
    top = (
        nodes.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
        .join(above.select(F.col("root").alias("top"), F.col("node").alias("root")), "root", "left")
        .select("set_id", "first_id", F.coalesce("top", "root").alias("top"))
    )
    top = stored(top, "ngram-tops")
    least = stored(top.groupBy("top").agg(F.min("first_id").alias("component")), "ngram-least")
    return stored(top.join(least, "top").select("set_id", "component"), "ngram-named")


def _shared_tokens(prefixes: DataFrame) -> DataFrame:
    """(token, group_id, n, pos) of the prefix shingles that at least two groups share.

    Nodes of one group meet in its first shingle, which passes the position filter, so that one stays if there are several.
    """
    rows = prefixes.select("group_id", "n", "several", F.posexplode("prefix").alias("pos", "token"))
    counted = rows.withColumn("groups", F.count("*").over(Window.partitionBy("token")))
    kept = counted.where((F.col("groups") > 1) | (F.col("several") & (F.col("pos") == 0)))
    return stored(kept.select("token", "group_id", "n", "pos"), "ngram-tokens")


def _neighbours(tokens: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes: each group's first member with those of its neighbours, and with its other members."""
    order = Window.partitionBy("token").orderBy("n", "group_id")
    shuffled = Window.partitionBy("token").orderBy(F.xxhash64("token", "group_id"), "group_id")
    here = F.struct("group_id", "n", "pos")
    others = {"hub": F.first(here).over(order)}
    for back in range(1, LAGS + 1):
        others[f"previous{back}"] = F.lag(here, back).over(order)
        others[f"any{back}"] = F.lag(here, back).over(shuffled)
    rows = tokens.withColumns(others)
    pairs = None
    for other in others:
        found = rows.where(
            (F.col(f"{other}.group_id") != F.col("group_id"))
            & _may_link(F.col("n"), F.col("pos"), F.col(f"{other}.n"), F.col(f"{other}.pos"), percent)
        ).select(F.col(f"{other}.group_id").alias("x"), F.col("group_id").alias("y"))
        pairs = found if pairs is None else pairs.union(found)
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    first = F.min(F.struct(F.col("set_id").alias("id"), "n", "signature"))
    heads = stored(nodes.groupBy("group_id").agg(first.alias("head")), "ngram-heads")
    between = (
        pairs.join(heads.select(F.col("group_id").alias("x"), F.col("head").alias("hx")), "x")
        .join(heads.select(F.col("group_id").alias("y"), F.col("head").alias("hy")), "y")
    )
    member = F.struct(F.col("set_id").alias("id"), "n", "signature").alias("hy")
    within = nodes.join(heads, "group_id").where("set_id <> head.id").select(F.col("head").alias("hx"), member)
    both = between.select("hx", "hy").union(within)
    alike = _alike(F.col("hx.n"), _words("hx.signature"), F.col("hy.n"), _words("hy.signature"), percent)
    both = both.where(alike).select(F.col("hx.id").alias("a"), F.col("hy.id").alias("b"))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _crossing(tokens: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Every candidate pair whose nodes lie in different components; shingles of one component are left out."""
    folded = [F.col("signature")[i].bitwiseXOR(F.col("signature")[i + WORDS // 2]).alias(f"w{i}") for i in range(WORDS // 2)]
    placed = (
        nodes.select("set_id", "group_id", *folded)
        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    rows = tokens.join(placed, "group_id")
    mixed = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rows = stored(rows.join(mixed.select("token"), "token", "left_semi"), "ngram-mixed")
    names = ("set_id", "root", "n", "pos", *[f"w{i}" for i in range(WORDS // 2)])
    one, two = (rows.select("token", *[F.col(c).alias(f"{c}{i}") for c in names]) for i in (1, 2))
    words1, words2 = ([F.col(f"w{j}{i}") for j in range(WORDS // 2)] for i in (1, 2))
    pairs = one.join(two, "token").where(
        (F.col("root1") < F.col("root2"))
        & _may_link(F.col("n1"), F.col("pos1"), F.col("n2"), F.col("pos2"), percent)
        & _alike(F.col("n1"), words1, F.col("n2"), words2, percent)
    )
    # Groups with the same prefix and size may also lie in several components.
    return pairs.select(F.least("set_id1", "set_id2").alias("a"), F.greatest("set_id1", "set_id2").alias("b")).distinct()


def _members(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(set_id, member) of the nodes in pairs: id and hash of one text each."""
    ends = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    return nodes.join(ends, "set_id", "left_semi").select("set_id", "member")


def _unpacked(text: pa.Scalar, width: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(text.as_buffer())
    return shingle_sets(pa.array([raw], pa.large_binary()), width)[0]


def _texts(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(set_id, n_grams, text) of the members, compressed; one text a set."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=3)
        return pa.array([press.compress(text.as_buffer()) for text in texts.cast(pa.large_binary()).fill_null(b"")], pa.binary())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = [], []
            for row, (name, text) in enumerate(zip(batch.column("set_id"), batch.column("text"))):
                own = _unpacked(text, width)
                # An equal hash may lead to another text: keep what is truly this set.
                if blake2b(own.tobytes(), digest_size=16).digest() == name.as_py():
                    rows.append(row)
                    sizes.append(len(own))
            true = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([true.column("set_id"), pa.array(sizes, pa.int64()), true.column("text")], ["set_id", "n_grams", "text"])

    chosen = stored(members, "ngram-members")
    texts = likely(docs.select(F.struct("id", "hash").alias("member"), "text"), F.col("member"), chosen, F.col("member"))
    # Equal rows become one before the shuffle; fields of structs that are null are equal.
    texts = texts.select("member", packed("text").alias("text")).groupBy("member").agg(F.first("text").alias("text"))
    found = texts.join(chosen, "member").select("set_id", "text").mapInArrow(check, "set_id binary, n_grams long, text binary")
    return stored(found, "ngram-texts")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, linked) by the exact size of the intersection of the sets, made anew from their texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ta, tb = batch.columns
            last, two, linked = None, None, []
            for row in range(batch.num_rows):
                if b[row] != last:  # rows of one set often follow each other
                    last, two = b[row], _unpacked(tb[row], width)
                one = _unpacked(ta[row], width)
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(common * (100 + percent) >= percent * (len(one) + len(two)))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    one, two = (texts.select(F.col("set_id").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb")
    return stored(both.mapInArrow(compare, "a binary, b binary, linked boolean"), "ngram-checked")
