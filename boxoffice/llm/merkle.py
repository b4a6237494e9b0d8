"""A Merkle manifest of a dataset, stored as subtrees in van Emde Boas order.

Rows are leaves. Within a source they ascend by key, and every 16 consecutive nodes, the last run
with fewer, become one node, until one is left: the source's subroot. The subroots, by source
(null first, then byte order), become the root the same way. Hashes are SHA-256 of the lowercase
hex digests of the run, written one after another.

A tree is cut into aligned subtrees of 4,096 leaves. A block is one byte string of 32-byte
digests, laid out by splitting it at half of its height: the upper half first, then each lower tree,
and so on within each. Places follow from the height, the number of leaves and (depth, index) alone,
so nothing but digests is stored, and building a block and finding the siblings of a path use the
same arithmetic. Roots of blocks are the leaves of the next layer of blocks, until a tree has one.

No task holds more than a range of leaves or a block with its path; a source of any size is many
blocks. Rows are ranked by a range partition of (source, key, digest, row), so one source, one
key or one row repeated often is spread as well.

Null fields count as ``-`` in a leaf; null keys come first, and rows of one key ascend by digest.
Only named columns are read. An empty table has no leaf and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from boxoffice.llm.scratch import small, stored

BITS = 4
RUN = 1 << BITS
# Levels of a block: 4,096 leaves and three levels above them.
BLOCK_LEVELS = 4

_PATH = "array<struct<at: int, beside: binary>>"
_PATH_TYPE = pa.list_(pa.struct([("at", pa.int32()), ("beside", pa.binary())]))


def levels_of(leaves: int) -> int:
    """Levels of nodes of a tree, its leaves included."""
    levels = 1
    while RUN ** (levels - 1) < leaves:
        levels += 1
    return levels


def width(levels: int, leaves: int, depth: int) -> int:
    """Nodes at a depth; the root has depth 0."""
    return -(-leaves // RUN ** (levels - 1 - depth))


def address(levels: int, leaves: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a depth lie; only the last tree of each lower half may be short of leaves."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    bottom = levels - top
    trees = width(levels, leaves, top)
    if depth < top:
        return address(top, width(levels, leaves, top - 1), depth, index)
    above = sum(width(levels, leaves, d) for d in range(top))
    whole = RUN ** (bottom - 1)
    shift = BITS * (depth - top)
    tree, inside = index >> shift, index & ((1 << shift) - 1)
    last = tree == trees - 1
    place = np.empty_like(index)
    place[~last] = address(bottom, whole, depth - top, inside[~last])
    place[last] = address(bottom, leaves - (trees - 1) * whole, depth - top, inside[last])
    return above + tree * ((RUN**bottom - 1) // (RUN - 1)) + place


def digest_of(hexes: str) -> bytes:
    return hashlib.sha256(hexes.encode()).digest()


class Block:
    """A subtree as bytes; ``nodes[address]`` is a digest."""

    def __init__(self, levels: int, leaves: int, nodes: np.ndarray) -> None:
        self.levels, self.leaves, self.nodes = levels, leaves, nodes

    @classmethod
    def build(cls, levels: int, digests: np.ndarray) -> Block:
        leaves = len(digests)
        block = cls(levels, leaves, np.empty((sum(width(levels, leaves, d) for d in range(levels)), 32), np.uint8))
        block.nodes[block.at(levels - 1)] = digests
        for depth in range(levels - 2, -1, -1):
            below = block.nodes[block.at(depth + 1)].tobytes().hex()
            step = 64 * RUN
            made = b"".join(digest_of(below[i : i + step]) for i in range(0, len(below), step))
            block.nodes[block.at(depth)] = np.frombuffer(made, np.uint8).reshape(-1, 32)
        return block

    @classmethod
    def read(cls, levels: int, leaves: int, raw: bytes) -> Block:
        return cls(levels, leaves, np.frombuffer(raw, np.uint8).reshape(-1, 32))

    def at(self, depth: int) -> np.ndarray:
        return address(self.levels, self.leaves, depth, np.arange(width(self.levels, self.leaves, depth)))

    @property
    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def runs(self, depth: int) -> list[str]:
        """The hex digests of every run at a depth."""
        row = self.nodes[self.at(depth)].tobytes().hex()
        return [row[i : i + 64 * RUN] for i in range(0, len(row), 64 * RUN)]

    def paths(self) -> list[list[tuple[int, bytes]]]:
        """For every leaf, (its place in the run, the digests beside it), level by level up to the block's root."""
        found: list[list[tuple[int, bytes]]] = [[]]
        for depth in range(1, self.levels):
            row = self.nodes[self.at(depth)]
            following = []
            for i in range(len(row)):
                low = i & ~(RUN - 1)
                beside = row[low:i].tobytes() + row[i + 1 : low + RUN].tobytes()
                following.append([(i - low, beside), *found[i >> BITS]])
            found = following
        return found


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    texts = [field.cast("string") for field in fields]
    sized = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return F.sha2(F.concat(*[F.coalesce(field, F.lit("-")) for field in sized]), 256)


def placed(rows: DataFrame, group: str, order: Sequence[str], purpose: str) -> DataFrame:
    """``rows`` with ``pos``, the exact place of each in its ``group`` (never null), and ``size``, the group's rows."""
    schema = StructType([*rows.schema.fields, StructField("part", LongType()), StructField("nth", LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(group).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            sizes = np.diff(np.append(starts, len(codes)))
            nth = np.arange(len(codes)) - np.repeat(starts, sizes)
            if batch.column(group)[0].as_py() == last:
                nth[: sizes[0]] += seen
            last, seen = batch.column(group)[-1].as_py(), int(nth[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(len(codes), part, np.int64)), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "nth"])

    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    numbered = stored(ranged.mapInArrow(number, schema), purpose)
    counts = stored(numbered.groupBy("part", group).agg(F.count("*").alias("n")), purpose + "-counts")
    # A group has one row here for each range it reaches into.
    over = Window.partitionBy(group).orderBy("part")
    before = F.sum("n").over(over) - F.col("n")
    size = F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = small(stored(counts.select("part", group, before.alias("before"), size.alias("size")), purpose + "-starts"))
    joined = numbered.join(starts, ["part", group])
    return joined.withColumn("pos", F.col("nth") + F.col("before")).drop("part", "nth", "before")


_BLOCKS = "tree string, block long, size long, leaves long, levels long, nodes binary, root binary"


def _blocks(nodes: DataFrame, purpose: str, block_levels: int) -> list[DataFrame]:
    """Layers of blocks of all trees, from (tree, pos, size, digest); the last layer has one block a tree."""
    most_leaves = block_leaves(block_levels)

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        size = table["size"][0].as_py()
        digests = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
        block = Block.build(block_levels if size > most_leaves else levels_of(size), digests)
        values = [table["tree"][0].as_py(), table["block"][0].as_py(), size, len(digests), block.levels, block.nodes.tobytes(), block.root]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.binary(), pa.binary()]
        names = ["tree", "block", "size", "leaves", "levels", "nodes", "root"]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names)

    layers: list[DataFrame] = []
    while True:
        keyed = nodes.select("tree", "pos", "size", "digest", F.expr(f"pos div {most_leaves}").alias("block"))
        layers.append(stored(keyed.groupBy("tree", "block").applyInArrow(make, _BLOCKS), f"{purpose}-{len(layers)}"))
        most = layers[-1].agg(F.max("size")).first()[0]
        if most is None or most <= most_leaves:
            return layers
        upper = F.expr(f"(size + {most_leaves - 1}) div {most_leaves}").alias("size")
        nodes = layers[-1].where(F.col("size") > most_leaves).select("tree", F.col("block").alias("pos"), upper, F.col("root").alias("digest"))


def block_leaves(levels: int) -> int:
    return RUN ** (levels - 1)


def _tops(layers: Sequence[DataFrame], block_levels: int) -> DataFrame:
    """(tree, root) of every tree."""
    tops = [layer.where(F.col("size") <= block_leaves(block_levels)).select("tree", "root") for layer in layers]
    found = tops[0]
    for top in tops[1:]:
        found = found.unionByName(top)
    return found


def _with_paths(layers: Sequence[DataFrame], tops: DataFrame, block_levels: int) -> DataFrame:
    """The lowest blocks with ``path``, the levels above their roots; ``tops`` has (tree, path, ...) above each tree."""
    extra = [name for name in tops.columns if name not in ("tree", "path")]
    single = F.col("size") <= block_leaves(block_levels)
    above: DataFrame | None = None
    for number in range(len(layers) - 1, -1, -1):
        layer = layers[number]
        joined = layer.where(single).join(tops, "tree")
        if above is not None:
            parts = layer.where(~single).join(above, ["tree", "block"])
            joined = joined.unionByName(parts.select(*joined.columns))
        if number:
            above = stored(_leaf_paths(joined, extra, block_levels).withColumnRenamed("pos", "block"), "merkle-paths")
    return joined


def _leaf_paths(blocks: DataFrame, extra: Sequence[str], block_levels: int) -> DataFrame:
    """(tree, pos, path) of every leaf of the blocks."""
    names = ["tree", "pos", *extra, "path"]
    kept = [blocks.schema[name] for name in extra]
    path = blocks.schema["path"]
    schema = StructType([blocks.schema["tree"], StructField("pos", LongType()), *kept, path])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                one = {name: row.column(name)[0].as_py() for name in ("tree", "block", "leaves", "levels", "nodes", "path")}
                own = Block.read(one["levels"], one["leaves"], one["nodes"]).paths()
                paths = [[*({"at": a, "beside": b} for a, b in path), *one["path"]] for path in own]
                positions = np.arange(len(own)) + one["block"] * block_leaves(block_levels)
                same = [pa.array([row.column(name)[0].as_py()] * len(own), row.column(name).type) for name in extra]
                columns = [pa.array([one["tree"]] * len(own), pa.string()), pa.array(positions, pa.int64()), *same, pa.array(paths, _PATH_TYPE)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return blocks.mapInArrow(expand, schema)


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame  # tree, pos, size, key, digest, claim
    layers: list[DataFrame]  # blocks of the sources, the lowest first
    sources: DataFrame  # tree, pos and digest of the subroots
    root_layers: list[DataFrame]  # blocks of the tree over the sources
    root: bytes | None
    block_levels: int


def build(
    rows: DataFrame,
    source_col: str,
    key_col: str,
    leaf_col: str,
    claim_col: str | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> Manifest:
    """The manifest of ``rows``, whose ``leaf_col`` is the hex digest of the row (see ``leaf_hash``).

    ``claim_col`` may hold the digest that a row is said to have, to be tested against the manifest.
    """
    source = F.col(source_col).cast("string")
    claim = F.unhex(F.col(claim_col)) if claim_col else F.lit(None).cast(BinaryType())
    facts = rows.select(
        # Null is the empty string, any other source has a sign before it, which keeps the byte order.
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        F.col(key_col).alias("key"),
        F.unhex(F.col(leaf_col)).alias("digest"),
        claim.alias("claim"),
        F.monotonically_increasing_id().alias("row"),
    )
    facts = stored(facts, "merkle-facts")
    leaves = placed(facts, "tree", ["key", "digest", "row"], "merkle-leaves")
    layers = _blocks(leaves, "merkle-blocks", block_levels)
    subroots = _tops(layers, block_levels).select(F.lit("").alias("all"), F.col("tree").alias("source"), F.col("root").alias("digest"))
    sources = stored(placed(subroots, "all", ["source"], "merkle-sources"), "merkle-subroots")
    root_layers = _blocks(sources.select(F.col("all").alias("tree"), "pos", "size", "digest"), "merkle-root", block_levels)
    top = _tops(root_layers, block_levels).first()
    return Manifest(leaves, layers, sources, root_layers, bytes(top["root"]) if top else None, block_levels)


def prove(manifest: Manifest, with_proof: bool = False) -> DataFrame:
    """For every leaf: its key, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    The proof is the digests beside the leaf and beside each node above it, up to the root; with
    ``with_proof`` it is returned in hex. ``folded_root`` is made anew from the claimed digest, or
    the leaf's own, and the proof; ``verified`` says whether that is the root.
    """
    spark = manifest.leaves.sparkSession
    start = spark.createDataFrame([("",)], "tree string").select("tree", F.array().cast(_PATH).alias("path"))
    levels = manifest.block_levels
    paths = _leaf_paths(_with_paths(manifest.root_layers, start, levels), [], levels)
    tops = paths.join(manifest.sources.select("pos", "source", "digest"), "pos")
    tops = stored(tops.select(F.col("source").alias("tree"), "path", F.col("digest").alias("subroot")), "merkle-tops")
    blocks = _with_paths(manifest.layers, small(tops), levels).select("tree", "block", "leaves", "levels", "nodes", "path", "subroot")
    root = (manifest.root or b"").hex()
    key = manifest.leaves.schema["key"]
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *["proof"] * with_proof]
    kinds = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema = StructType([key, *StructType.fromDDL(kinds + ", proof string" * with_proof).fields])

    def one_block(leaves: pa.Table, found: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("pos")
        row = found.slice(0, 1).to_pylist()[0]
        block = Block.read(row["levels"], row["leaves"], row["nodes"])
        upper = [(step["at"], step["beside"].hex()) for step in row["path"]]
        # Digests beside each node of a depth and all above it, from the root down.
        beside = ["".join(text for _, text in upper)]
        for depth in range(1, block.levels):
            runs, following = block.runs(depth), []
            for number, run in enumerate(runs):
                following += [run[:at] + run[at + 64 :] + beside[number] for at in range(0, len(run), 64)]
            beside = following
        runs = [block.runs(depth) for depth in range(block.levels - 1, 0, -1)]

        def folded(digest: str, index: int) -> str:
            for level in runs:
                run, at = level[index >> BITS], 64 * (index & (RUN - 1))
                digest = hashlib.sha256((run[:at] + digest + run[at + 64 :]).encode()).hexdigest()
                index >>= BITS
            for at, text in upper:
                digest = hashlib.sha256((text[: 64 * at] + digest + text[64 * at :]).encode()).hexdigest()
            return digest

        own = [digest.hex() for digest in leaves["digest"].to_pylist()]
        claims = [claim.hex() if claim else leaf for claim, leaf in zip(leaves["claim"].to_pylist(), own)]
        roots = [folded(claim, index) for index, claim in enumerate(claims)]
        columns = [
            leaves["key"],
            pa.array(own, pa.string()),
            pa.array([row["subroot"].hex()] * len(own), pa.string()),
            pa.array([root] * len(own), pa.string()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in beside], pa.string()),
            pa.array(roots, pa.string()),
            pa.array([found == root for found in roots], pa.bool_()),
        ]
        return pa.table([*columns, *[pa.array(beside, pa.string())] * with_proof], names)

    keyed = manifest.leaves.select("tree", "pos", "key", "digest", "claim", F.expr(f"pos div {block_leaves(levels)}").alias("block"))
    return keyed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(one_block, schema)
