"""Token shards as wavelet matrices: access, counting and occurrence lookup from one compressed file.

Documents are encoded, each ends with an end id, and ids are kept in ascending order of document
id (null first; rows of one id by text). A shard holds up to ``SHARD_TOKENS`` ids, or one longer
document. Its file has a bit-plane for every bit of an id; each plane is cut into blocks that are
compressed on their own, with the number of ones before each block. A lookup reads one block of
each plane; nothing else is unpacked.

Shards are rows of a Parquet table, one file each, so Spark commits them, finds them on any file
system, and repeats a lost task under another name.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxoffice.llm.tokens import byte_level_encoder, cut_spaced, per_text
from boxoffice.llm.words import pieces, utf8

SHARD_TOKENS = 1 << 22
BLOCK_BITS = 1 << 16
_MAGIC = b"WAVELET1"


def build_shard(ids: np.ndarray, documents: pa.RecordBatch) -> bytes:
    """The file for ids and a table of documents (``doc_id``, ``n_tokens``) in their order."""
    depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
    press = zstandard.ZstdCompressor(level=1)
    body, planes = [], []
    size = 0
    for level in range(depth - 1, -1, -1):
        ones = (now >> now.dtype.type(level)) & now.dtype.type(1)
        packed = np.packbits(ones.astype(np.uint8), bitorder="little")
        blocks = [press.compress(packed[i : i + BLOCK_BITS // 8].tobytes()) for i in range(0, len(packed), BLOCK_BITS // 8)]
        high = np.flatnonzero(ones)
        low = np.flatnonzero(ones == 0)
        before = np.searchsorted(high, np.arange(len(blocks)) * BLOCK_BITS)
        ends = size + np.cumsum([len(block) for block in blocks], dtype=np.int64)
        planes.append({"zeros": len(low), "before": before.tolist(), "ends": ends.tolist(), "begin": size})
        size = int(ends[-1]) if len(ends) else size
        body += blocks
        now = np.concatenate([now.take(low), now.take(high)])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as writer:
        writer.write_batch(documents)
    table = press.compress(sink.getvalue().to_pybytes())
    head = press.compress(json.dumps({"n": len(ids), "planes": planes, "documents": len(table)}).encode())
    return b"".join([_MAGIC, len(head).to_bytes(8, "little"), head, table, *body])


class WaveletShard:
    """Reads a shard file from bytes or a memory map."""

    def __init__(self, raw) -> None:
        raw = memoryview(raw)
        if raw[:8] != _MAGIC:
            raise ValueError("not a wavelet shard")
        unpack = zstandard.ZstdDecompressor()
        head = 16 + int.from_bytes(raw[8:16], "little")
        meta = json.loads(unpack.decompress(raw[16:head]))
        self.n, self._planes, self._unpack = meta["n"], meta["planes"], unpack
        self._table, self._body = raw[head : head + meta["documents"]], raw[head + meta["documents"] :]
        self.depth = len(self._planes)
        self._before = [np.array(p["before"], np.int64) for p in self._planes]

    @classmethod
    def open(cls, path: str) -> WaveletShard:
        return cls(np.memmap(path, np.uint8, "r"))

    def documents(self) -> pa.RecordBatch:
        """(doc_id, n_tokens) in the order of the ids."""
        return pa.ipc.open_stream(self._unpack.decompress(self._table)).read_next_batch()

    def _block(self, level: int, block: int) -> np.ndarray:
        plane = self._planes[level]
        begin = plane["ends"][block - 1] if block else plane["begin"]
        bits = np.frombuffer(self._unpack.decompress(self._body[begin : plane["ends"][block]]), np.uint8)
        return np.unpackbits(bits, bitorder="little")

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before a position."""
        block = at // BLOCK_BITS
        if block >= len(self._before[level]):
            return self.n - self._planes[level]["zeros"]
        inside = at - block * BLOCK_BITS
        return int(self._before[level][block]) + (int(self._block(level, block)[:inside].sum()) if inside else 0)

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.depth):
            bit = int(self._block(level, at // BLOCK_BITS)[at % BLOCK_BITS])
            ones = self._ones(level, at)
            at = self._planes[level]["zeros"] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of an id between two positions are in the last order."""
        if value >> self.depth:
            return 0, 0
        for level in range(self.depth):
            first, last = self._ones(level, start), self._ones(level, stop)
            if value >> (self.depth - 1 - level) & 1:
                start, stop = self._planes[level]["zeros"] + first, self._planes[level]["zeros"] + last
            else:
                start, stop = start - first, stop - last
        return start, stop

    def rank(self, value: int, at: int) -> int:
        """Occurrences of an id before a position."""
        return self.count(value, 0, at)

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id between two positions."""
        first, last = self._range(value, start, self.n if stop is None else stop)
        return last - first

    def select(self, value: int, k: int) -> int:
        """The position of the k-th occurrence of an id, from 0."""
        first, last = self._range(value, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        at = first + k
        for level in range(self.depth - 1, -1, -1):
            bit = value >> (self.depth - 1 - level) & 1
            k = at - self._planes[level]["zeros"] if bit else at
            before = self._before[level]
            if not bit:
                before = np.arange(len(before)) * BLOCK_BITS - before
            block = int(np.searchsorted(before, k, side="right")) - 1
            found = np.flatnonzero(self._block(level, block)[: self.n - block * BLOCK_BITS] == bit)
            at = block * BLOCK_BITS + int(found[k - int(before[block])])
        return at

    def ids(self) -> np.ndarray:
        """All ids, unpacked plane by plane from the last."""
        kind = np.uint16 if self.depth <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for level in range(self.depth - 1, -1, -1):
            blocks = range(len(self._before[level]))
            bits = np.concatenate([self._block(level, b) for b in blocks] or [np.zeros(0, np.uint8)])[: self.n]
            zeros = self._planes[level]["zeros"]
            out = np.empty_like(now)
            out[np.flatnonzero(bits == 0)] = now[:zeros]
            out[np.flatnonzero(bits)] = now[zeros:] | kind(1 << (self.depth - 1 - level))
            now = out
        return now


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode every whole text (null: empty), write the shards below ``folder`` and return their table.

    Rows go to ranges of ids, and rows of one id to ranges of a hash of their texts; a range is written
    in as many shards as it needs. Only the two named columns are read. An empty table has no shard.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows of one id go on by a hash of the text, equal rows by their place, so no id has to lie in one range.
    order = ["doc_id", "wavelet__hash", "wavelet__row"]
    docs = docs.withColumns({order[1]: F.xxhash64("text"), order[2]: F.monotonically_increasing_id()})
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order[1:])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level_encoder(tokenizer)
        part, number = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        documents: list[pa.RecordBatch] = []
        held = 0

        def shard() -> pa.RecordBatch:
            table = pa.Table.from_batches(documents).combine_chunks().to_batches()[0]
            raw = build_shard(np.concatenate(ids), table)
            values = [[part], [number], [table.num_rows], [held], [raw]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "shard", "n_docs", "n_tokens", "file"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                buffer, offsets = utf8(piece.column("text"))
                starts, ends, first = cut_spaced(buffer, offsets)
                flat, counts = encoder(buffer, starts, ends)
                sizes = per_text(counts, first)
                flat = np.insert(flat, np.cumsum(sizes), end_id)
                sizes = sizes + 1
                if held and held + len(flat) > shard_tokens:
                    yield shard()
                    ids, documents, held, number = [], [], 0, number + 1
                ids.append(flat.astype(np.uint32))
                documents.append(pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"]))
                held += len(flat)
        if held:
            yield shard()

    shards = ranged.mapInArrow(make, "part long, shard long, n_docs long, n_tokens long, file binary")
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)
    return open_shards(docs.sparkSession, folder)


def open_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("part long, shard long, n_docs long, n_tokens long, file binary").parquet(folder)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids before each shard; sums run within a part, then over the parts."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(over), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("inside"))
    return sums.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("inside")).alias("shard_start"))


def read_documents(shards: DataFrame, id_type: str = "long", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files; ``ids`` if asked.

    ``ids_crc32`` is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """
    names = ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, raw in zip(*(batch.column(name) for name in ("part", "shard", "file"))):
                shard = WaveletShard(raw.as_buffer())
                ids, documents = shard.ids().astype("<u4"), shard.documents()
                sizes = documents.column(1).to_numpy()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array([k.as_py()] * len(sizes), pa.int64()) for k in (part, number)]
                columns += [documents.column(0), pa.array(starts), documents.column(1), pa.array(sums, pa.int64())]
                if with_ids:
                    cuts = np.concatenate([[0], ends])
                    columns.append(pa.LargeListArray.from_arrays(cuts, ids.astype(np.int32)).cast(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"part long, shard long, doc_id {id_type}, inside long, n_tokens long, ids_crc32 long"
    found = shards.select("part", "shard", "file").mapInArrow(read, schema + ", ids array<int>" * with_ids)
    placed = found.join(shard_starts(shards), ["part", "shard"])
    return placed.select(
        "doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(part, shard, n, first, last): how often each shard has an id, and its first and last position there."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, number, raw in zip(*(batch.column(name) for name in ("part", "shard", "file"))):
                shard = WaveletShard(raw.as_buffer())
                n = shard.count(token)
                if n:
                    rows.append((part.as_py(), number.as_py(), n, shard.select(token, 0), shard.select(token, n - 1)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "shard", "n", "first", "last"])

    return shards.select("part", "shard", "file").mapInArrow(look, "part long, shard long, n long, first long, last long")
