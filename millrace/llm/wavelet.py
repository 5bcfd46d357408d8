"""Token-ID output: one wavelet matrix per shard, a compressed file that answers access, rank, select, count and positions."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import documents, give_back, keep_only, materialize, small_batches
from millrace.llm.wordids import default_path, word_ids

MAGIC = b"MRWM0002"
#: Bits that one entry of the rank directory covers, and bits that are compressed together.
BLOCK, CHUNK = 512, 1 << 16
BLOB = "part int, seq int, n_docs long, n_tokens long, data binary"


class Plane:
    """The bits of one level: compressed chunks, the 1 bits before each chunk, and those from there to each block in it. A query opens the chunks that it asks for."""

    def __init__(self, n: int, before: np.ndarray, ranks: np.ndarray, ends: np.ndarray, data: memoryview):
        self.n, self.before, self.ranks, self.ends, self.data = n, before, ranks, ends, data
        self.open: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        n = len(bits)
        chunks = max(1, -(-n // CHUNK))
        packed = np.zeros(chunks * CHUNK // 8, np.uint8)
        packed[: -(-n // 8)] = np.packbits(bits, bitorder="little")
        ones = np.bitwise_count(packed).reshape(chunks, CHUNK // BLOCK, BLOCK // 8).sum(axis=2, dtype=np.int64)
        inside = np.cumsum(ones, axis=1)
        before = np.concatenate([[0], np.cumsum(inside[:, -1])]).astype("<u8")
        ranks = (inside - ones).astype("<u2").ravel()
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [pack(c.tobytes()) for c in packed.reshape(chunks, -1)]
        return cls(n, before, ranks, np.cumsum([len(x) for x in parts]).astype("<u8"), memoryview(b"".join(parts)))

    def to_bytes(self) -> bytes:
        return b"".join([struct.pack("<QQ", len(self.ends), len(self.data)), self.before.tobytes(), self.ends.tobytes(), self.ranks.tobytes(), self.data])

    @classmethod
    def from_bytes(cls, n: int, data: memoryview) -> tuple[Plane, int]:
        """The plane at the start of ``data``, whose chunks stay closed, and its size in bytes."""
        chunks, size = struct.unpack_from("<QQ", data)
        at = 16
        before = np.frombuffer(data, "<u8", chunks + 1, at)
        ends = np.frombuffer(data, "<u8", chunks, at + before.nbytes)
        ranks = np.frombuffer(data, "<u2", chunks * (CHUNK // BLOCK), at + before.nbytes + ends.nbytes)
        at += before.nbytes + ends.nbytes + ranks.nbytes
        return cls(n, before, ranks, ends, data[at : at + size]), at + size

    def chunk(self, k: int) -> np.ndarray:
        if k not in self.open:
            start = int(self.ends[k - 1]) if k else 0
            self.open[k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(self.data[start : int(self.ends[k])])), np.uint8)
        return self.open[k]

    @property
    def total(self) -> int:
        return int(self.before[-1])

    def bit(self, at: int) -> int:
        k, inside = divmod(at, CHUNK)
        return int(self.chunk(k)[inside >> 3]) >> (inside & 7) & 1

    def ones(self, at: int) -> int:
        """1 bits before position ``at``."""
        k, inside = divmod(at, CHUNK)
        if not inside:
            return int(self.before[k])
        block, rest = divmod(inside, BLOCK)
        count = int(self.before[k]) + int(self.ranks[k * (CHUNK // BLOCK) + block])
        if not rest:
            return count
        chunk, start = self.chunk(k), block * (BLOCK // 8)
        whole, odd = divmod(rest, 8)
        count += int(np.bitwise_count(chunk[start : start + whole]).sum())
        return count + (int(chunk[start + whole] & ((1 << odd) - 1)).bit_count() if odd else 0)

    def ones_at(self, at: np.ndarray) -> np.ndarray:
        """1 bits before each position; opens their chunks only."""
        k, inside = np.divmod(at, CHUNK)
        count = self.before.astype(np.int64)[k]
        if len(some := np.flatnonzero(inside)):
            block, rest = np.divmod(inside[some], BLOCK)
            count[some] += self.ranks[k[some] * (CHUNK // BLOCK) + block]
            chunks, which = np.unique(k[some], return_inverse=True)
            words = np.concatenate([self.chunk(int(c)) for c in chunks]).view("<u8").reshape(len(chunks), CHUNK // BLOCK, BLOCK // 64)[which, block]
            cut = 64 - np.clip(rest[:, None] - np.arange(0, BLOCK, 64), 0, 64)
            full = np.where(cut < 64, np.uint64(2**64 - 1) >> np.minimum(cut, 63).astype(np.uint64), np.uint64(0))
            count[some] += np.bitwise_count(words & full).sum(axis=1, dtype=np.int64)
        return count

    def select(self, bit: int, k: int) -> int:
        """Position of the k-th bit of that kind, from 0: chunk and block by binary search, then within the block."""
        chunks = np.arange(len(self.ends) + 1, dtype=np.int64) * CHUNK
        before = self.before.astype(np.int64) if bit else chunks - self.before.astype(np.int64)
        c = min(int(np.searchsorted(before, k, side="right")) - 1, len(self.ends) - 1)
        k -= int(before[c])
        blocks = self.ranks[c * (CHUNK // BLOCK) : (c + 1) * (CHUNK // BLOCK)].astype(np.int64)
        blocks = blocks if bit else np.arange(len(blocks)) * BLOCK - blocks
        b = int(np.searchsorted(blocks, k, side="right")) - 1
        inside = np.unpackbits(self.chunk(c)[b * (BLOCK // 8) : (b + 1) * (BLOCK // 8)], bitorder="little") == bit
        return c * CHUNK + b * BLOCK + int(np.flatnonzero(inside)[k - int(blocks[b])])


def word_of(depth: int) -> type:
    """The narrower type that holds symbols of so many bits."""
    return np.uint16 if depth <= 16 else np.uint32


def parted(x: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Symbols with bit 0, then those with bit 1. Positions are found and taken chunk by chunk: faster than x[~bit], and never an index of the whole shard in memory."""
    out = np.empty_like(x)
    lo, hi = 0, len(x) - int(np.count_nonzero(bit))
    for at in range(0, len(x), CHUNK):
        own, b = x[at : at + CHUNK], bit[at : at + CHUNK]
        down, ups = np.flatnonzero(~b), np.flatnonzero(b)
        out[lo : lo + len(down)], out[hi : hi + len(ups)] = own.take(down), own.take(ups)
        lo, hi = lo + len(down), hi + len(ups)
    return out


class WaveletMatrix:
    """Bit-planes from the highest bit down. Below a plane, symbols with bit 0 come before those with bit 1, each in their order. An empty sequence has planes without bits."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes, self.depth = n, planes, len(planes)
        self.zeros = [n - p.total for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        x = np.asarray(ids, dtype=np.uint32)
        depth = max(1, int(x.max()).bit_length()) if len(x) else 1
        x = x.astype(word_of(depth), copy=False)
        planes = []
        for level in range(depth - 1, -1, -1):
            bit = (x & x.dtype.type(1 << level)).astype(bool)
            planes.append(Plane.of(bit))
            if level:
                x = parted(x, bit)
        return cls(len(ids), planes)

    def decode(self) -> np.ndarray:
        """The whole sequence, undoing the partitions from the lowest plane up."""
        x = np.zeros(self.n, dtype=word_of(self.depth))
        for level in range(self.depth - 1, -1, -1):
            plane, up, one = self.planes[level], np.empty_like(x), x.dtype.type(1 << (self.depth - 1 - level))
            lo, hi = 0, self.zeros[level]
            for k, at in enumerate(range(0, self.n, CHUNK)):
                own = up[at : at + CHUNK]
                bit = np.unpackbits(plane.chunk(k), count=len(own), bitorder="little").view(bool)
                down, ups = np.flatnonzero(~bit), np.flatnonzero(bit)
                own[down], own[ups] = x[lo : lo + len(down)], x[hi : hi + len(ups)] | one
                lo, hi = lo + len(down), hi + len(ups)
            x = up
        return x.astype(np.uint32, copy=False)

    def access(self, at: int) -> int:
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.bit(at), plane.ones(at)
            at = zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``end`` stand below the last plane."""
        lo, hi = 0, end
        if value < 0 or value >> self.depth:
            return 0, 0
        for level, plane in enumerate(self.planes):
            a, b = plane.ones(lo), plane.ones(hi)
            if value >> (self.depth - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, value: int, end: int) -> int:
        """Occurrences of ``value`` before position ``end``."""
        lo, hi = self._range(value, end)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def first_counts(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often the symbol at each start occurs from there up to each end: an access and two ranks, level by level for all at once, from the rank directory."""
        lo, hi = starts.astype(np.int64), ends.astype(np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            a, b, after = np.split(plane.ones_at(np.concatenate([lo, hi, lo + 1])), 3)
            up = after > a
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence, from 0."""
        lo, hi = self._range(value, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in range(self.depth - 1, -1, -1):
            wanted = value >> (self.depth - 1 - level) & 1
            at = self.planes[level].select(wanted, at - self.zeros[level] if wanted else at)
        return at

    def positions(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def to_bytes(self) -> bytes:
        return b"".join([struct.pack("<QI", self.n, self.depth), *(p.to_bytes() for p in self.planes)])

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> WaveletMatrix:
        data = memoryview(data)
        n, depth = struct.unpack_from("<QI", data)
        at, planes = 12, []
        for _ in range(depth):
            plane, size = Plane.from_bytes(n, data[at:])
            planes.append(plane)
            at += size
        return cls(n, planes)


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A shard file: magic, documents, their ids (a byte tells null), lengths, then the wavelet matrix of all their tokens."""
    head = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes() + bytes(d is None for d in doc_ids) + np.array(lengths, dtype="<u4").tobytes()
    head = zstandard.ZstdCompressor(level=1).compress(head)
    return MAGIC + struct.pack("<QQ", len(doc_ids), len(head)) + head + WaveletMatrix.build(ids).to_bytes()


def read_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet shard")
    n, size = struct.unpack_from("<QQ", data, 8)
    head = zstandard.ZstdDecompressor().decompress(data[24 : 24 + size])
    ids, null = np.frombuffer(head, "<i8", n), head[8 * n : 9 * n]
    lengths = np.frombuffer(head, "<u4", n, 9 * n)
    return [None if x else int(d) for d, x in zip(ids, null, strict=True)], lengths, WaveletMatrix.from_bytes(memoryview(data)[24 + size :])


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, shard_text_bytes: int = 8 << 20, shard_tokens: int = 4_000_000) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into shard files in the shared folder; return the table of files.

    Documents are dealt by range of (doc_id, hash of the text), so that one
    doc_id on many rows is split as well. A task holds one shard: it begins
    another file after ``shard_tokens``. Each file is the ``data`` of one row;
    Spark's committer writes it, so a lost executor leaves no half file.
    Null texts count as empty, null doc_ids come first, equal doc_ids are in
    order of a hash of their texts, repeated rows stay repeated, an empty table
    has no files, other columns are not read.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.withColumn("tie", F.xxhash64("text"))
    docs = docs.repartitionByRange(max(1, math.ceil(total / shard_text_bytes)), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        lengths: list[int] = []
        kept: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            data = shard_bytes(ids, lengths, np.concatenate(kept))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([held], pa.int64()), pa.array([data], pa.binary())], ["part", "seq", "n_docs", "n_tokens", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            flat, sizes = words.column(batch.column(1), end_id)
            for doc, n, own in zip(batch.column(0).to_pylist(), sizes.tolist(), np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
                ids.append(doc)
                lengths.append(n)
                kept.append(own)
                held += n
                if held >= shard_tokens:
                    yield shard()
                    seq, ids, lengths, kept, held = seq + 1, [], [], [], 0
        if ids:
            yield shard()
        ids, lengths, kept = [], [], []
        give_back()

    return materialize(docs.mapInArrow(encode, BLOB), "wavelet", "uncompressed")


def read_back(files: DataFrame) -> DataFrame:
    """Per document, from the files alone: its ids' start, number and crc32, and how often its first id occurs in it.

    Starts are summed per group of parts first, so no task sees all shards. An
    empty table of files gives an empty result.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()  # the words of the workers that have encoded
        give_back()
        for batch in batches:
            for part, seq, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                docs, lengths, matrix = read_shard(data.as_py())
                ids = matrix.decode().astype("<u4", copy=False)
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(docs)
                again = np.where(lengths > 0, matrix.first_counts(np.minimum(starts, max(0, matrix.n - 1)), ends) if matrix.n else 0, 0)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(starts), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64()), pa.array(again.astype(np.int64))], ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32", "first_id_count"])

    small_batches(files.sparkSession)
    docs = files.select("part", "seq", "data").mapInArrow(decode, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long, first_id_count long")
    sizes = files.select("part", "seq", F.floor(F.col("part") / 1024).alias("group"), "n_tokens")
    upto = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = sizes.groupBy("group").agg(F.sum("n_tokens").alias("n_tokens")).select("group", upto(Window.orderBy("group")).alias("_before"))  # a row per thousand parts
    starts = sizes.withColumn("_own", upto(Window.partitionBy("group").orderBy("part", "seq"))).join(groups, "group").select("part", "seq", (F.col("_before") + F.col("_own")).alias("before"))
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "first_id_count")


def op2_wavelet_tokens(spark, sf_dir: str) -> DataFrame:
    """All documents' ids with their end id, through the shard files. Nulls, ties and repeated rows as in ``write_shards``."""
    return read_back(write_shards(documents(spark, sf_dir), default_path(), 2))
