"""Packing: first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents."""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import documents, small_batches
from millrace.llm.wordids import default_path, word_ids

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Bins:
    """Bins of one capacity; the tree's inner nodes hold the largest room below them, so the first bin that fits takes log(bins) steps."""

    def __init__(self, capacity: int, most: int):
        self.size = 1 << max(0, (max(1, most) - 1).bit_length())
        self.room = [capacity] * (2 * self.size)

    def put(self, length: int) -> tuple[int, int]:
        """Index of the first bin with room, and the room it had."""
        room, at = self.room, 1
        while at < self.size:
            at *= 2
            if room[at] < length:
                at += 1
        had = room[at]
        room[at], found = had - length, at - self.size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return found, had


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, longest first, ties by position. No length may exceed the capacity."""
    bins, out = Bins(capacity, len(lengths)), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found, had = bins.put(lengths[i])
        out[i] = found, capacity - had
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, group_pieces: int = 2000, seed: int = 8) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in sequences of at most ``capacity`` tokens.

    Documents are encoded where they are read; only the pieces' lengths are
    shuffled. A document over the capacity is cut into full pieces and a rest.
    A piece's group is drawn by a seeded hash of its document, its text, its
    start and of how often its task met the same document before, so neither
    repeated rows nor long documents gather in one group: groups have about
    ``group_pieces`` pieces, and their number follows the bytes of text.
    sequence_id is group * 2^32 + bin. Null texts count as empty (one piece with
    the end id); repeated rows are packed each; null doc_ids stay null; equal
    lengths go in order of doc_id, start and crc; an empty table gives an empty
    result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    # a token has two bytes at least in all but odd texts; more pieces only make larger groups
    groups = max(1, math.ceil((n + (size or 0) / (2 * capacity)) / group_pieces))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer), struct.pack("<I", end_id)
        met: Counter[tuple] = Counter()
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = words.ids(text) + end
                n = len(own) // 4
                again = met[doc, key]
                met[doc, key] += 1
                for start in range(0, n, capacity):
                    piece = own[4 * start : 4 * (start + capacity)]
                    drawn = hashlib.blake2b(f"{seed} {doc} {key} {again} {start}".encode(), digest_size=8).digest()
                    for c, x in zip(cols, (int.from_bytes(drawn, "little") % groups, doc, start, len(piece) // 4, zlib.crc32(piece), n), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["grp", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    def fill(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        placed, group = first_fit_decreasing(table["length"].to_pylist(), capacity), table["grp"][0].as_py()
        seq, offset = pa.array([(group << 32) + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())
        return table.drop_columns(["grp"]).append_column("sequence_id", seq).append_column("offset", offset)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    pieces = texts.mapInArrow(cut, "grp long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    return pieces.groupBy("grp").applyInArrow(fill, PIECE)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens. Nulls, ties and repeated rows as in ``pack``."""
    return pack(documents(spark, sf_dir), default_path())
