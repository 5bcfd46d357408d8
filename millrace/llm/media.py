"""Media columns: Netpbm and BMP to numpy arrays, area resizing by integral images, NPY tiles and difference hashes."""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import documents, materialize, small_batches


def _netpbm_numbers(data: bytes, count: int) -> tuple[list[int], int]:
    """The header's numbers after the magic, past comments; the position after the one white space that ends them."""
    found, at = [], 2
    while len(found) < count:
        while at < len(data) and (data[at : at + 1].isspace() or data[at] == 35):
            at = data.index(b"\n", at) + 1 if data[at] == 35 else at + 1
        start = at
        while at < len(data) and data[at : at + 1].isdigit():
            at += 1
        if start == at:
            raise ValueError("a Netpbm header lacks a number")
        found.append(int(data[start:at]))
    return found, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6: height x width, for pixmaps x 3; bits as 0 (white) and 1, else samples of 8 or 16 bits."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not Netpbm")
    bitmap, depth = kind in (b"P1", b"P4"), 3 if kind in (b"P3", b"P6") else 1
    numbers, at = _netpbm_numbers(data, 2 if bitmap else 3)
    width, height = numbers[:2]
    most = 1 if bitmap else numbers[2]
    if kind == b"P4":
        rows = np.frombuffer(data, np.uint8, height * (-(-width // 8)), at).reshape(height, -1)
        return np.unpackbits(rows, axis=1)[:, :width]
    if kind == b"P1":
        x = np.frombuffer(data[at - 1 :].translate(None, b" \t\r\n\v\f"), np.uint8)[: width * height] - 48
    elif kind in (b"P2", b"P3"):
        x = np.array(data[at - 1 :].split()[: width * height * depth], dtype=np.uint16)
    else:
        x = np.frombuffer(data, np.uint8 if most < 256 else ">u2", width * height * depth, at)
    x = x.astype(np.uint8 if most < 256 else np.uint16, copy=False)
    return x.reshape((height, width, 3) if depth == 3 else (height, width))


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 8 (palette), 24 or 32 bits a pixel; grey palettes give height x width, others x 3 (RGB)."""
    if data[:2] != b"BM":
        raise ValueError("not BMP")
    at, head, width, height, _, bits, packed = struct.unpack_from("<I", data, 10) + struct.unpack_from("<IiiHHI", data, 14)
    if packed or bits not in (8, 24, 32):
        raise ValueError(f"BMP of {bits} bits, compression {packed}")
    row = (width * bits + 31) // 32 * 4
    x = np.frombuffer(data, np.uint8, row * abs(height), at).reshape(abs(height), row)[:, : width * bits // 8]
    x = x[::-1] if height > 0 else x
    if bits == 8:
        used = struct.unpack_from("<I", data, 46)[0] or 256
        palette = np.zeros((256, 3), np.uint8)
        palette[:used] = np.frombuffer(data, np.uint8, 4 * used, 14 + head).reshape(-1, 4)[:, 2::-1]
        return palette[:, 0][x] if (palette == palette[:, :1]).all() else palette[x]
    return x.reshape(abs(height), width, bits // 8)[:, :, 2::-1]


def decode_image(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(pixels: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def area_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each cell's exact area, read off the integral image at fractional corners; float64, channels kept."""
    x = pixels.astype(np.float64)
    table = np.zeros((x.shape[0] + 1, x.shape[1] + 1, *x.shape[2:]))
    np.cumsum(x, axis=0, out=table[1:, 1:])
    np.cumsum(table[1:, 1:], axis=1, out=table[1:, 1:])

    def at(table: np.ndarray, n: int) -> np.ndarray:
        edge = np.linspace(0, table.shape[0] - 1, n + 1)
        low = np.minimum(edge.astype(int), table.shape[0] - 2)
        part = (edge - low).reshape(-1, *[1] * (table.ndim - 1))
        return table[low] * (1 - part) + table[low + 1] * part

    grid = np.swapaxes(at(np.swapaxes(at(table, height), 0, 1), width), 0, 1)
    cells = grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]
    return cells / (x.shape[0] / height * (x.shape[1] / width))


def difference_hash(pixels: np.ndarray) -> str:
    """64 bits: whether each of 8 x 9 area means is below its right neighbour (a millionth apart at least); as hex."""
    small = area_resize(pixels if pixels.ndim == 2 else pixels.mean(axis=2), 8, 9)
    return np.packbits(small[:, 1:] > small[:, :-1] + 1e-6).tobytes().hex()


def npy_bytes(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(tile), version=(1, 0))
    return out.getvalue()


def tiles(pixels: np.ndarray, side: int) -> list[bytes]:
    """NPY files of ``side`` x ``side`` squares in row order, those at the edge smaller."""
    return [npy_bytes(pixels[y : y + side, x : x + side]) for y in range(0, pixels.shape[0], side) for x in range(0, pixels.shape[1], side)]


def media_features(media: DataFrame, side: int = 32) -> DataFrame:
    """Per row of (doc_id, media): decoded shape, an NPY tile of ``side`` x ``side`` area means, and the difference hash.

    A null or broken medium gives nulls with the error's text, never a failed job.
    """
    small_batches(media.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    pixels = decode_image(data or b"")
                    tile = npy_bytes(np.rint(area_resize(pixels, side, side)).astype(pixels.dtype))
                    rows.append((doc, pixels.shape[0], pixels.shape[1], tile, difference_hash(pixels), None))
                except (ValueError, IndexError, struct.error) as e:
                    rows.append((doc, None, None, None, None, str(e)))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)], ["doc_id", "height", "width", "tile", "dhash", "error"])

    return media.select("doc_id", "media").mapInArrow(read, "doc_id long, height int, width int, tile binary, dhash string, error string")


def store_texts(docs: DataFrame, width: int = 64) -> DataFrame:
    """Texts (null: empty) as grey 8-bit pictures ``width`` wide, in the shared folder: UTF-8, padded by 0 to whole rows, one at least."""
    small_batches(docs.sparkSession)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for text in batch.column(1).to_pylist():
                data = (text or "").encode()
                sizes.append(len(data))
                data += bytes(max(width, -(-len(data) // width) * width) - len(data))
                media.append(encode_pgm(np.frombuffer(data, np.uint8).reshape(-1, width)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(docs.mapInArrow(draw, "doc_id long, n_bytes long, media binary"), "media")


def digests(stored: DataFrame) -> DataFrame:
    """Per stored picture: digests of the pixels read back and of the file, the difference hash and the digest of a 16 x 16 NPY tile, written to the shared folder and read back."""
    small_batches(stored.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for data in batch.column(2).to_pylist():
                pixels = decode_image(data)
                payload = pixels.tobytes()
                tile = npy_bytes(np.rint(area_resize(pixels, 16, 16)).astype(np.uint8))
                row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), difference_hash(pixels), tile)
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile"]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    tiled = materialize(stored.mapInArrow(read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"), "tiles")
    return tiled.select(*tiled.columns[:-1], F.crc32("tile").alias("tile_crc32"))


def op3_media(spark, sf_dir: str) -> DataFrame:
    """Repeated rows stay repeated; null doc_ids stay null; an empty table gives an empty result."""
    return digests(store_texts(documents(spark, sf_dir)))
