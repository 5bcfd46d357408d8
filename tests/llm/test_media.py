import hashlib
import io
import struct
import zlib
from pathlib import Path

import numpy as np
import pytest

from millrace.llm import media
from millrace.operators.tables import shared_dir
from tests.llm.conftest import SF, make


def bmp(pixels, bits=24, top_down=False):
    h, w = pixels.shape[:2]
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if bits == 8 else b""
    rows = [r[..., ::-1].tobytes() if bits == 24 else r.tobytes() for r in (pixels if top_down else pixels[::-1])]
    data = b"".join(r + bytes(-len(r) % 4) for r in rows)
    at = 54 + len(palette)
    return b"BM" + struct.pack("<IHHIIiiHHIIiiII", at + len(data), 0, 0, at, 40, w, -h if top_down else h, 1, bits, 0, len(data), 0, 0, 0, 0) + palette + data


def test_decoders():
    rng = np.random.default_rng(1)
    grey, colour, bits = rng.integers(0, 256, (5, 7), dtype=np.uint8), rng.integers(0, 256, (5, 7, 3), dtype=np.uint8), rng.integers(0, 2, (5, 11), dtype=np.uint8)
    assert (media.decode_image(media.encode_pgm(grey)) == grey).all()
    assert (media.decode_image(b"P6 # colour\n7 5\n# more\n255\n" + colour.tobytes()) == colour).all()
    assert (media.decode_image(b"P4\n11 5\n" + np.packbits(bits, axis=1).tobytes()) == bits).all()
    assert (media.decode_image(b"P1\n11 5\n" + b"\n".join(b" ".join(b"%d" % x for x in r) for r in bits)) == bits).all()
    assert (media.decode_image(b"P2\n7 5\n255\n" + b" ".join(b"%d" % x for x in grey.ravel())) == grey).all()
    assert (media.decode_image(b"P3\n7 5\n255\n" + b" ".join(b"%d" % x for x in colour.ravel())) == colour).all()
    wide = rng.integers(0, 65536, (4, 3), dtype=np.uint16)
    assert (media.decode_image(b"P5\n3 4\n65535\n" + wide.astype(">u2").tobytes()) == wide).all()
    for top_down in (False, True):
        assert (media.decode_image(bmp(colour, 24, top_down)) == colour).all()
        assert (media.decode_image(bmp(grey, 8, top_down)) == grey).all()
    for broken in (b"", b"P5\n3", b"GIF", b"P5\n9 9\n255\nxx"):
        with pytest.raises((ValueError, IndexError, struct.error)):
            media.decode_image(broken)


def test_area_resize_is_the_mean_of_each_cell():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 256, (12, 18)).astype(np.uint8)
    assert np.allclose(media.area_resize(x, 4, 6), x.reshape(4, 3, 6, 3).mean(axis=(1, 3)))
    up = np.kron(x, np.ones((5, 7)))
    assert np.allclose(media.area_resize(x, 5, 7), up.reshape(5, 12, 7, 18).mean(axis=(1, 3)))
    assert np.allclose(media.area_resize(np.full((1, 64), 9), 8, 9), 9)


def test_tiles_are_npy_files():
    x = np.arange(35).reshape(5, 7)
    parts = [np.load(io.BytesIO(t)) for t in media.tiles(x, 3)]
    assert (np.vstack([np.hstack(parts[i : i + 3]) for i in (0, 3)]) == x).all()


def brute(doc, text):
    data = (text or "").encode()
    padded = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
    return doc, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])


def test_op3_equals_brute_force(spark, texts):
    got = media.op3_media(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute(*x) for x in texts)
    for r in got[:20]:
        text = dict(texts)[r.doc_id]
        data = (text or "").encode()
        data += bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        stored = b"P5\n64 %d\n255\n" % (len(data) // 64) + data
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())


def test_odd_rows(spark, odd, odd_rows, empty):
    got = [tuple(r)[:5] for r in media.digests(media.store_texts(odd)).collect()]
    assert sorted(got, key=str) == sorted((brute(*x) for x in odd_rows), key=str)
    assert media.digests(media.store_texts(empty)).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"P5\n9 9\n255\nxx")), (2, None), (3, bytearray(media.encode_pgm(np.eye(4, dtype=np.uint8))))], "doc_id long, media binary")
    rows = {r.doc_id: r for r in media.media_features(broken).collect()}
    assert rows[1].error and rows[2].error and rows[3].error is None and rows[3].dhash


def test_tiles_are_written(spark):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "millrace"
    before = set(folder.glob("tiles-*"))
    texts = {1: "some text " * 200, 2: None}
    got = {r.doc_id: r for r in media.digests(media.store_texts(make(spark, texts.items()))).collect()}
    (new,) = set(folder.glob("tiles-*")) - before
    for r in spark.read.parquet(str(new)).collect():
        data = (texts[r.doc_id] or "").encode()
        data += bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        pixels = np.frombuffer(data, np.uint8).reshape(-1, 64)
        tile = np.load(io.BytesIO(bytes(r.tile)))
        assert tile.shape == (16, 16) and (tile == np.rint(media.area_resize(pixels, 16, 16))).all()
        assert got[r.doc_id].tile_crc32 == zlib.crc32(bytes(r.tile))
