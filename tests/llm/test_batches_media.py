"""Media columns: lossless round trips, damage, all filters, defined edge cases."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import media


@given(st.binary(max_size=3000))
@settings(max_examples=60, deadline=None)
def test_png_gives_the_payload_back(data):
    payload = media.pad(data)
    image, n = media.decode_png(media.encode_png(payload, len(data)))
    assert len(payload) % media.ROW == 0 and len(payload) >= media.ROW
    assert image.tobytes() == payload and n == len(data) and payload[:n] == data


def test_every_filter_is_undone():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (10, 30), dtype=np.uint8)
    rows = np.zeros((10, 31), np.uint8)
    for y in range(10):
        kind = rows[y, 0] = y % 5
        for x in range(30):
            a = int(image[y, x - 1]) if x else 0
            b = int(image[y - 1, x]) if y else 0
            c = int(image[y - 1, x - 1]) if x and y else 0
            p = a + b - c
            paeth = min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]
            rows[y, x + 1] = (int(image[y, x]) - (0, a, b, (a + b) // 2, paeth)[kind]) & 255
    assert (media.unfilter(rows) == image).all()


def test_damage_is_found():
    data = bytearray(media.encode_png(media.pad(b"abc" * 500), 1500))
    for at in (3, 20, 60, len(data) - 5):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises((ValueError, zlib.error, struct.error)):
            media.decode_png(bytes(broken))
    with pytest.raises(ValueError):
        media.decode_png(bytes(data[:-6]))


def test_hash_is_stable_under_small_changes():
    rng = np.random.default_rng(0)
    smooth = np.kron(rng.integers(40, 216, (8, 8)), np.ones((8, 72)))
    noisy = np.clip(smooth + rng.normal(0, 2, smooth.shape), 0, 255)
    a, b = (int(media.cosine_hash(x.astype(np.uint8)), 16) for x in (smooth, noisy))
    assert bin(a ^ b).count("1") <= 4 and media.cosine_hash(np.zeros((1, 576), np.uint8)) == media.cosine_hash(np.zeros((1, 576), np.uint8))


def test_texts_of_all_kinds(spark):
    long = "é" * 200_000
    rows = [(1, "abc", "x"), (1, "abc", "x"), (None, None, None), (2, "", "y"), (3, long, "z"), (4, None, "media")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, media string")
    found = sorted(media.text_media(docs).collect(), key=lambda r: (r.id is None, r.id or 0))
    assert [r.id for r in found] == [1, 1, 2, 3, 4, None]
    for r, text in zip(found, ["abc", "abc", "", long, "", ""], strict=True):
        payload = media.pad(text.encode())
        assert (r.n_bytes, r.payload_bytes) == (len(text.encode()), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
    assert found[0] == found[1] and found[2].media_sha256 == found[5].media_sha256


def plain_png(data):
    """A PNG's samples by the format's own words, byte by byte."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, parts = 8, []
    while at < len(data):
        size, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        assert int.from_bytes(data[at + 8 + size : at + 12 + size], "big") == zlib.crc32(data[at + 4 : at + 8 + size])
        parts.append((kind, data[at + 8 : at + 8 + size]))
        at += 12 + size
    assert [k for k, _ in parts][0] == b"IHDR" and parts[-1] == (b"IEND", b"")
    width, height = struct.unpack(">II", parts[0][1][:8])
    raw, rows = zlib.decompress(b"".join(b for k, b in parts if k == b"IDAT")), []
    for y in range(height):
        kind, line = raw[y * (width + 1)], bytearray(raw[y * (width + 1) + 1 : (y + 1) * (width + 1)])
        for x in range(width):
            line[x] = (line[x] + {0: 0, 1: line[x - 1] if x else 0, 2: rows[-1][x] if rows else 0}[kind]) & 255
        rows.append(bytes(line))
    return width, rows


def plain_hash(width, rows):
    """The hash by sums: averages over a 32 x 32 grid, then each low frequency as a double sum of cosines."""
    from fractions import Fraction
    from math import cos, pi
    from statistics import median

    def cells(size):
        out = []
        for i in range(32):
            a, b = Fraction(i * size, 32), Fraction((i + 1) * size, 32)
            out.append([(s, float(min(b, s + 1) - max(a, s)) * 32 / size) for s in range(int(a), size) if min(b, s + 1) > max(a, s)])
        return out

    across, down = cells(width), cells(len(rows))
    narrow = [[sum(row[s] * w for s, w in c) for c in across] for row in rows]
    small = [[sum(narrow[s][x] * w for s, w in c) for x in range(32)] for c in down]
    low = [sum(small[y][x] * cos(pi * u * (2 * y + 1) / 64) * cos(pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for u in range(8) for v in range(8)]
    middle = median(low)
    return low, middle


def test_stored_media_by_a_plain_reading(spark):
    texts = ["", "short", "the same line\n" * 200, "é ü 日本 " * 300, " ".join(str(i * i) for i in range(900))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    stored = {r.id: bytes(r.media) for r in media.store_media(docs).collect()}
    described = {r.id: r for r in media.text_media(docs).collect()}
    for i, text in enumerate(texts):
        width, rows = plain_png(stored[i])
        payload = b"".join(rows)
        data = text.encode()
        assert width == 576 and payload == data + b"\xff" * (len(payload) - len(data)) and 0 <= len(payload) - len(data) <= 576
        assert described[i].media_bytes == len(stored[i]) and described[i].media_sha256 == hashlib.sha256(stored[i]).hexdigest()
        low, middle = plain_hash(width, rows)
        bits = f"{int(described[i].feature, 16):064b}"
        assert all((x > middle) == (b == "1") for x, b in zip(low, bits, strict=True) if abs(x - middle) > 1e-4)


def test_empty_table(spark):
    assert media.text_media(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
