"""Media columns: lossless PNG in binary columns, checked on reading, with low-frequency cosine-transform hashes.

A payload is a multiple of ``ROW`` bytes and becomes an 8-bit grey image of ``ROW`` samples a row. The writer picks
one of the filters none, sub and up for each row; the reader tests every chunk's checksum, undoes all five filters of
the format with numpy and gives back the samples. The hash averages the image to 32 x 32, takes the two-dimensional
cosine transform and keeps the signs of its 8 x 8 lowest frequencies against their median: 64 bits.

Defined results: a null text is an empty text; an empty text is one row of padding; equal texts give equal media and
equal features; a null id stays null; rows that repeat are media of their own; an empty table gives an empty result; texts of any
length become one image, up to the format's 2^31 - 1 bytes of a chunk or row number, far beyond what a row of Spark holds; other
columns of the input are not read and may have any names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import bounded, emit
from corpusloom.session import spread, written

#: Samples a row, and the padding byte.
ROW, PAD = 576, 255
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Chunk of ours that holds the payload's length without padding.
LENGTH_CHUNK = b"nbLn"


def pad(data: bytes) -> bytes:
    """The data and bytes 255 up to a positive multiple of ROW."""
    return data + bytes([PAD]) * (-len(data) % ROW if data else ROW)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def encode_png(payload: bytes, n_bytes: int, level: int = 6) -> bytes:
    """An 8-bit grey PNG of the payload, ROW samples wide."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    left = np.zeros_like(image)
    left[:, 1:] = image[:, :-1]
    above = np.zeros_like(image)
    above[1:] = image[:-1]
    filtered = (image, image - left, image - above)
    # the usual heuristic: the filter whose residues, as signed bytes, have the least absolute sum
    costs = np.stack([np.abs(x.view(np.int8).astype(np.int16)).sum(1, dtype=np.int64) for x in filtered])
    kinds = costs.argmin(0).astype(np.uint8)
    rows = np.empty((len(image), ROW + 1), np.uint8)
    rows[:, 0] = kinds
    for k, x in enumerate(filtered):
        rows[kinds == k, 1:] = x[kinds == k]
    header = struct.pack(">IIBBBBB", ROW, len(image), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(LENGTH_CHUNK, struct.pack(">Q", n_bytes)) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def chunks(media: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Every chunk's kind and body; a broken signature, length or checksum raises ValueError."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at < len(media):
        if at + 12 > len(media):
            raise ValueError("a chunk is cut off")
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if len(body) < size or at + 12 + size > len(media):
            raise ValueError("a chunk is cut off")
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"checksum of {kind!r} differs")
        yield kind, body
        at += 12 + size
        if kind == b"IEND":
            return
    raise ValueError("no end chunk")


def unfilter(rows: np.ndarray) -> np.ndarray:
    """Undo the filters of 8-bit grey rows, whose first byte names the filter."""
    kinds, out = rows[:, 0], rows[:, 1:].copy()
    if (kinds > 4).any():
        raise ValueError("unknown filter")
    sub = kinds == 1
    out[sub] = np.cumsum(out[sub], axis=1, dtype=np.uint8)
    y = 0
    while y < len(out):  # rows that look at the row above, in runs of one filter
        if kinds[y] == 2:
            end = y + 1
            while end < len(out) and kinds[end] == 2:
                end += 1
            first = max(y - 1, 0)
            out[first:end] = np.cumsum(out[first:end], axis=0, dtype=np.uint8)
            y = end
            continue
        if kinds[y] >= 3:
            _sequential(out, y, int(kinds[y]))
        y += 1
    return out


def _sequential(out: np.ndarray, y: int, kind: int) -> None:
    """Average (3) and Paeth (4) need the sample to the left, so they go sample by sample."""
    above = out[y - 1].tolist() if y else [0] * out.shape[1]
    row, a, c = out[y].tolist(), 0, 0
    for x, b in enumerate(above):
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            guess = min((a, b, c), key=lambda v, p=p: abs(p - v))  # ties in this order
        a = row[x] = (row[x] + guess) & 255
        c = b
    out[y] = row


def decode_png(media: bytes) -> tuple[np.ndarray, int]:
    """The image of samples and the payload's length without padding."""
    header, length, data = None, None, []
    for kind, body in chunks(media):
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == LENGTH_CHUNK:
            (length,) = struct.unpack(">Q", body)
        elif kind == b"IDAT":
            data.append(body)
    if header is None or header[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only 8-bit grey images without interlace are read")
    width, height = header[:2]
    raw = zlib.decompress(b"".join(data))
    if len(raw) != height * (width + 1):
        raise ValueError("the image has another size than its header says")
    image = unfilter(np.frombuffer(raw, np.uint8).reshape(height, width + 1))
    return image, image.size if length is None else length


@cache
def _cosines(n: int, k: int) -> np.ndarray:
    return np.cos(np.pi * np.outer(np.arange(k), 2 * np.arange(n) + 1) / (2 * n))


def _means(image: np.ndarray, n: int) -> np.ndarray:
    """Averages over an n x n grid whose cells may overlap by parts of samples."""
    for axis in (0, 1):
        size = image.shape[axis]
        sums = np.concatenate([np.zeros_like(image.take([0], axis)), np.cumsum(image, axis=axis)], axis)
        edges = np.arange(n + 1) * size / n
        low = np.minimum(edges.astype(np.int64), size - 1)
        part = np.expand_dims(edges - low, 1 - axis)
        at = sums.take(low, axis) * (1 - part) + sums.take(low + 1, axis) * part
        image = np.diff(at, axis=axis) * (n / size)
    return image


def cosine_hash(image: np.ndarray) -> str:
    """64 bits of the lowest frequencies, as 16 hex digits."""
    small = _means(image.astype(np.float64), 32)
    low = np.rint(_cosines(32, 8) @ small @ _cosines(32, 8).T * 1e6)
    return np.packbits(low.ravel() > np.median(low)).tobytes().hex()


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes`` and the PNG of every text in the binary column ``media``."""
    bounded(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data = (text.as_py() or "").encode("utf-8")
                    yield key, len(data), encode_png(pad(data), len(data))

        yield from emit(rows(), pa.schema([("id", id_type), ("n_bytes", pa.int64()), ("media", pa.binary())]), lambda r: len(r[2]))

    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = plain.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    return spread(plain).mapInArrow(encode, f"id {kind.simpleString()}, n_bytes bigint, media binary")


def read_media(media: DataFrame) -> DataFrame:
    """What the stored media hold, with every checksum tested: sizes, digests, ``feature`` and its bits in ``hash``.

    A medium that is damaged fails the job; a null medium does not occur, as ``store_media`` writes none.
    """
    bounded(media.sparkSession)
    kind = media.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("id", to_arrow_type(kind)), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("hash", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for key, stored in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data = stored.as_py()
                    image, n_bytes = decode_png(data)
                    payload, feature = image.tobytes(), cosine_hash(image)
                    yield key, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, bytes.fromhex(feature)

        yield from emit(rows(), schema)

    names = ", ".join(f"{n} {t}" for n, t in zip(schema.names, (kind.simpleString(), "bigint", "bigint", "string", "bigint", "bigint", "string", "string", "binary"), strict=True))
    return media.select("id", "media").mapInArrow(decode, names)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every whole text as a PNG in a written table, read the stored bytes back and describe them."""
    return read_media(written(store_media(docs, id_col, text_col), "media"))


def columns(described: DataFrame) -> list[Column]:
    """The digest columns of the query over ``documents``."""
    return [F.col("id").alias("doc_id"), *(F.col(c) for c in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"))]
