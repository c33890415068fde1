"""Media columns: Netpbm and BMP images, decoded to numpy arrays, tiled as NPY, resized, hashed.

decode() reads P1 to P6 and uncompressed BMP of 1, 4, 8, 24 and 32 bits a pixel. area_resize() averages
over exact source areas by an integral image. difference_hash() compares neighbours of the 9 x 8 image.
npy() and from_npy() store an array of tiles. encode_media() does all of that to a column of image bytes.

A null image gives nulls; bytes that are no image of these kinds give nulls and their reason in `error`;
neither stops a job. Equal bytes give equal values. Rows are treated one by one; other columns stay,
those named like an output are replaced.
"""

from __future__ import annotations

import ast
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import map_arrow, stored
from quadrille.llm.words import utf8

TILE = 24
_TOKEN = re.compile(rb"(?:\s|#[^\r\n]*[\r\n])*([^\s#]+)")


class NotAnImage(ValueError):
    pass


def decode(data: bytes) -> np.ndarray:
    """height x width x channels (1 or 3), uint8 or uint16."""
    if data[:2] == b"BM":
        return _bmp(data)
    if data[:1] == b"P" and data[1:2] in (b"1", b"2", b"3", b"4", b"5", b"6"):
        return _netpbm(data)
    raise NotAnImage("neither Netpbm nor BMP")


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, head = int(data[1:2]), 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _TOKEN.match(data, at)
        if not m or not m[1].isdigit():
            raise NotAnImage("header")
        head.append(int(m[1]))
        at = m.end()
    w, h, top = head[0], head[1], head[2] if len(head) > 2 else 1
    planes = 3 if kind in (3, 6) else 1
    if not (w and h and 0 < top < 65536):
        raise NotAnImage("size")
    if kind in (1, 2, 3):
        body = re.sub(rb"#[^\r\n]*", b"", data[at:])
        words = list(re.sub(rb"\s", b"", body)) if kind == 1 else body.split()
        if len(words) < w * h * planes:
            raise NotAnImage("short")
        values = np.array([int(x) - 48 * (kind == 1) for x in words[: w * h * planes]])
        if values.min() < 0 or values.max() > top:
            raise NotAnImage("sample")
    elif kind == 4:
        row = (w + 7) // 8
        raw = np.frombuffer(data, np.uint8, offset=at + 1)
        if len(raw) < row * h:
            raise NotAnImage("short")
        values = np.unpackbits(raw[: row * h].reshape(h, row), axis=1)[:, :w].reshape(-1)
    else:
        each = np.dtype(">u2" if top > 255 else np.uint8)
        if len(data) < at + 1 + w * h * planes * each.itemsize:
            raise NotAnImage("short")
        values = np.frombuffer(data, each, w * h * planes, at + 1)
    if kind in (1, 4):
        values = 255 * (1 - values)  # 1 is black
    return values.astype(np.uint16 if top > 255 else np.uint8).reshape(h, w, planes)


def _bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise NotAnImage("short")
    start, size, w, h, _, bits, packed = struct.unpack_from("<4xIIiiHHI", data, 6)
    colours = struct.unpack_from("<I", data, 46)[0]
    if size < 40 or packed not in (0,) or bits not in (1, 4, 8, 24, 32) or w <= 0 or not h:
        raise NotAnImage("kind of BMP")
    row, height = (w * bits + 31) // 32 * 4, abs(h)
    if len(data) < start + row * height:
        raise NotAnImage("short")
    raw = np.frombuffer(data, np.uint8, row * height, start).reshape(height, row)
    raw = raw[::-1] if h > 0 else raw
    if bits >= 24:
        return np.ascontiguousarray(raw[:, : w * bits // 8].reshape(height, w, bits // 8)[:, :, 2::-1])
    index = raw if bits == 8 else np.unpackbits(raw, axis=1) if bits == 1 else np.stack((raw >> 4, raw & 15), axis=2).reshape(height, -1)
    table = np.frombuffer(data, np.uint8, 4 * (colours or 1 << bits), 14 + size).reshape(-1, 4)[:, 2::-1]
    if index[:, :w].max() >= len(table):
        raise NotAnImage("colour")
    return np.ascontiguousarray(table[index[:, :w]])


def pgm(samples: bytes, width: int) -> bytes:
    """A binary grey map of whole rows."""
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


def grey(image: np.ndarray) -> np.ndarray:
    return image[:, :, 0].astype(np.float64) if image.shape[2] == 1 else image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def area_resize(plane: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the areas that the new pixels cover, with fractions of source pixels at their edges."""
    sums = np.zeros((plane.shape[0] + 1, plane.shape[1] + 1))
    np.cumsum(np.cumsum(plane, axis=0, dtype=np.float64), axis=1, out=sums[1:, 1:])

    def at(edges: np.ndarray, table: np.ndarray) -> np.ndarray:
        low = np.minimum(edges.astype(np.int64), len(table) - 2)
        return table[low] + (edges - low)[:, None] * (table[low + 1] - table[low])

    ys, xs = np.linspace(0, plane.shape[0], height + 1), np.linspace(0, plane.shape[1], width + 1)
    whole = at(xs, at(ys, sums).T).T
    area = np.diff(ys)[:, None] * np.diff(xs)[None, :]
    return np.diff(np.diff(whole, axis=0), axis=1) / area


def difference_hash(plane: np.ndarray) -> str:
    """64 bits, row by row: is a pixel of the 9 x 8 image darker than its right neighbour?"""
    small = area_resize(plane, 8, 9)
    return np.packbits(small[:, 1:] > small[:, :-1] + 1e-9).tobytes().hex()


def tiles(plane: np.ndarray, tile: int = TILE, fill: int = 255) -> np.ndarray:
    """n x tile x tile, row by row of tiles; edges are filled up."""
    h, w = -(-plane.shape[0] // tile) * tile, -(-plane.shape[1] // tile) * tile
    full = np.full((h, w), fill, plane.dtype)
    full[: plane.shape[0], : plane.shape[1]] = plane
    return full.reshape(h // tile, tile, w // tile, tile).swapaxes(1, 2).reshape(-1, tile, tile)


def npy(a: np.ndarray) -> bytes:
    """NPY, version 1.0."""
    a = np.ascontiguousarray(a)
    head = repr({"descr": np.lib.format.dtype_to_descr(a.dtype), "fortran_order": False, "shape": a.shape}).encode()
    head += b" " * (-(len(head) + 11) % 64) + b"\n"
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(head)) + head + a.tobytes()


def from_npy(data: bytes) -> np.ndarray:
    if data[:8] != b"\x93NUMPY\x01\x00":
        raise NotAnImage("not NPY 1.0")
    end = 10 + struct.unpack_from("<H", data, 8)[0]
    head = ast.literal_eval(data[10:end].decode("latin1"))
    if head["fortran_order"]:
        raise NotAnImage("column order")
    return np.frombuffer(data, np.dtype(head["descr"]), offset=end).reshape(head["shape"])


def encode_media(df: DataFrame, image: str = "image", tile: int = TILE) -> DataFrame:
    """df with width, height, channels, media (NPY tiles, one plane after another), feature and error."""
    kinds = {"width": "int", "height": "int", "channels": "int", "media": "binary", "feature": "string", "error": "string"}
    kept = df.drop(*[k for k in kinds if k != image])

    def one(raw: bytes | None) -> tuple:
        if raw is None:
            return (None,) * 6
        try:
            a = decode(raw)
        except (NotAnImage, ValueError, struct.error) as e:
            return None, None, None, None, None, str(e)
        planes = np.concatenate([tiles(a[:, :, c], tile) for c in range(a.shape[2])])
        return a.shape[1], a.shape[0], a.shape[2], npy(planes), difference_hash(grey(a)), None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()]
        for b in batches:
            rows = [one(x) for x in b.column(image).to_pylist()]
            fresh = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*b.columns, *fresh], names=[*b.schema.names, *kinds])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), *(f"{k} {v}" for k, v in kinds.items())])
    return map_arrow(kept, each, schema)


def payload(text: bytes | None, unit: int = TILE * TILE) -> bytes:
    """The bytes and 255s up to a positive multiple of the unit."""
    text = text or b""
    return text + b"\xff" * (max(unit, -(-len(text) // unit) * unit) - len(text))


def text_images(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text as a grey map, TILE pixels wide, so that a tile's samples are the payload's in order."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = utf8(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([len(x or b"") for x in raw], pa.int64()), pa.array([pgm(payload(x), TILE) for x in raw], pa.binary())], names=["id", "n_bytes", "image"])

    return map_arrow(docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")), each, f"id {docs.schema[id].dataType.simpleString()}, n_bytes long, image binary")


def read_back(media: DataFrame) -> DataFrame:
    """From stored (id, n_bytes, media): what the stored bytes give."""
    columns = {"doc_id": media.schema["id"].dataType.simpleString(), "n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for m in b.column("media").to_pylist():
                stack = from_npy(m)
                raw = stack.tobytes()
                row = len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(m), hashlib.sha256(m).hexdigest(), difference_hash(stack.reshape(-1, stack.shape[2]).astype(np.float64))
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), *[pa.array(x, t) for x, t in zip(out, types, strict=True)]], names=list(columns))

    return map_arrow(media.select("id", "n_bytes", "media"), each, ", ".join(f"{k} {v}" for k, v in columns.items()))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_back(stored(encode_media(text_images(docs)).select("id", "n_bytes", "media"), "media"))
