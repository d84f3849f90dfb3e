"""PNG and TIFF files as rows: every filter, depth and palette of PNG, strips and tiles of TIFF in the usual compressions."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Channels by PNG colour type (gray, RGB, palette, gray + alpha, RGBA); sizes of TIFF's field types.
PNG_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
TIFF_FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def unfiltered(rows: np.ndarray, filters: np.ndarray, step: int) -> np.ndarray:
    """Bytes of PNG rows without their filters: 0 none, 1 left, 2 above, 3 their mean, 4 the nearest of three.

    A sample needs those to its left and above, so all samples of one diagonal are done at once.
    """
    height = len(rows)
    own = rows.reshape(height, -1, step).astype(np.int16)
    width = own.shape[1]
    out = np.zeros((height + 1, width + 1, step), np.int16)
    if not filters.any():
        return rows
    for d in range(width + height - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, above, corner = out[y + 1, x], out[y, x + 1], out[y, x]
        kind = filters[y, None]
        guess = left + above - corner
        a, b, c = np.abs(guess - left), np.abs(guess - above), np.abs(guess - corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        add = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, above, (left + above) // 2, nearest], 0)
        out[y + 1, x + 1] = (own[y, x] + add) & 255
    return out[1:, 1:].reshape(height, -1).astype(np.uint8)


def samples(rows: np.ndarray, depth: int, count: int, order: str = ">") -> np.ndarray:
    """The first `count` samples of each row of bytes, of 1 to 16 bits."""
    if depth == 16:
        return np.ascontiguousarray(rows[:, : 2 * count]).view(f"{order}u2").astype(np.uint16)
    if depth == 8:
        return rows[:, :count]
    bits = np.unpackbits(rows, axis=1)[:, : count * depth].reshape(len(rows), count, depth)
    return (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(axis=2).astype(np.uint8)


def read_png(raw: bytes) -> tuple[np.ndarray, int]:
    """(height, width, channels) of a PNG, palettes as RGB, and its depth. Interlaced files are refused."""
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, body, palette, head = 8, [], None, None
    while at + 12 <= len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        part = raw[at + 8 : at + 8 + n]
        if len(part) < n or zlib.crc32(kind + part) != struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a chunk is damaged")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    if head is None or head[3] not in PNG_CHANNELS or head[6]:
        raise ValueError("interlaced, or without a header")
    width, height, depth, colour = head[:4]
    channels = PNG_CHANNELS[colour]
    stride = -(-width * channels * depth // 8)
    data = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    if len(data) != height * (stride + 1):
        raise ValueError("the data are cut short")
    data = data.reshape(height, stride + 1)
    rows = unfiltered(data[:, 1:], data[:, 0], max(1, channels * depth // 8))
    image = samples(rows, depth, width * channels).reshape(height, width, channels)
    if colour != 3:
        return image, depth
    if palette is None or image.max(initial=0) >= len(palette):
        raise ValueError("a colour is not in the palette")
    return palette[image[:, :, 0]], 8


def unpacked_lzw(raw: bytes) -> bytes:
    """LZW as TIFF writes it: codes of 9 to 12 bits, high bits first, 256 starts over, 257 ends."""
    bits, held, at = 0, 0, 0
    table: list[bytes] = []
    size, last, out = 9, b"", []
    while True:
        while held < size:
            if at == len(raw):
                return b"".join(out)
            bits, held, at = (bits << 8 | raw[at]) & 0xFFFFFF, held + 8, at + 1
        code = bits >> (held - size) & ((1 << size) - 1)
        held -= size
        if code == 257:
            return b"".join(out)
        if code == 256:
            table, size, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code > len(table) or not table or (code == len(table) and not last):
            raise ValueError("a code is unknown")
        word = table[code] if code < len(table) else last + last[:1]
        if last:
            table.append(last + word[:1])
        out.append(word)
        last = word
        size = 9 + sum(len(table) + 1 >= n for n in (512, 1024, 2048))


def unpacked_bits(raw: bytes) -> bytes:
    """Runs as PackBits writes them."""
    out, at = [], 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out.append(raw[at + 1 : at + 2 + n])
            at += n + 2
        else:
            out.append(raw[at + 1 : at + 2] * (257 - n if n > 128 else 0))
            at += 2 if n > 128 else 1
    return b"".join(out)


UNPACK = {1: bytes, 5: unpacked_lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: unpacked_bits}


def directory(raw: bytes) -> tuple[dict[int, tuple], str]:
    """Fields of the first directory of a TIFF, and its byte order."""
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None or struct.unpack(order + "H", raw[2:4])[0] != 42:
        raise ValueError("no TIFF")
    at = struct.unpack(order + "I", raw[4:8])[0]
    fields = {}
    for i in range(struct.unpack(order + "H", raw[at : at + 2])[0]):
        tag, kind, n, where = struct.unpack(order + "HHII", raw[at + 2 + 12 * i : at + 14 + 12 * i])
        if kind in TIFF_FIELDS and kind != 2:
            size = struct.calcsize(order + TIFF_FIELDS[kind]) * n
            own = raw[where : where + size] if size > 4 else raw[at + 10 + 12 * i : at + 10 + 12 * i + size]
            fields[tag] = struct.unpack(order + TIFF_FIELDS[kind] * n, own)
    return fields, order


def read_tiff(raw: bytes) -> tuple[np.ndarray, int]:
    """(height, width, channels) of a TIFF's first image and its depth: strips or tiles, whole numbers or floats."""
    fields, order = directory(raw)
    width, height = fields[256][0], fields[257][0]
    depth, channels = fields.get(258, (1,))[0], fields.get(277, (1,))[0]
    if len(set(fields.get(258, (1,)))) > 1:
        raise ValueError("the channels differ in depth")
    packing, predictor, planar = (fields.get(t, (1,))[0] for t in (259, 317, 284))
    if packing not in UNPACK or predictor not in (1, 2):
        raise ValueError(f"compression {packing} with predictor {predictor} is not known")
    form = {1: "u", 2: "i", 3: "f"}.get(fields.get(339, (1,))[0])
    if form is None or (depth < 8 and (form, predictor) != ("u", 1)) or (depth >= 8 and (depth // 8, form) not in {(n, f) for n in (1, 2, 4, 8) for f in "ui"} | {(4, "f"), (8, "f")}):
        raise ValueError(f"samples of {depth} bits are not known")
    tiled = 322 in fields
    w, h = (fields[322][0], fields[323][0]) if tiled else (width, min(height, fields.get(278, (height,))[0]))
    starts, sizes = (fields[324], fields[325]) if tiled else (fields[273], fields[279])
    across, down = -(-width // w), -(-height // h)
    per = channels if planar == 1 else 1
    kind = np.dtype(f"{order}{form}{depth // 8}") if depth >= 8 else np.dtype(np.uint8)
    out = np.zeros((down * h, across * w, channels), kind.newbyteorder("="))
    for i, (start, size) in enumerate(zip(starts, sizes)):
        plane, place = divmod(i, across * down)
        y, x = divmod(place, across)
        rows = h if tiled else min(h, height - y * h)
        body = UNPACK[packing](raw[start : start + size])
        stride = -(-w * per * depth // 8)
        if len(body) < rows * stride:
            raise ValueError("a strip is cut short")
        part = np.frombuffer(body, np.uint8, rows * stride).reshape(rows, stride)
        part = part.view(kind) if depth >= 8 else samples(part, depth, w * per)
        part = part.reshape(rows, w, per).astype(kind.newbyteorder("="))
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=part.dtype)
        at = slice(y * h, y * h + rows), slice(x * w, x * w + w)
        out[(*at, slice(None) if planar == 1 else slice(plane, plane + 1))] = part
    out = out[:height, :width]
    if fields.get(262, (1,))[0] == 0 and form == "u":  # white is zero
        out = (1 << depth) - 1 - out
    elif fields.get(262, (1,))[0] == 3:
        colours = np.asarray(fields[320]).reshape(3, -1).T
        return colours[out[:, :, 0]], 16
    return out, depth


def read_picture(raw: bytes) -> tuple[np.ndarray, int]:
    return (read_png if raw[:1] == b"\x89" else read_tiff)(raw)


PICTURES = "path string, name string, height int, width int, channels int, depth int, data array<double>, error string"


def read_pictures(spark: SparkSession, path: str, glob: str = "*.{png,tif,tiff,PNG,TIF,TIFF}") -> DataFrame:
    """path, name, height, width, channels, depth, data (channels of a pixel together, as stored), error of the files under path.

    Spark lists and reads the files, so any store that it reaches will do; it passes over empty ones. What is damaged or not
    known gives its error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    src = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    kind = T.StructType.fromDDL(PICTURES)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, n, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                row, data = {"path": p, "name": n}, pa.array([None], pa.list_(pa.float64()))
                try:
                    image, depth = read_picture(raw.as_py())
                    row |= dict(zip(("height", "width", "channels"), image.shape)) | {"depth": depth}
                    data = pa.ListArray.from_arrays(pa.array([0, image.size], pa.int32()), pa.array(image.ravel().astype(float)))
                except (ValueError, KeyError, IndexError, struct.error, zlib.error) as e:
                    row["error"] = str(e) or type(e).__name__
                columns = [data.cast(f.type) if f.name == "data" else pa.array([row.get(f.name)], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return src.mapInArrow(run, kind)


def luminances(pictures: DataFrame) -> DataFrame:
    """path, name, height, width, data: the first channel over its greatest value (a black image stays), as pictures come."""
    first: Column = F.transform(F.sequence(F.lit(0), F.col("height") * F.col("width") - 1), lambda i: F.col("data")[i * F.col("channels")])
    own = pictures.where("error is null and height * width > 0").select("path", "name", "height", "width", first.alias("data"))
    top = F.array_max("data")
    return own.withColumn("_top", F.when(top > 0, top).otherwise(F.lit(1.0))).withColumn("data", F.transform("data", lambda v: v / F.col("_top"))).drop("_top")
