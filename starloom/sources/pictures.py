"""PNG and TIFF of display images as binary columns, and files from binary columns; decoders are in pictures_read."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def png(image: np.ndarray) -> bytes:
    """8-bit gray (H, W) or RGB (H, W, 3)."""
    rows = image.astype(np.uint8).reshape(image.shape[0], -1)
    raw = b"".join(b"\0" + r.tobytes() for r in rows)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def tiff(image: np.ndarray) -> bytes:
    """16-bit little-endian gray or RGB in one strip."""
    h, w = image.shape[:2]
    n = 3 if image.ndim == 3 else 1
    body = image.astype("<u2").tobytes()
    tags = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, n, 16), (259, 3, 1, 1), (262, 3, 1, 2 if n == 3 else 1), (273, 4, 1, 8), (277, 3, 1, n), (278, 4, 1, h), (279, 4, 1, len(body))]
    start = 8 + len(body) + len(body) % 2
    after = start + 2 + 12 * len(tags) + 4
    out = struct.pack("<H", len(tags))
    for tag, kind, count, value in tags:
        out += struct.pack("<HHII", tag, kind, count, after if tag == 258 and n == 3 else value)
    tail = struct.pack("<I", 0) + (struct.pack("<3H", 16, 16, 16) if n == 3 else b"")
    return b"II*\0" + struct.pack("<I", start) + body + b"\0" * (len(body) % 2) + out + tail


def encoded(images: DataFrame, keys: list[str], channels: list[str], kind: str = "png") -> DataFrame:
    """keys, content of image rows whose channel arrays hold values in [0, 1]; PNG has 8 bits, TIFF 16, truncated."""
    if kind not in ("png", "tiff"):
        raise ValueError(f"unknown format {kind}")

    @F.pandas_udf("binary")
    def build(height: pd.Series, width: pd.Series, *arrays: pd.Series) -> pd.Series:
        levels, write = (255, png) if kind == "png" else (65535, tiff)
        out = []
        for i, (h, w) in enumerate(zip(height, width)):
            own = [np.trunc(np.clip(np.asarray(a.iloc[i], float), 0, 1) * levels).reshape(int(h), int(w)) for a in arrays]
            out.append(write(own[0] if len(own) == 1 else np.stack(own, axis=-1)))
        return pd.Series(out)

    return images.select(*keys, build("height", "width", *channels).alias("content"))


def write_files(contents: DataFrame, folder: str, name: Column) -> int:
    """Write each row's content to folder/name in the task that holds the row; returns the number of files.

    folder is a path or an address that pyarrow's file systems know, in a place that all nodes share. A file is written
    under a name of the attempt's own and renamed when it is whole, so a task that fails leaves no half file under its
    name, and one that runs twice gives the same file.
    """
    address = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(address)
        target.create_dir(root)
        for b in batches:
            for n, content in zip(b.column(0).to_pylist(), b.column(1)):
                folder_of, _, last = f"{root}/{n}".rpartition("/")
                own = f"{folder_of}/._{uuid.uuid4().hex}-{last}"
                target.create_dir(folder_of)
                try:
                    with target.open_output_stream(own) as out:
                        out.write(content.as_buffer())
                    target.move(own, f"{root}/{n}")
                finally:
                    if target.get_file_info(own).type == fs.FileType.File:
                        target.delete_file(own)
            yield pa.RecordBatch.from_arrays([pa.array([len(b)], pa.int64())], ["n"])

    rows = contents.select(name.alias("name"), "content").mapInArrow(write, "n long")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
