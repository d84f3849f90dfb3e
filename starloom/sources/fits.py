"""FITS as a Spark data source: one row per image, header-only reads where the pixels are not asked for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK, CARD = 2880, 80
# Sample types of FITS by BITPIX.
KINDS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}


def header_of(raw: bytes, at: int = 0) -> tuple[dict[str, str], int]:
    """Keywords of the header at a byte offset, and where its data begin."""
    out: dict[str, str] = {}
    while at + CARD <= len(raw):
        card = raw[at : at + CARD].decode("ascii", "replace")
        at += CARD
        key = card[:8].strip()
        if key == "END":
            return out, -(-at // BLOCK) * BLOCK
        if card[8:10] == "= ":
            value = card[10:]
            if value.lstrip().startswith("'"):
                text = value.lstrip()[1:]
                end = text.find("'")
                while end >= 0 and text[end : end + 2] == "''":
                    end = text.find("'", end + 2)
                out[key] = text[: end if end >= 0 else None].replace("''", "'").rstrip()
            else:
                out[key] = value.split("/")[0].strip()
    raise ValueError("the header has no END")


def data_of(raw: bytes, header: dict[str, str], at: int) -> tuple[tuple[int, ...], np.ndarray, int]:
    """Shape (slowest axis first), scaled values and the end of the data unit; stored * BSCALE + BZERO."""
    axes = [int(header[f"NAXIS{i}"]) for i in range(int(header.get("NAXIS", 0)), 0, -1)]
    kind = np.dtype(KINDS[int(header["BITPIX"])])
    n = int(np.prod(axes)) if axes else 0
    if at + n * kind.itemsize > len(raw):
        raise ValueError("the data unit is cut short")
    stored = np.frombuffer(raw, kind, n, at).astype(float)
    value = stored * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))
    return tuple(axes), value, -(-(at + n * kind.itemsize) // BLOCK) * BLOCK


def extent(header: dict[str, str], at: int) -> tuple[tuple[int, ...], np.dtype, int]:
    """Shape (slowest axis first), sample type and the end of the data unit, from the header alone."""
    axes = tuple(int(header[f"NAXIS{i}"]) for i in range(int(header.get("NAXIS", 0)), 0, -1))
    kind = np.dtype(KINDS[int(header["BITPIX"])])
    n = int(np.prod(axes)) if axes else 0
    n = (n + int(header.get("PCOUNT", 0))) * int(header.get("GCOUNT", 1)) * kind.itemsize
    return axes, kind, -(-(at + n) // BLOCK) * BLOCK


SCHEMA = "path string, name string, height int, width int, planes int, header map<string,string>, data array<double>, error string"


def read_fits(spark: SparkSession, path: str, pixels: bool = True, hdu: int = 0) -> DataFrame:
    """path, name, height, width, planes, header, data (null if pixels is false), error for every *.fits under path.

    Files are found and read by Spark, so any store that it reaches will do; without pixels only the first megabyte of a
    file crosses to Python where the first unit is asked for, and data units are stepped over. hdu counts image units from 0. What cannot be parsed gives a row with the error instead.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.fits").load(path)
    content = F.col("content") if pixels or hdu else F.substring("content", 1, 1 << 20)
    src = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), content.alias("content"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            rows = []
            for p, n, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                row = dict.fromkeys(names) | {"path": p, "name": n}
                try:
                    at = 0
                    for k in range(hdu + 1):
                        header, start = header_of(raw, at)
                        axes, _, at = extent(header, start)
                    if pixels:
                        axes, value, _ = data_of(raw, header, start)
                    shape = (1,) * (3 - len(axes)) + tuple(axes)
                    row |= {"planes": shape[0], "height": shape[1], "width": shape[2], "header": list(header.items())}
                    row["data"] = value.tolist() if pixels else None
                except (ValueError, KeyError, IndexError) as e:
                    row["error"] = str(e) or type(e).__name__
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, arrow)

    kind = T.StructType.fromDDL(SCHEMA)
    names, arrow = kind.names, to_arrow_schema(kind)
    return src.mapInArrow(run, kind)


def card(key: str, value) -> bytes:
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, (int, float)):
        text = f"{value!r:>20}"
    else:
        text = "'" + str(value).replace("'", "''").ljust(8) + "'"
    return f"{key.upper()[:8]:<8}= {text}"[:CARD].ljust(CARD).encode("ascii", "replace")


def unit(shape: tuple[int, ...], data: np.ndarray, kind: str, header: dict, extension: str | None = None) -> bytes:
    """One header and data unit; shape has its slowest axis first."""
    bitpix = {np.dtype(v): k for k, v in KINDS.items()}[np.dtype(kind)]
    cards = [card("XTENSION", "IMAGE") if extension else card("SIMPLE", True), card("BITPIX", bitpix), card("NAXIS", len(shape))]
    cards += [card(f"NAXIS{i + 1}", int(n)) for i, n in enumerate(reversed(shape))]
    cards += [card("PCOUNT", 0), card("GCOUNT", 1), card("EXTNAME", extension)] if extension else []
    cards += [card(k, v) for k, v in header.items() if len(k) <= 8]
    head = b"".join(cards) + b"END".ljust(CARD)
    body = np.asarray(data).astype(kind).tobytes()
    return head.ljust(-(-len(head) // BLOCK) * BLOCK) + body.ljust(-(-len(body) // BLOCK) * BLOCK, b"\0")


def fits_bytes(images: DataFrame, keys: list[str], planes: list[str], coverage: str | None = None) -> DataFrame:
    """keys, content: FITS of image rows (height, width and array columns), colour planar, coverage as MASKCOUNT unit."""
    @F.pandas_udf("binary")
    def build(height: pd.Series, width: pd.Series, *arrays: pd.Series) -> pd.Series:
        out = []
        for i, (h, w) in enumerate(zip(height, width)):
            own = [np.asarray(a.iloc[i], float) for a in arrays[: len(planes)]]
            shape = (int(h), int(w)) if len(planes) == 1 else (len(planes), int(h), int(w))
            raw = unit(shape, np.concatenate(own), ">f4", {})
            if coverage:
                raw += unit((int(h), int(w)), np.asarray(arrays[-1].iloc[i]), ">i2", {}, "MASKCOUNT")
            out.append(raw)
        return pd.Series(out)

    return images.select(*keys, build("height", "width", *planes, *([coverage] if coverage else [])).alias("content"))
