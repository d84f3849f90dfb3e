"""`fits` as a data source: headers by blocks, frames or tiles by byte ranges, and writes that a failed task leaves no trace of.

    spark.dataSource.register(FitsSource)
    spark.read.format("fits").option("what", "headers").load(folder)      # a row an image, 2,880-byte blocks only
    spark.read.format("fits").option("what", "tiles").load(folder)        # rows of the image by byte range
    images.write.format("fits").mode("append").save(folder)               # name, height, width, data, ...

Files are opened in the tasks through pyarrow's file systems, in a place that all nodes share; folders that only Spark
reaches are for `read_fits` of this package. Tasks write under a hidden folder of the write; the files get their names
when all tasks are done, and the hidden folder goes, whatever became of tasks that failed or ran twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from starloom.sources.fits import BLOCK, CARD, KINDS, extent, header_of, unit

HEADERS = "path string, name string, height int, width int, planes int, header map<string,string>, error string"
IMAGES = "path string, name string, height int, width int, planes int, header map<string,string>, data array<double>, error string"
TILES = "path string, name string, height int, width int, plane int, first_row int, rows int, data array<double>, error string"
SCHEMAS = {"headers": HEADERS, "images": IMAGES, "tiles": TILES}
ARROW = {
    "headers": [("height", pa.int32()), ("width", pa.int32()), ("planes", pa.int32()), ("header", pa.map_(pa.string(), pa.string()))],
    "tiles": [("height", pa.int32()), ("width", pa.int32()), ("plane", pa.int32()), ("first_row", pa.int32()), ("rows", pa.int32())],
}
ARROW["images"] = ARROW["headers"]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of an address or a local path."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def header_at(file, at: int, size: int) -> tuple[dict[str, str], int]:
    """The header at an offset of an open file, block by block until its END, and where its data begin."""
    raw = b""
    while at + len(raw) < size:
        raw += file.read_at(BLOCK, at + len(raw))
        if any(raw[i : i + 8] == b"END     " for i in range(max(0, len(raw) - BLOCK), len(raw), CARD)):
            header, length = header_of(raw)
            return header, at + length
        if len(raw) == BLOCK and raw[:6] not in (b"SIMPLE", b"XTENSI"):
            break
    raise ValueError("no header")


def unit_at(file, hdu: int) -> tuple[dict[str, str], int]:
    """Header and data offset of the hdu-th unit; data before it are stepped over unread."""
    size, at = file.size(), 0
    for k in range(hdu + 1):
        header, start = header_at(file, at, size)
        at = extent(header, start)[2]
        if k < hdu and at >= size:
            raise ValueError(f"the file has {k + 1} units")
    return header, start


def values(file, header: dict[str, str], start: int, first: int, count: int) -> np.ndarray:
    """count scaled samples from the first-th on, read by their byte range."""
    kind = extent(header, 0)[1]
    raw = file.read_at(count * kind.itemsize, start + first * kind.itemsize)
    if len(raw) < count * kind.itemsize:
        raise ValueError("the data unit is cut short")
    return np.frombuffer(raw, kind).astype(float) * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))


def rows_of(file, what: str, hdu: int, tile_rows: int) -> Iterator[tuple[dict, np.ndarray | None]]:
    """The rows of an open file, each with its samples where it has any."""
    header, start = unit_at(file, hdu)
    axes = extent(header, 0)[0]
    planes, height, width = ((1, 1, 1) + axes)[-3:] if axes else (0, 0, 0)
    own = {"height": height, "width": width}
    if what != "tiles":
        yield own | {"planes": planes, "header": list(header.items())}, None if what == "headers" else values(file, header, start, 0, planes * height * width)
        return
    for plane in range(planes):
        for first in range(0, height, tile_rows):
            n = min(tile_rows, height - first)
            yield own | {"plane": plane, "first_row": first, "rows": n}, values(file, header, start, (plane * height + first) * width, n * width)


@dataclass
class Files(InputPartition):
    paths: list[str]


class FitsReader(DataSourceReader):
    """Options: what (headers, images, tiles), hdu, tile_rows, glob, files_per_task."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.what = options.get("what", "images")
        if self.what not in SCHEMAS:
            raise ValueError(f"what must be one of {', '.join(SCHEMAS)}")
        self.hdu, self.tile_rows = int(options.get("hdu", 0)), int(options.get("tile_rows", 64))
        self.glob, self.per_task = options.get("glob", "*.fits"), int(options.get("files_per_task", 16 if self.what == "headers" else 1))

    def partitions(self) -> list[InputPartition]:
        """Names only; sorted, so that a retried job has the same tasks."""
        system, path = opened(self.path)
        if system.get_file_info(path).type == fs.FileType.File:
            found = [path]
        else:
            found = sorted(f.path for f in system.get_file_info(fs.FileSelector(path)) if f.is_file and fnmatch(f.base_name, self.glob) and f.base_name[0] not in "._")
        return [Files(found[i : i + self.per_task]) for i in range(0, len(found), self.per_task)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system = opened(self.path)[0]
        kinds = [("path", pa.string()), ("name", pa.string()), *ARROW[self.what]]
        for path in partition.paths:
            own = {"path": path, "name": path.rsplit("/", 1)[-1]}
            try:
                with system.open_input_file(path) as file:
                    for row, data in rows_of(file, self.what, self.hdu, self.tile_rows):
                        yield self.batch(own | row, data, None, kinds)
            except (ValueError, KeyError, OSError) as e:
                yield self.batch(own, None, str(e) or type(e).__name__, kinds)

    def batch(self, row: dict, data: np.ndarray | None, error: str | None, kinds: list) -> pa.RecordBatch:
        """One row; the samples go to Arrow as they are, without a Python object each."""
        columns = [pa.array([row.get(n)], k) for n, k in kinds]
        names = [n for n, _ in kinds]
        if self.what != "headers":
            lists = pa.array([None], pa.list_(pa.float64())) if data is None else pa.ListArray.from_arrays(pa.array([0, len(data)], pa.int32()), pa.array(data))
            columns.append(lists)
            names.append("data")
        return pa.RecordBatch.from_arrays([*columns, pa.array([error], pa.string())], [*names, "error"])


@dataclass
class Written(WriterCommitMessage):
    names: list[str]
    attempt: str


class FitsWriter(DataSourceWriter):
    """Rows of name, height, width, data (planes one after the other), and as they have them planes, header, coverage, bitpix.

    Two rows of one name, or a name that the folder has already (without overwrite), fail the write as a whole.
    """

    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        missing = {"name", "height", "width", "data"} - set(schema.names)
        if missing:
            raise ValueError(f"FITS files need the columns {', '.join(sorted(missing))}")
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        system, root = opened(self.path)
        system.create_dir(self.hidden(root))

    def hidden(self, root: str) -> str:
        return f"{root}/._writing-{self.job}"

    def write(self, rows: Iterator) -> Written:
        system, root = opened(self.path)
        attempt, names = uuid.uuid4().hex, []
        folder = f"{self.hidden(root)}/{attempt}"
        system.create_dir(folder, recursive=False)  # fails in a task that outlives a write that was given up
        for row in rows:
            r = row.asDict()
            if "/" in r["name"] or r["name"] in names:
                raise ValueError(f"{r['name']} is no name for a file, or comes twice")
            planes, height, width = int(r.get("planes") or 1), int(r["height"]), int(r["width"])
            if len(r["data"]) != planes * height * width:
                raise ValueError(f"{r['name']} has {len(r['data'])} samples")
            kind = KINDS[int(r.get("bitpix") or -32)]
            header, data = dict(r.get("header") or {}), np.asarray(r["data"], float)
            if kind[1] in "iu":  # stored * BSCALE + BZERO
                data = np.rint((data - float(header.get("BZERO", 0))) / float(header.get("BSCALE", 1)))
                header |= {k: float(header[k]) for k in ("BZERO", "BSCALE") if k in header}
            else:
                header = {k: v for k, v in header.items() if k not in ("BZERO", "BSCALE")}
            header = {k: v for k, v in header.items() if not k.startswith(("SIMPLE", "BITPIX", "NAXIS", "XTENSION", "PCOUNT", "GCOUNT"))}
            raw = unit((height, width) if planes == 1 else (planes, height, width), data, kind, header)
            if r.get("coverage") is not None:
                raw += unit((height, width), np.asarray(r["coverage"]), ">i2", {}, "MASKCOUNT")
            with system.open_output_stream(f"{folder}/{r['name']}") as out:
                out.write(raw)
            names.append(r["name"])
        return Written(names, attempt)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        """Name the files of the tasks that count; what other attempts left goes with the hidden folder."""
        system, root = opened(self.path)
        try:
            done = [(n, m.attempt) for m in messages if m is not None for n in m.names]
            twice = len(done) - len({n for n, _ in done})
            there = [f.base_name for f in system.get_file_info([f"{root}/{n}" for n, _ in done]) if f.type != fs.FileType.NotFound]
            if twice or (there and not self.overwrite):
                raise FileExistsError(f"names that are taken: {twice} twice in the write, {', '.join(there[:5])}")
            if self.overwrite:
                kept = {n for n, _ in done}
                for f in system.get_file_info(fs.FileSelector(root)):
                    if f.is_file and f.base_name.endswith(".fits") and f.base_name not in kept:
                        system.delete_file(f.path)
            for n, attempt in done:
                system.move(f"{self.hidden(root)}/{attempt}/{n}", f"{root}/{n}")
        finally:
            self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        system, root = opened(self.path)
        if system.get_file_info(self.hidden(root)).type == fs.FileType.Directory:
            system.delete_dir(self.hidden(root))


class FitsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        return SCHEMAS.get(self.options.get("what", "images"), IMAGES)

    def reader(self, schema: StructType) -> FitsReader:
        return FitsReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> FitsWriter:
        return FitsWriter(dict(self.options), schema, overwrite)
