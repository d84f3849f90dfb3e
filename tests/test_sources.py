"""The FITS data source and the picture decoders: byte ranges, tiles, failed tasks, files of every kind."""

import os
import struct
import zlib
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.sources import fits_source, pictures, pictures_read
from starloom.sources.fits import unit


@pytest.fixture(scope="module")
def fits_format(spark):
    spark.dataSource.register(fits_source.FitsSource)
    return "fits"


class Counted:
    """A file that counts what is read of it."""

    def __init__(self, raw):
        self.raw, self.read = raw, 0

    def size(self):
        return len(self.raw)

    def read_at(self, n, at):
        self.read += n
        return self.raw[at : at + n]


@pytest.mark.parametrize("side", [10, 1000, 3000])
def test_headers_are_read_by_blocks_whatever_the_frame(side):
    head = {f"KEY{i}": i for i in range(60)}  # more than one block
    raw = unit((side, side), np.zeros(side * side), ">i2", head) + unit((side, side), np.ones(side * side), ">i2", {}, "MASKCOUNT")
    for hdu, blocks in ((0, 2), (1, 3)):
        file = Counted(raw)
        (row, data), = fits_source.rows_of(file, "headers", hdu, 64)
        assert data is None and row["height"] == side and file.read == blocks * 2880
    with pytest.raises(ValueError, match="2 units"):
        list(fits_source.rows_of(Counted(raw), "headers", 2, 64))


def test_frames_arrive_as_tiles_of_their_byte_range(spark, fits_format, tmp_path):
    image = np.random.default_rng(1).integers(0, 65536, (2160, 3840))
    (tmp_path / "frame.fits").write_bytes(unit(image.shape, image - 32768, ">i2", {"BZERO": 32768, "BSCALE": 1}))
    (tmp_path / "odd.fits").write_bytes(unit((2, 5, 3), np.arange(30), ">f4", {}))
    got = spark.read.format(fits_format).option("what", "tiles").option("tile_rows", 500).load(str(tmp_path))
    assert [tuple(r) for r in got.where("name = 'frame.fits'").select("first_row", "rows", F.size("data")).sort("first_row").collect()] == [
        (i, min(500, 2160 - i), min(500, 2160 - i) * 3840) for i in range(0, 2160, 500)
    ]
    sums = got.where("name = 'frame.fits'").select("first_row", F.aggregate("data", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(r.s == image[r.first_row : r.first_row + 500].sum() for r in sums)
    odd = spark.read.format(fits_format).option("what", "tiles").option("tile_rows", 2).load(str(tmp_path / "odd.fits"))
    assert {(r.plane, r.first_row, tuple(r.data)) for r in odd.collect()} == {
        (p, f, tuple(np.arange(30.0).reshape(2, 5, 3)[p, f : f + 2].ravel())) for p in (0, 1) for f in (0, 2, 4)
    }


def test_files_are_written_and_read_back(spark, fits_format, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(f"m{i}.fits", 4, 5, 3 if i % 2 else 1, rng.normal(0, 9, 60 if i % 2 else 20).astype(np.float32).astype(float).tolist(), {"OBJECT": "M 31 o'clock", "EXPTIME": "15.0"}, [i] * 20 if i else None) for i in range(6)]
    df = spark.createDataFrame(rows, "name string, height int, width int, planes int, data array<double>, header map<string,string>, coverage array<int>").repartition(3)
    out = str(tmp_path / "masters")
    os.mkdir(out)
    df.write.format(fits_format).mode("append").save(out)
    back = {r.name: r for r in spark.read.format(fits_format).load(out).collect()}
    assert sorted(back) == [f"m{i}.fits" for i in range(6)] and sorted(os.listdir(out)) == sorted(back)
    for name, h, w, p, data, header, _ in rows:
        r = back[name]
        assert (r.height, r.width, r.planes, r.data, r.error) == (h, w, p, data, None) and header.items() <= r.header.items()
    cover = {r.name: r for r in spark.read.format(fits_format).option("hdu", 1).load(out).collect()}
    assert cover["m0.fits"].error and all(cover[f"m{i}.fits"].data == [float(i)] * 20 for i in range(1, 6))
    with pytest.raises(Exception, match="taken"):
        df.limit(1).write.format(fits_format).mode("append").save(out)
    assert sorted(os.listdir(out)) == sorted(back)
    df.where("planes = 3").write.format(fits_format).mode("overwrite").save(out)
    assert sorted(os.listdir(out)) == ["m1.fits", "m3.fits", "m5.fits"]


def test_whole_numbers_are_stored_as_the_sensor_does(spark, fits_format, tmp_path):
    data = np.arange(0, 65536, 13)[:5000].astype(float)
    df = spark.createDataFrame([("a.fits", 50, 100, data.tolist(), 16, {"BZERO": "32768", "BSCALE": "1"})], "name string, height int, width int, data array<double>, bitpix int, header map<string,string>")
    df.write.format(fits_format).mode("append").save(str(tmp_path))
    got = spark.read.format(fits_format).load(str(tmp_path)).first()
    assert got.data == data.tolist() and got.header["BITPIX"] == "16" and os.path.getsize(tmp_path / "a.fits") == 2880 + 4 * 2880


def test_a_failed_task_leaves_no_file(spark, fits_format, tmp_path):
    rows = [(f"m{i}.fits", 2, 2, [1.0] * 4, {}) for i in range(8)]
    df = spark.createDataFrame(rows, "name string, height int, width int, data array<double>, header map<string,string>").repartition(4)
    broken = df.withColumn("data", F.when(F.col("name") == "m7.fits", F.expr("transform(data, x -> cast(raise_error('lost') as double))")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="lost"):
        broken.write.format(fits_format).mode("append").save(str(tmp_path))
    assert os.listdir(tmp_path) == []
    short = df.withColumn("data", F.when(F.col("name") == "m3.fits", F.slice("data", 1, 3)).otherwise(F.col("data")))
    with pytest.raises(Exception, match="3 samples"):
        short.write.format(fits_format).mode("append").save(str(tmp_path))
    twice = df.where("name <> 'm7.fits'").union(df.where("name = 'm1.fits'"))
    with pytest.raises(Exception, match="twice"):
        twice.write.format(fits_format).mode("append").save(str(tmp_path))
    assert os.listdir(tmp_path) == []


def test_what_is_no_fits_file_gives_an_error_row(spark, fits_format, tmp_path):
    whole = unit((4, 4), np.zeros(16), ">f4", {})
    (tmp_path / "cut.fits").write_bytes(whole[:2900])
    (tmp_path / "none.fits").write_bytes(b"x" * 10_000)
    (tmp_path / "empty.fits").write_bytes(b"")
    (tmp_path / "good.fits").write_bytes(whole)
    (tmp_path / "other.txt").write_bytes(b"x")
    got = {r.name: r.error for r in spark.read.format(fits_format).load(str(tmp_path)).collect()}
    assert set(got) == {"cut.fits", "none.fits", "empty.fits", "good.fits"} and got["good.fits"] is None
    assert all(got[n] for n in ("cut.fits", "none.fits", "empty.fits"))
    heads = {r.name: r.error for r in spark.read.format(fits_format).option("what", "headers").load(str(tmp_path)).collect()}
    assert heads["cut.fits"] is None and heads["good.fits"] is None


def test_headers_behind_large_units_need_no_pixels(spark, tmp_path):
    from starloom.sources.fits import read_fits

    big = unit((600, 600), np.zeros(360_000), ">f8", {}) + unit((600, 600), np.ones(360_000), ">i2", {"WHAT": 5}, "MASKCOUNT")
    (tmp_path / "a.fits").write_bytes(big)
    first = read_fits(spark, str(tmp_path), pixels=False).first()
    second = read_fits(spark, str(tmp_path), pixels=False, hdu=1).first()
    assert (first.error, first.height, first.data) == (None, 600, None) and (second.error, second.header["WHAT"], second.data) == (None, "5", None)


def test_a_session_shows_its_finished_stack_before_the_cached_one(spark, tmp_path):
    from starloom.sources.session_files import colour_stack

    assert colour_stack(spark, str(tmp_path)) is None
    for folder, name, level in (("cache", "stack_rgb_linear.fits", 1.0), ("stacked", "master_rgb.fits", 2.0)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_bytes(unit((3, 2, 2), np.full(12, level), ">f4", {}))
        got = colour_stack(spark, str(tmp_path)).first()
        assert (got.planes, got.data) == (3, [level] * 12)
    assert colour_stack(spark, str(tmp_path / "cache" / "stack_rgb_linear.fits")).first().data == [1.0] * 12


# ---- pictures


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def filtered_png(image, depth, colour, filters, palette=None):
    """A PNG of (height, width, channels) whose rows use the filters in turn, byte by byte as the format says."""
    h, w, c = image.shape
    if depth == 16:
        rows = image.astype(">u2").reshape(h, -1).view(np.uint8).reshape(h, -1)
    elif depth == 8:
        rows = image.astype(np.uint8).reshape(h, -1)
    else:
        bits = (image.reshape(h, -1, 1) >> np.arange(depth - 1, -1, -1)) & 1
        rows = np.packbits(bits.reshape(h, -1).astype(np.uint8), axis=1)
    step, raw = max(1, c * depth // 8), b""
    for y in range(h):
        f = filters[y % len(filters)]
        line = bytearray([f])
        for x in range(rows.shape[1]):
            a = int(rows[y, x - step]) if x >= step else 0
            b = int(rows[y - 1, x]) if y else 0
            d = int(rows[y - 1, x - step]) if y and x >= step else 0
            p = a + b - d
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
            line.append((int(rows[y, x]) - [0, a, b, (a + b) // 2, near][f]) % 256)
        raw += bytes(line)
    packed = zlib.compress(raw)
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0))
    lut = chunk(b"PLTE", palette.astype(np.uint8).tobytes()) if palette is not None else b""
    return b"\x89PNG\r\n\x1a\n" + head + lut + chunk(b"IDAT", packed[:9]) + chunk(b"IDAT", packed[9:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("filters", [[0], [1], [2], [3], [4], [4, 3, 2, 1, 0, 3]])
@pytest.mark.parametrize("depth, colour, channels", [(8, 0, 1), (8, 2, 3), (8, 4, 2), (8, 6, 4), (16, 0, 1), (16, 2, 3), (16, 6, 4), (1, 0, 1), (2, 0, 1), (4, 0, 1)])
def test_png_of_every_filter_and_depth(filters, depth, colour, channels):
    image = np.random.default_rng(depth + colour).integers(0, 1 << depth, (9, 13, channels))
    got, bits = pictures_read.read_png(filtered_png(image, depth, colour, filters))
    assert bits == depth and np.array_equal(got, image)


@pytest.mark.parametrize("depth", [1, 2, 4, 8])
def test_png_of_palettes(depth):
    rng = np.random.default_rng(depth)
    palette, image = rng.integers(0, 256, (1 << depth, 3)), rng.integers(0, 1 << depth, (7, 11, 1))
    assert np.array_equal(pictures_read.read_png(filtered_png(image, depth, 3, [4, 1], palette))[0], palette[image[:, :, 0]])
    with pytest.raises(ValueError, match="palette"):
        pictures_read.read_png(filtered_png(np.full((2, 2, 1), (1 << depth) - 1), depth, 3, [0], palette[:-1]))


def packed_lzw(raw):
    """LZW with codes of growing width, cleared when the table is full."""
    table, size, word, bits, n = {bytes([i]): i for i in range(256)}, 9, b"", 256, 9
    following = 258

    def put(code, width):
        nonlocal bits, n
        bits, n = bits << width | code, n + width

    for byte in raw:
        own = word + bytes([byte])
        if own in table:
            word = own
            continue
        put(table[word], size)
        table[own] = following
        following += 1
        if following == 4095:
            put(256, size)
            table, size, following = {bytes([i]): i for i in range(256)}, 9, 258
        elif following in (512, 1024, 2048):
            size += 1
        word = bytes([byte])
    if word:
        put(table[word], size)
        following += 1
        size += following in (512, 1024, 2048)
    put(257, size)
    return (bits << -n % 8).to_bytes(-(-n // 8), "big")


def packed_bits(raw):
    out = b""
    for i in range(0, len(raw), 100):
        part = raw[i : i + 100]
        out += bytes([257 - len(part)]) + part[:1] if len(part) > 1 and len(set(part)) == 1 else bytes([len(part) - 1]) + part
    return out


def made_tiff(image, order="<", packing=1, predictor=1, tile=None, rows=4, planar=1, white=False):
    """A TIFF of (height, width, channels) in strips of some rows, or tiles."""
    h, w, c = image.shape
    depth, form = image.dtype.itemsize * 8, {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    tw, th = tile or (w, rows)
    pack = {1: bytes, 5: packed_lzw, 8: zlib.compress, 32773: packed_bits}[packing]
    parts = []
    for plane in range(c if planar == 2 else 1):
        own = image[:, :, plane : plane + 1] if planar == 2 else image
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = own[y : y + th, x : x + tw]
                if tile:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
                parts.append(pack(part.astype(part.dtype.newbyteorder(order)).tobytes()))
    offsets = np.cumsum([8, *map(len, parts)]).tolist()
    tags = {256: (4, [w]), 257: (4, [h]), 258: (3, [depth] * c), 259: (3, [packing]), 262: (3, [2 if c == 3 else 0 if white else 1]), 277: (3, [c]), 284: (3, [planar]), 317: (3, [predictor]), 339: (3, [form] * c)}
    tags |= {322: (3, [tw]), 323: (3, [th]), 324: (4, offsets[:-1]), 325: (4, list(map(len, parts)))} if tile else {273: (4, offsets[:-1]), 278: (3, [rows]), 279: (4, list(map(len, parts)))}
    at, more, entries = offsets[-1], b"", b""
    for tag, (kind, v) in sorted(tags.items()):
        own = struct.pack(order + {3: "H", 4: "I"}[kind] * len(v), *v)
        if len(own) > 4:
            entries += struct.pack(order + "HHII", tag, kind, len(v), at + 2 + 12 * len(tags) + 4 + len(more))
            more += own
        else:
            entries += struct.pack(order + "HHI", tag, kind, len(v)) + own.ljust(4, b"\0")
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at)
    return head + b"".join(parts) + struct.pack(order + "H", len(tags)) + entries + struct.pack(order + "I", 0) + more


@pytest.mark.parametrize("kind", ["u1", "u2", "i2", "f4", "f8", "u4"])
@pytest.mark.parametrize("order, packing, predictor, tile, planar", [("<", 1, 1, None, 1), (">", 5, 1, None, 1), ("<", 5, 2, None, 1), ("<", 8, 2, (16, 16), 1), (">", 32773, 1, (16, 32), 2), ("<", 1, 1, None, 2)])
def test_tiff_of_strips_and_tiles(kind, order, packing, predictor, tile, planar):
    if kind[0] == "f" and predictor == 2:
        predictor = 1
    rng = np.random.default_rng(3)
    for shape in ((21, 37, 1), (5, 90, 3)):
        image = rng.integers(0, 200 if kind != "u2" else 60_000, shape).astype(kind)
        image[2:4] = 7
        got, depth = pictures_read.read_tiff(made_tiff(image, order, packing, predictor, tile, 4, planar))
        assert depth == image.dtype.itemsize * 8 and np.array_equal(got, image)
    assert np.array_equal(pictures_read.read_tiff(made_tiff(np.full((2, 2, 1), 5, np.uint8), white=True))[0], np.full((2, 2, 1), 250))


@pytest.mark.parametrize("size", [0, 1, 300, 5_000, 200_000])
def test_lzw_round_trip(size):
    rng = np.random.default_rng(size)
    for top in (2, 256):
        raw = rng.integers(0, top, size).astype(np.uint8).tobytes()
        assert pictures_read.unpacked_lzw(packed_lzw(raw)) == raw


def test_pictures_are_a_relation(spark, tmp_path):
    rng = np.random.default_rng(4)
    image = rng.integers(0, 256, (6, 5, 3))
    (tmp_path / "a.png").write_bytes(filtered_png(image, 8, 2, [4]))
    (tmp_path / "b.tif").write_bytes(pictures.tiff(rng.integers(0, 65536, (3, 4))))
    (tmp_path / "black.png").write_bytes(filtered_png(np.zeros((2, 2, 1), int), 8, 0, [0]))
    (tmp_path / "cut.png").write_bytes(filtered_png(image, 8, 2, [4])[:-20])
    (tmp_path / "cut.tif").write_bytes(made_tiff(image.astype("u2"))[:150])
    (tmp_path / "empty.tiff").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"x")
    rows = pictures_read.read_pictures(spark, str(tmp_path))
    got = {r.name: r for r in rows.collect()}
    assert set(got) == {"a.png", "b.tif", "black.png", "cut.png", "cut.tif"}  # Spark passes over empty files
    assert got["a.png"].data == image.ravel().tolist() and (got["b.tif"].height, got["b.tif"].width, got["b.tif"].depth) == (3, 4, 16)
    assert all(got[n].error and got[n].data is None for n in ("cut.png", "cut.tif"))
    light = {r.name: r.data for r in pictures_read.luminances(rows).collect()}
    assert np.allclose(light["a.png"], image[:, :, 0].ravel() / image[:, :, 0].max()) and light["black.png"] == [0.0] * 4 and len(light) == 3


def test_large_pngs_are_read_by_diagonals():
    image = np.random.default_rng(5).integers(0, 256, (300, 400, 3))
    raw = filtered_png(image, 8, 2, [4])
    assert np.array_equal(pictures_read.read_png(raw)[0], image)


def test_files_are_whole_or_absent(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.bin", b"1" * 50), ("y.bin", b"2"), ("z.bin", None)], "n string, content binary").repartition(1)
    with pytest.raises(Exception):
        pictures.write_files(rows, str(tmp_path), F.col("n"))
    left = {f: open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(tmp_path) for f in names}
    assert all(left[f] == {"x.bin": b"1" * 50, "y.bin": b"2"}[f] for f in left)
    for _ in range(2):
        assert pictures.write_files(rows.where("n <> 'z.bin'"), str(tmp_path), F.col("n")) == 2
    assert sorted(f for _, _, names in os.walk(tmp_path) for f in names) == ["x.bin", "y.bin"]


# ---- what a session leaves


def test_a_session_leaves_masters_pictures_and_statistics(spark, tmp_path):
    from starloom.plans import outputs
    from starloom.plans.align import ProcessedSession

    rgb = spark.createDataFrame([(s, y, x, 0.1 * y, 0.1 * x, 0.5) for s in ("a/b", "c") for y in range(4) for x in range(6)], "session string, y int, x int, r double, g double, b double")
    stats = spark.createDataFrame([("a/b", 5, 75.0, 0.03, 2.0), ("c", 7, 105.0, 0.03, 3.0)], "session string, n_frames int, total_exposure_s double, mean_clipped_fraction double, snr_proxy double")
    made = outputs.write_session(ProcessedSession(None, rgb, rgb, rgb, stats), str(tmp_path))
    assert sorted(os.listdir(made["linear"])) == ["a_b_linear.fits", "c_linear.fits"] and sorted(os.listdir(made["png"])) == ["a_b.png", "c.png"]
    back = spark.read.format("fits").load(made["calibrated"]).where("name like 'c%'").first()
    assert (back.planes, back.height, back.width, back.header["NFRAMES"], back.header["EXPTIME"]) == (3, 4, 6, "7", "105.0")
    assert np.allclose(np.reshape(back.data, (3, 4, 6))[0], 0.1 * np.arange(4)[:, None])
    png = pictures_read.read_pictures(spark, made["png"]).first()
    assert png.channels == 3 and png.data[:3] == [0.0, 0.0, 127.0]
    assert pictures_read.read_pictures(spark, made["tiff"]).first().depth == 16
    report = spark.read.json(made["report"]).collect()
    assert {r.n_frames for r in report} == {5, 7} and all(r.version and "Spark 4" in r.platform and abs(datetime.fromisoformat(r.timestamp) - datetime.now(UTC)) < timedelta(minutes=5) for r in report)


def test_aligned_frames_with_own_planes_are_left_once_each(spark, tmp_path):
    from starloom.plans import align, outputs

    rng = np.random.default_rng(6)
    frames = spark.createDataFrame([("s", i, 6, 8, rng.normal(0, 1, 48).tolist()) for i in range(5)], "session string, frame_id long, height int, width int, data array<double>")
    one = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    moves = spark.createDataFrame([("s", i, i != 3, one) for i in range(5)], "session string, frame_id long, success boolean, matrix array<array<double>>")
    own = align.Planes(("low", "high"), True, lambda m: (np.minimum(m[::2, ::2], m[1::2, 1::2]), np.maximum(m[::2, ::2], m[1::2, 1::2])))
    outputs.write_aligned(frames.repartition(4), moves, str(tmp_path / "aligned"), own)
    got = {r.name: r for r in spark.read.format("fits").load(str(tmp_path / "aligned")).collect()}
    assert sorted(got) == [f"s_{i}.fits" for i in (0, 1, 2, 4)]
    for r in frames.where("frame_id <> 3").collect():
        m = np.reshape(r.data, (6, 8))
        assert np.allclose(np.reshape(got[f"s_{r.frame_id}.fits"].data, (2, 3, 4)), np.stack(own.of(m)), atol=1e-6)
    stacked = align.rgb_stack(frames, moves, own)
    assert stacked.columns == ["session", "y", "x", "low", "high", "coverage"] and stacked.where("coverage = 4").count() == 12
    with pytest.raises(Exception, match="announced"):
        align.rgb_stack(frames, moves, align.Planes(("v",), True, lambda m: [m])).collect()
    dim = align.star_lists(frames, 1.0, 1, method=lambda m: np.zeros_like(m))
    assert [r.n_stars for r in dim.collect()] == [0] * 5
