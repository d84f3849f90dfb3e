"""Closed-form cases of the image operators, and numpy versions of those that SQL cannot state."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import mosaic, text, tone
from starloom.operators import background, colour, frames, register, stack, stencil
from starloom.operators.pixels import tiles, to_pixels
from starloom.plans import cache, session
from starloom.schema import LuminanceSettings, StackSettings
from starloom.sources import fits, pictures, pictures_read

IMAGE = ["i"]


def image_rows(spark, *images, names=("v",)):
    rows = []
    for i, planes in enumerate(images):
        planes = [np.asarray(p, float) for p in (planes if len(names) > 1 else [planes])]
        h, w = planes[0].shape
        rows += [(i, y, x, *[float(p[y, x]) for p in planes]) for y in range(h) for x in range(w)]
    return spark.createDataFrame(rows, "i int, y int, x int, " + ", ".join(f"{n} double" for n in names))


def image_of(df, value, i=0):
    got = [(r.y, r.x, r[value]) for r in df.where(F.col("i") == i).collect()]
    out = np.full((max(y for y, _, _ in got) + 1, max(x for _, x, _ in got) + 1), np.nan)
    for y, x, v in got:
        out[y, x] = v
    return out


def test_outlier_is_clipped_and_chunks_do_not_matter(spark):
    pix = image_rows(spark, *[np.full((4, 4), 100.0)] * 12, np.full((4, 4), 10000.0))
    got = stack.sigma_clip_mean(pix, ["y", "x"], ["v"]).collect()
    assert {(r.v, r.n, r.n_kept) for r in got} == {(100.0, 13, 12)}
    again = stack.sigma_clip_mean(pix.repartition(7), ["y", "x"], ["v"], centre="mean").collect()
    assert {(r.v, r.n_kept) for r in again} == {(100.0, 12)}
    with pytest.raises(ValueError):
        stack.clipped(pix, ["y"], ["v"], centre="mode")


def test_channels_clip_on_their_own(spark):
    flat = np.full((2, 2), 100.0)
    pix = image_rows(spark, *[(flat, flat, flat)] * 12, (flat * 100, flat, flat), names=("r", "g", "b"))
    got = stack.sigma_clip_mean(pix, ["y", "x"], ["r", "g", "b"]).collect()
    assert {(r.r, r.g, r.b, r.n_kept) for r in got} == {(100.0, 100.0, 100.0, 12)}


def test_masks_weight_the_mean(spark):
    half = np.repeat([[1.0], [0.0]], 2, axis=0) * np.ones((4, 2))
    pix = image_rows(spark, (np.full((4, 2), 100.0), np.ones((4, 2))), (np.full((4, 2), 200.0), half), names=("v", "w"))
    got = {(r.y, r.x): (r.v, r.coverage) for r in stack.mask_aware_mean(pix, ["y", "x"], ["v"], "w").collect()}
    assert got[0, 0] == (150.0, 2) and got[3, 1] == (100.0, 1)
    nothing = pix.withColumn("w", F.lit(0.0))
    assert {(r.v, r.coverage) for r in stack.mask_aware_mean(nothing, ["y", "x"], ["v"], "w").collect()} == {(0.0, 0)}
    weights = spark.createDataFrame([(0, 1.0), (1, 9.0)], "i int, weight double")
    assert {r.v for r in stack.weighted_mean(pix, weights, "i", ["y", "x"], "v").collect()} == {190.0}


def test_coverage_box_and_crop(spark):
    cov = np.zeros((20, 20))
    cov[5:15, 3:12] = 10
    pix = image_rows(spark, cov, names=("coverage",))
    assert tuple(stack.coverage_bounds(pix, IMAGE).first())[1:] == (5, 15, 3, 12)
    got = stack.cropped(pix, IMAGE).agg(F.max("y"), F.max("x"), F.min("coverage")).first()
    assert tuple(got) == (9, 8, 10.0)
    empty = stack.coverage_bounds(image_rows(spark, np.zeros((3, 4)), names=("coverage",)), IMAGE).first()
    assert tuple(empty)[1:] == (0, 3, 0, 4)


def test_partial_moments_match_numpy(spark):
    rng = np.random.default_rng(1)
    cube = rng.normal(100, 5, (30, 6, 7))
    rows = [(0, i, 6, 7, c.ravel().tolist()) for i, c in enumerate(cube)]
    own = spark.createDataFrame(rows, "session int, frame_id long, height int, width int, data array<double>").repartition(5)
    got = stack.partial_moments(tiles(own, ["session", "frame_id"], "data", 4, 5), ["session", "ty", "tx"]).collect()
    assert len(got) == 4 and all(r.n == 30 for r in got)
    first = next(r for r in got if (r.ty, r.tx) == (0, 0))
    assert np.allclose(first["mean"], cube[:, :4, :5].mean(0).ravel()) and np.allclose(first.m2, (cube[:, :4, :5].var(0) * 30).ravel())


def test_odd_mosaic_and_known_blocks(spark):
    block = np.tile([[100.0, 200.0], [200.0, 50.0]], (5, 5))[:9, :9]
    own = spark.createDataFrame([(0, 9, 9, block.ravel().tolist())], "i int, height int, width int, data array<double>")
    h, w, d = F.col("height"), F.col("width"), F.col("data")
    got = own.select(*[mosaic.plane(d, h, w, p).alias(p) for p in mosaic.PLANES], *[mosaic.bilinear(d, h, w, c).alias(f"full_{c}") for c in "rgb"], mosaic.luminance(d, h, w).alias("l")).first()
    assert (len(got.r), set(got.r), set(got.g1), set(got.b)) == (16, {100.0}, {200.0}, {50.0})
    assert (set(got.full_r), set(got.full_g), set(got.full_b)) == ({100.0}, {200.0}, {50.0})
    assert got.l[0] == pytest.approx(0.299 * 100 + 0.587 * 200 + 0.114 * 50)


def test_colour_functions(spark):
    one = spark.createDataFrame([(0.2, 0.8, 0.4), (0.0, 0.0, 0.0), (1.0, 0.5, 0.25)], "r double, g double, b double")
    lab = one.select(*[c.alias(n) for n, c in zip("lab", tone.rgb_to_lab(colour.cols()))])
    back = lab.select(*tone.lab_to_rgb(tuple(F.col(n) for n in "lab"))).collect()
    assert np.allclose([tuple(r) for r in back], [tuple(r) for r in one.collect()], atol=1e-5)
    hsv = one.select(*[c.alias(n) for n, c in zip("hsv", tone.rgb_to_hsv(colour.cols()))])
    back = hsv.select(*tone.hsv_to_rgb(tuple(F.col(n) for n in "hsv"))).collect()
    assert np.allclose([tuple(r) for r in back], [tuple(r) for r in one.collect()])
    green = one.select(tone.scnr(colour.cols(), 1.0)[1].alias("g")).collect()
    assert green[0].g == pytest.approx(0.3)
    with pytest.raises(ValueError):
        tone.ccm_rows("loud")
    with pytest.raises(ValueError):
        tone.scnr(colour.cols(), 1.0, "other")


def test_constant_images_stretch_to_zero(spark):
    flat = image_rows(spark, np.full((4, 4), 7.0))
    assert {r.v for r in colour.percentile_stretched(flat, IMAGE, "v").collect()} == {0.0}


def test_gaussian_matches_direct_sum(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(11, 9))
    w = np.array(stencil.gaussian_weights(1.2))
    pad = np.pad(a, len(w) // 2, mode="symmetric")
    rows = np.array([[np.dot(w, pad[y : y + len(w), x + len(w) // 2]) for x in range(9)] for y in range(11)])
    pad = np.pad(rows, len(w) // 2, mode="symmetric")
    want = np.array([[np.dot(w, pad[y + len(w) // 2, x : x + len(w)]) for x in range(9)] for y in range(11)])
    assert np.allclose(image_of(stencil.gaussian(image_rows(spark, a), IMAGE, "v", 1.2), "v"), want)


def plain_labels(m):
    label, n = np.zeros(m.shape, int), 0
    for start in zip(*np.nonzero(m)):
        if label[start]:
            continue
        n += 1
        todo = [start]
        while todo:
            y, x = todo.pop()
            if 0 <= y < m.shape[0] and 0 <= x < m.shape[1] and m[y, x] and not label[y, x]:
                label[y, x] = n
                todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return label


def test_components_and_holes(spark):
    rng = np.random.default_rng(7)
    m = rng.random((14, 17)) < 0.55
    pix = image_rows(spark, m.astype(float)).withColumn("m", F.col("v") > 0.5)
    got = {(r.y, r.x): r.label for r in stencil.labelled(pix, IMAGE, "m").collect()}
    want = plain_labels(m)
    pairs = {(want[k], v) for k, v in got.items()}
    assert len(got) == m.sum() and len(pairs) == want.max() == len({b for _, b in pairs})
    off = plain_labels(~m)
    border = set(off[0]) | set(off[-1]) | set(off[:, 0]) | set(off[:, -1])
    filled = image_of(stencil.filled(pix, IMAGE, "m"), "m").astype(bool)
    assert (filled == (m | ~np.isin(off, list(border)))).all()


def test_dilation_erosion_and_feather(spark):
    m = np.zeros((21, 21))
    m[10, 10] = 1
    pix = image_rows(spark, m).withColumn("m", F.col("v") > 0.5)
    y, x = np.indices(m.shape)
    for n in (1, 3, 9):
        grown = image_of(stencil.dilated(pix, IMAGE, "m", n), "m").astype(bool)
        assert (grown == (abs(y - 10) + abs(x - 10) <= n)).all()
    full = image_rows(spark, np.ones((7, 7))).withColumn("m", F.col("v") > 0.5)
    assert image_of(stencil.eroded(full, IMAGE, "m", 2), "m").sum() == 9
    box = np.zeros((15, 15))
    box[3:12, 3:12] = 1
    soft = image_of(stencil.feathered(image_rows(spark, box, names=("w",)), IMAGE, "w", 4), "w")
    assert soft[7, 7] == 1 and soft[3, 7] == 0.25 and soft[0, 0] == 0 and soft[4, 4] == pytest.approx(0.5)
    assert (image_of(stencil.feathered(image_rows(spark, np.ones((5, 5)), names=("w",)), IMAGE, "w", 4), "w") == 1).all()


def test_stars_are_counted_measured_and_balanced(spark):
    rng = np.random.default_rng(3)
    y, x = np.indices((80, 80))
    sky = rng.normal(0, 2, (80, 80))
    places = [(20, 20), (20, 55), (30, 66), (40, 40), (55, 22), (58, 60), (62, 40)]
    stars = sum((1500 if k == 6 else 900) * np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / 8) for k, (cy, cx) in enumerate(places))
    pix = image_rows(spark, (100 + stars * 0.5 + sky, 100 + stars + sky, 100 + stars * 0.8 + sky), names=("r", "g", "b"))
    assert stencil.star_counts(pix, IMAGE, "g").first().n_stars == 7
    found = colour.reference_stars(pix, IMAGE, saturation=1.1)
    near = sorted((r.y, r.x) for r in found.collect())  # centroids are truncated to whole pixels
    assert all(0 <= a - y < 2 and 0 <= b - x < 2 for (y, x), (a, b) in zip(near, places, strict=True))
    flux = colour.aperture_fluxes(found, pix, IMAGE).collect()
    assert len(flux) == 7 and all(r.r_flux / r.g_flux == pytest.approx(0.5, abs=0.02) for r in flux)
    even = colour.calibrated(pix, IMAGE, "stars", "per_channel").where("y = 20 and x = 20").first()
    assert even.r == pytest.approx(even.g, rel=0.1) and even.b == pytest.approx(even.g, rel=0.1)


def test_background_model_takes_out_a_tilt(spark):
    y, x = np.indices((40, 48))
    rng = np.random.default_rng(2)
    tilt = 500 + 3 * x - 2 * y + 0.05 * x * x
    pix = image_rows(spark, tilt + rng.normal(0, 1, tilt.shape))
    model = image_of(background.estimated(pix, IMAGE, "v", 8, 2), "background")
    assert np.abs(model - tilt).max() < 4
    flat = background.without_background(background.estimated(pix, IMAGE, "v", 8, 2), IMAGE, "v")
    assert image_of(flat, "v").std() < 2 and image_of(flat, "v").min() == 0


def test_registration_recovers_shifts_and_rotations(spark):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(32, 32))
    rows = [(0, 1, 32, 32, a.ravel().tolist()), (0, 2, 32, 32, np.roll(a, (4, -6), (0, 1)).ravel().tolist()), (0, 3, 2, 2, [1.0] * 4)]
    own = spark.createDataFrame(rows, "session int, frame_id long, height int, width int, data array<double>")
    got = {r.frame_id: (r.dy, r.dx, r.success) for r in register.integer_shifts(own, own.where("frame_id = 1").drop("frame_id"), ["session"]).collect()}
    assert got[1] == (0, 0, True) and got[2] == (-4, 6, True) and got[3][2] is False
    pts = rng.uniform(0, 400, (30, 2))
    turn = math.radians(12)
    m = np.array([[math.cos(turn), -math.sin(turn)], [math.sin(turn), math.cos(turn)]])
    moved = pts @ m.T + (15, -8)
    back, n = register.matched_transform(pts, moved[rng.permutation(30)][:26])
    assert n >= 24 and np.allclose(back[:2, :2], m, atol=1e-6) and np.allclose(back[:2, 2], (15, -8), atol=1e-4)
    assert register.matched_transform(pts[:2], moved)[0] is None


def test_warp_and_mask(spark):
    a = np.arange(16.0).reshape(4, 4)
    inv = [[1.0, 0.0, 1.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    own = spark.createDataFrame([(4, 4, a.ravel().tolist(), inv)], "h int, w int, d array<double>, m array<array<double>>")
    got = own.select(register.warped(F.col("d"), F.col("h"), F.col("w"), F.col("m")).alias("v"), register.warp_mask(F.col("h"), F.col("w"), F.col("m")).alias("k")).first()
    assert np.reshape(got.v, (4, 4))[:, :3].tolist() == a[:, 1:].tolist() and np.reshape(got.k, (4, 4))[:, 3].tolist() == [0.0] * 4
    inverse = own.select(register.affine_inverse(F.array(F.array(F.lit(0.0), F.lit(-1.0), F.lit(3.0)), F.array(F.lit(1.0), F.lit(0.0), F.lit(2.0)), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))).alias("i")).first().i
    assert np.allclose(np.array(inverse) @ [[0, -1, 3], [1, 0, 2], [0, 0, 1]], np.eye(3))


def test_fits_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 65536, (6, 8))
    raw = fits.unit((6, 8), a - 32768, ">i2", {"BZERO": 32768, "BSCALE": 1, "OBJECT": "M 31 o'clock", "EXPTIME": 15.0})
    (tmp_path / "a.fits").write_bytes(raw)
    (tmp_path / "failed_b.fits").write_bytes(b"no header")
    (tmp_path / "c.txt").write_text("other")
    got = {r.name: r for r in fits.read_fits(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.fits", "failed_b.fits"} and got["failed_b.fits"].error
    assert np.array_equal(np.reshape(got["a.fits"].data, (6, 8)), a) and got["a.fits"].header["OBJECT"] == "M 31 o'clock"
    head = fits.read_fits(spark, str(tmp_path), pixels=False).where("name = 'a.fits'")
    assert head.first().data is None
    meta = head.select(*frames.metadata(F.col("header"))).first()
    assert (meta.object, meta.exptime, meta.naxis1, meta.xbinning, meta.filter) == ("M 31 o'clock", 15.0, 8, 1, "")
    images = spark.createDataFrame([(0, 2, 3, [1.0] * 6, [2.0] * 6, [3.0] * 6, [5] * 6)], "i int, height int, width int, r array<double>, g array<double>, b array<double>, k array<int>")
    out = fits.fits_bytes(images, ["i"], ["r", "g", "b"], "k")
    assert pictures.write_files(out, str(tmp_path / "out"), F.lit("m.fits")) == 1
    back = fits.read_fits(spark, str(tmp_path / "out")).first()
    assert (back.planes, back.height, back.width, back.data) == (3, 2, 3, [1.0] * 6 + [2.0] * 6 + [3.0] * 6)
    assert fits.read_fits(spark, str(tmp_path / "out"), hdu=1).first().data == [5.0] * 6
    assert {r.name for r in frames.lights(frames.discovered(spark, str(tmp_path))).collect()} == {"a.fits"}


def test_pictures(spark):
    images = spark.createDataFrame([(0, 2, 2, [0.0, 0.5, 1.0, 2.0], [1.0] * 4, [0.0] * 4)], "i int, height int, width int, r array<double>, g array<double>, b array<double>")
    got = pictures.encoded(images, ["i"], ["r", "g", "b"]).first().content
    assert pictures_read.read_png(bytes(got))[0][..., 0].tolist() == [[0, 127], [255, 255]]
    gray = pictures.encoded(images, ["i"], ["r"]).first().content
    assert pictures_read.read_png(bytes(gray))[0][..., 0].tolist() == [[0, 127], [255, 255]]
    raw = bytes(pictures.encoded(images, ["i"], ["r"], "tiff").first().content)
    assert raw[:4] == b"II*\0" and np.frombuffer(raw[8:16], "<u2").tolist() == [0, 32767, 65535, 65535]


def test_settings_and_cache(spark, tmp_path):
    for bad in ({"keep_fraction": 0}, {"sigma": 0}, {"maxiters": 0}, {"saturation_threshold": 2}, {"reference": "any"}):
        with pytest.raises(ValueError):
            StackSettings(**bad).validate()
    with pytest.raises(ValueError):
        LuminanceSettings(bg_cell_size=8).validate()
    assert len(StackSettings().fingerprint()) == 12 and StackSettings().fingerprint() != StackSettings(sigma=2).fingerprint()
    kept = cache.ResultCache(spark, str(tmp_path / "cache"))
    names = spark.createDataFrame([("b",), ("a",)], "name string")
    key = cache.session_key(names, StackSettings().fingerprint())
    assert key == cache.session_key(names.orderBy("name"), StackSettings().fingerprint()) and not kept.has("scores", key)
    calls = []

    def build():
        calls.append(1)
        return names

    for _ in range(2):
        assert kept.fetch("scores", key, build).count() == 2
    assert len(calls) == 1 and kept.status() == [("scores", key)]
    kept.clear("scores")
    assert not kept.has("scores", key)


def test_texts(spark):
    own = spark.createDataFrame([(45.2, 1536), (125.0, 10), (8130.0, 5 * 1024**5)], "s double, b long")
    got = own.select(text.duration(F.col("s")).alias("s"), text.duration(F.col("s"), False).alias("m"), text.byte_size(F.col("b")).alias("b")).collect()
    assert [tuple(r) for r in got] == [("45.2s", "45.2s", "1.5 KB"), ("2m 5s", "2m 5s", "10.0 B"), ("2h 15m 30s", "2h 15m", "5.0 PB")]


def test_empty_sessions_give_empty_results(spark):
    none = spark.createDataFrame([], "session int, frame_id long, height int, width int, data array<double>")
    assert session.stacked_session(none).master.count() == 0
    assert frames.listed(spark.createDataFrame([("a",)], "name string"), frames.frame_list(spark.createDataFrame([], "value string"))).count() == 1


def test_plans_end_to_end(spark):
    rng = np.random.default_rng(8)
    y, x = np.indices((24, 24))
    base = 400 * np.exp(-((y - 12) ** 2 + (x - 12) ** 2) / 10) + 1000
    rows = [(0, i, 24, 24, (np.roll(base, (2 * (i % 2), 0), (0, 1)) + rng.normal(0, 3, base.shape)).ravel().tolist()) for i in range(14)]
    own = spark.createDataFrame(rows, "session int, frame_id long, height int, width int, data array<double>")
    got = session.stacked_session(own, StackSettings(keep_fraction=0.9, align="integer"))
    assert got.scores.where("kept").count() == 12 and got.transforms.where("success").count() == 12
    m = got.master.orderBy("y", "x").select("v").toPandas().v.to_numpy().reshape(24, 24)
    assert m.max() > 1350  # sharp, as the frames were brought together


def test_manifests_are_json(spark, data):
    from starloom.queries import QUERIES

    body = json.loads(QUERIES["manifests"](spark, data).first().manifest)
    assert body["n_kept"] == len(body["kept"]) and {"reason", "name"} == set(body["rejected"][0])


def test_streams_and_batches_agree(spark, data):
    from starloom.streaming import stacking

    events = spark.read.parquet(f"{data}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{data}/events.parque[t]")
    run = stacking.live_moments(stream, ["event_type"], "value").writeStream.outputMode("complete").format("memory").queryName("moments").start()
    run.processAllAvailable()
    run.stop()
    got = {r.event_type: r for r in stacking.mean_and_deviation(spark.table("moments"), ["event_type"]).collect()}
    for r in events.groupBy("event_type").agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect():
        own = got[r.event_type]
        assert own.n == r.n and own["mean"] == pytest.approx(r.m) and own.deviation == pytest.approx(r.s)


def test_pixels_and_tiles_cover_the_frame(spark):
    own = spark.createDataFrame([(0, 5, 7, [float(i) for i in range(35)])], "k int, height int, width int, data array<double>")
    pix = to_pixels(own, ["k"], {"v": "data"}).collect()
    assert all(r.v == r.y * 7 + r.x for r in pix) and len(pix) == 35
    assert sorted(v for r in tiles(own, ["k"], "data", 2, 3).collect() for v in r.data) == [float(i) for i in range(35)]


@pytest.mark.parametrize("ny, nx, height, width", [(4, 4, 40, 37), (8, 15, 80, 150)])
def test_spline_background_matches_truncated_powers(spark, ny, nx, height, width):
    """The same spline as a cubic plus truncated cubes at the inner knots, from a dense system; one cell has no level."""
    cell, half = 10, 5
    rng = np.random.default_rng(ny)
    grid = rng.normal(100, 20, (ny, nx))

    def basis(at, n):
        return np.stack([at**k for k in range(4)] + [np.maximum(at - i, 0) ** 3 for i in range(2, n - 2)], axis=1)

    def along(size, n):
        at = np.clip((np.arange(size) - half) / ((size - 2 * half) / (n - 1)), 0, n - 1)
        return basis(at, n) @ np.linalg.inv(basis(np.arange(n, dtype=float), n))

    rows = [("a", i, j, height, width, float(grid[i, j])) for i in range(ny) for j in range(nx) if (i, j) != (1, 2)]
    grid[1, 2] = np.median([r[-1] for r in rows])
    want = along(height, ny) @ grid @ along(width, nx).T
    levels = spark.createDataFrame(rows, "i string, cy int, cx int, height int, width int, level double")
    pixels = spark.createDataFrame([(i, y, x) for i in "ab" for y in range(height) for x in range(width)], "i string, y int, x int")
    got = background.splined(pixels, background.spline_patches(levels, ["i"], cell), ["i"], cell).toPandas().sort_values(["i", "y", "x"])
    assert np.allclose(got.background[got.i == "a"].to_numpy().reshape(height, width), want) and (got.background[got.i == "b"] == 0).all()


def test_spline_background_follows_a_slope_and_spares_masked_stars(spark):
    rows = [(1, y, x, 50.0 + 2 * y - x + (500.0 if y == x else 0.0), y == x) for y in range(48) for x in range(40)]
    px = spark.createDataFrame(rows, "i int, y int, x int, v double, m boolean")
    got = background.estimated(px, ["i"], "v", 16, mask="m", model="spline").where("y between 8 and 39 and x between 8 and 31").toPandas()
    off = abs(got.background - (50 + 2 * got.y - got.x))  # cells of even size lie half a pixel before their centres
    assert off.max() < 3, got.loc[off.idxmax()]
