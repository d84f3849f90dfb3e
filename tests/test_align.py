"""Aligned sessions against plain numpy: known transforms found by stars, warps, splines, stacks, and small pieces."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom import fixtures as fx
from starloom import queries_align as qa
from starloom.functions.tone import palette_names
from starloom.operators import background, colour, register, stack, tiles
from starloom.operators.pixels import to_pixels
from starloom.plans import align, report, session
from starloom.plans.align import KEYS, SESSION
from starloom.schema import StackSettings
from starloom.sources import session_files

SIDE = 160
FRAMES = "session int, frame_id long, height int, width int, data array<double>"


def field(angle=0.0, dy=0.0, dx=0.0, seed=3, n=36, noise=2.0):
    """A mosaic of stars on a flat sky, turned about the origin and moved, in full-size pixels."""
    rng = np.random.default_rng(7)
    stars = [(rng.uniform(12, SIDE - 12), rng.uniform(12, SIDE - 12), rng.uniform(3000, 20000)) for _ in range(n)]
    y, x = np.indices((SIDE, SIDE), dtype=float)
    image = 500 + np.random.default_rng(seed).normal(0, noise, (SIDE, SIDE))
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    for v, u, flux in stars:
        image += flux / 8 * np.exp(-((y - (s * u + c * v + dy)) ** 2 + (x - (c * u - s * v + dx)) ** 2) / 3)
    return image


def frames(spark, images, session=1):
    return spark.createDataFrame([(session, i, *im.shape, [float(v) for v in im.ravel()]) for i, im in enumerate(images)], FRAMES)


@pytest.fixture(scope="module")
def moved(spark):
    turns = [(0, 0, 0), (2.0, 1.5, -3.0), (-3.0, 4.0, 2.0), (1.0, -2.0, 5.0)]
    images = [field(a, dy, dx, seed=i) for i, (a, dy, dx) in enumerate(turns)]
    return frames(spark, images), images, turns


def test_stars_are_counted_and_placed(spark, moved):
    got = {r.frame_id: r for r in align.star_lists(moved[0]).collect()}
    assert all(15 <= r.n_stars <= 40 for r in got.values())
    assert got[0].stars[0].flux == max(s.flux for s in got[0].stars)
    flat = frames(spark, [np.full((8, 8), 5.0)])
    assert [(r.n_stars, r.stars) for r in align.star_lists(flat, method=None).collect()] == [(0, [])]


def test_components_match_plain_flood():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lit = rng.random((9, 11)) < 0.45
        y, x, group = align.lit_groups(lit)
        at = {(a, b): g for a, b, g in zip(y.tolist(), x.tolist(), group.tolist())}
        seen = {}
        for p in at:
            if p in seen:
                continue
            todo, n = [p], len(seen)
            while todo:
                q = todo.pop()
                if q in seen or q not in at:
                    continue
                seen[q] = n
                todo += [(q[0] + 1, q[1]), (q[0] - 1, q[1]), (q[0], q[1] + 1), (q[0], q[1] - 1)]
        for p in at:
            for q in at:
                assert (at[p] == at[q]) == (seen[p] == seen[q])


def test_transforms_are_recovered(spark, moved):
    lists = align.star_lists(moved[0])
    ref = spark.createDataFrame([(1, 0)], "session int, reference long")
    got = {r.frame_id: r for r in align.transforms_by_stars(lists, ref).collect()}
    for i, (angle, dy, dx) in enumerate(moved[2]):
        assert got[i].success
        m = np.array(got[i].matrix)
        c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
        shift = np.array([dx, dy]) / 2 + (0 if i == 0 else -0.25 + 0.25 * np.array([c - s, s + c]))
        back = np.linalg.inv(np.array([[c, -s, shift[0]], [s, c, shift[1]], [0, 0, 1]]))
        assert np.abs(m[:2, :2] - back[:2, :2]).max() < 0.01
        middle = np.array([SIDE / 4, SIDE / 4, 1])
        assert np.abs((m - back) @ middle)[:2].max() < 0.5
    runs = align.transforms_by_stars(lists.where("frame_id <> 2").unionByName(lists.where("frame_id = 2").withColumn("stars", F.expr(f"cast(array() as {align.STARS})"))), ref)
    bad = {r.frame_id: r for r in runs.collect()}
    assert not bad[2].success and bad[2].error_message and bad[1].success
    assert align.within_failures(runs, 1).count() == 0 and align.within_failures(runs, 2).count() == 4


def plain_warp(image, m):
    inverse = np.linalg.inv(m)
    h, w = image.shape
    out, mask = np.zeros((h, w)), np.zeros((h, w))
    for y in range(h):
        for x in range(w):
            u, v, _ = inverse @ (x, y, 1)
            mask[y, x] = 0 <= np.rint(v) < h and 0 <= np.rint(u) < w
            for a in (math.floor(v), math.floor(v) + 1):
                for b in (math.floor(u), math.floor(u) + 1):
                    if 0 <= a < h and 0 <= b < w:
                        out[y, x] += image[a, b] * (1 - abs(v - a)) * (1 - abs(u - b))
    return out, mask


def test_warped_planes_match_plain_ones(spark):
    rng = np.random.default_rng(2)
    images = [rng.uniform(0, 1000, (12, 10)) for _ in range(3)]
    own = frames(spark, images)
    rows = [(1, i, i != 2, [[math.cos(0.1 * i), -math.sin(0.1 * i), 0.4 * i], [math.sin(0.1 * i), math.cos(0.1 * i), -0.7 * i], [0.0, 0.0, 1.0]]) for i in range(3)]
    tf = spark.createDataFrame(rows, "session int, frame_id long, success boolean, matrix array<array<double>>")
    got = {r.frame_id: r for r in align.warped_planes(own, tf, "superpixel").collect()}
    assert set(got) == {0, 1}
    for i in (0, 1):
        im = images[i]
        for name, plane in (("r", im[::2, ::2]), ("g", (im[::2, 1::2] + im[1::2, ::2]) / 2), ("b", im[1::2, 1::2])):
            want, mask = plain_warp(plane, np.array(rows[i][3]))
            assert np.allclose(got[i][name], want.ravel()) and np.array_equal(got[i].mask, mask.ravel())
    full = {r.frame_id: r for r in align.warped_planes(own, tf, "mosaic").collect()}
    doubled = np.array(rows[1][3]) * [[1, 1, 2], [1, 1, 2], [1, 1, 1]]
    assert np.allclose(full[1].v, plain_warp(images[1], doubled)[0].ravel())


@pytest.mark.parametrize("order", [2, 3, 4])
def test_splines_pass_through_the_samples_and_keep_polynomials(order):
    rng = np.random.default_rng(5)
    image = rng.uniform(0, 9, (14, 17))
    y, x = np.indices(image.shape, dtype=float)
    at = register.spline_at(order)
    assert np.allclose(at(image, y, x), image)
    assert (at(image, y - 20, x) == 0).all()
    big = np.indices((40, 40), dtype=float)
    plane = 3 + 0.5 * big[0] - 0.2 * big[1] + 0.01 * big[0] * big[1]
    inner = (slice(14, 26),) * 2
    v, u = big[0] + 0.3, big[1] - 0.4
    want = 3 + 0.5 * v - 0.2 * u + 0.01 * v * u
    assert np.allclose(at(plane, v, u)[inner], want[inner], atol=1e-3)


def test_bsplines_sum_to_one():
    for order in (1, 2, 3, 4):
        t = np.linspace(0, 1, 11)
        assert np.allclose(sum(register.bspline(t - k, order) for k in range(-4, 6)), 1)


def test_aligned_session_sharpens_turned_frames(spark, moved):
    own, images, _ = moved
    got = align.aligned_session(own, StackSettings(keep_fraction=1.0, debayer="superpixel"))
    scores = {r.frame_id: r for r in got.scores.collect()}
    assert all(r.n_stars >= 15 for r in scores.values())  # stars count in the score
    best = got.references.first().reference
    peak = {}
    for align_by in ("astroalign", "none"):
        s = StackSettings(keep_fraction=1.0, debayer="superpixel", align=align_by)
        master = {(r.y, r.x): r.g for r in align.aligned_session(own, s).master.collect()}
        assert len(master) == (SIDE // 2) ** 2
        peak[align_by] = np.percentile(sorted(master.values()), 99.5)
    ref = (images[best][::2, 1::2] + images[best][1::2, ::2]) / 2
    assert peak["astroalign"] > 0.85 * np.percentile(ref, 99.5) > 1.05 * peak["none"]
    with pytest.raises(ValueError):
        align.aligned_session(own, StackSettings(align="other"))


def test_plane_stack_is_full_size_and_close_to_the_reference(spark, moved):
    own, images, _ = moved
    lists = align.star_lists(own)
    ref = spark.createDataFrame([(1, 0)], "session int, reference long")
    rows = align.plane_stack(own, align.transforms_by_stars(lists, ref), ref).collect()
    assert len(rows) == SIDE * SIDE
    g = np.zeros((SIDE, SIDE))
    for r in rows:
        g[r.y, r.x] = r.g
    inner = (slice(20, SIDE - 20),) * 2
    assert np.corrcoef(g[inner].ravel(), images[0][inner].ravel())[0, 1] > 0.95


def test_a_whole_session_is_processed(spark, moved):
    own, _, _ = moved
    got = align.process_session(own, StackSettings(keep_fraction=1.0))
    lit = got.stretched.agg(F.min(F.least("r", "g", "b")), F.max(F.greatest("r", "g", "b")), F.count(F.lit(1))).first()
    assert lit[0] >= 0 and lit[1] == 1 and lit[2] == SIDE * SIDE
    stats = got.statistics.first()
    assert stats.n_frames == 4 and stats.total_exposure_s == 60 and stats.snr_proxy > 0 and stats.mean_clipped_fraction == 0.03
    best = got.scores.orderBy(F.desc("composite_score"), "frame_id").first().frame_id
    lists = align.star_lists(own)
    ref = spark.createDataFrame([(1, best)], "session int, reference long")
    extra = spark.createDataFrame([(1, 99, True, "", [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]], 0)], align.transforms_by_stars(lists, ref).schema)
    again = align.process_session(own, StackSettings(keep_fraction=1.0), cached=align.transforms_by_stars(lists, ref).union(extra))
    assert again.statistics.first().n_frames == 4
    a = {(r.y, r.x): r.g for r in got.linear.collect()}
    assert all(abs(a[r.y, r.x] - r.g) < 1e-6 for r in again.linear.collect())


def test_settings_choose_by_phase(spark):
    image = field()
    own = frames(spark, [image, np.roll(image, (4, -6), (0, 1))])
    got = align.aligned_session(own, StackSettings(keep_fraction=1.0, align="integer"))
    moves = {r.frame_id: np.array(r.matrix)[:2, 2].tolist() for r in got.transforms.collect()}
    assert sorted(abs(v) for m in moves.values() for v in m) == [0, 0, 4, 6]


def test_one_stack_plan_follows_the_settings(spark, moved):
    own, images, _ = moved
    kept = StackSettings(keep_fraction=1.0)
    sharp = session.stacked_session(own, kept)
    plain = session.stacked_session(own, StackSettings(keep_fraction=1.0, align="none"))
    assert all(r.n_stars >= 15 for r in plain.scores.collect())
    peaks = [np.percentile([r.v for r in s.master.collect()], 99.7) for s in (sharp, plain)]
    assert peaks[0] > 1.05 * peaks[1]
    rows = {(r.y, r.x): r for r in plain.master.collect()}
    assert len(rows) == SIDE * SIDE and {r.n for r in rows.values()} == {4}
    assert abs(rows[5, 5].v - np.mean([i[5, 5] for i in images])) < 1e-6
    assert min(r.n for r in sharp.master.collect()) >= 1  # places that only some frames reach count those
    colours = session.stacked_session(own, StackSettings(keep_fraction=1.0, align="none", debayer="superpixel"))
    assert colours.master.count() == (SIDE // 2) ** 2 and colours.statistics.first().n_frames == 4
    with pytest.raises(ValueError):
        session.stacked_session(own, StackSettings(align="other"))


def test_sessions_that_fail_to_align_give_no_master(spark, moved):
    dark = frames(spark, [np.full((SIDE, SIDE), 5.0)] * 3, session=2)
    got = session.stacked_session(moved[0].union(dark), StackSettings(keep_fraction=1.0, max_align_fail=2))
    assert {r.session for r in got.master.select("session").distinct().collect()} == {1}
    assert {r.session for r in got.statistics.collect()} == {1}


def test_manifests_are_read_back(spark):
    scores = spark.createDataFrame([(1, "a", 1, 0.5, True), (1, "b", 2, 0.25, False)], "session int, name string, rank int, composite_score double, kept boolean")
    lost = spark.createDataFrame([(1, "b", "low_quality_score"), (2, "c", "failed_prefix")], "session int, name string, reason string")
    made = report.manifests(scores, lost, ["session"], "name", "abc").union(spark.createDataFrame([(3, "no manifest"), (4, None)], "session int, manifest string"))
    got = {tuple(r) for r in report.manifest_frames(made, ["session"], "string").collect()}
    assert got == {(1, "a", 1, 0.5, True, None), (1, "b", 2, 0.25, False, "low_quality_score"), (2, "c", None, None, False, "failed_prefix")}


def test_small_rings_are_rejected(spark):
    rows = [(1, y, x, *(3 * [1000.0 if (y - 15) ** 2 + (x - 15) ** 2 <= 9 else 10.0 + (x * 7 + y * 3) % 5])) for y in range(31) for x in range(31)]
    px = spark.createDataFrame(rows, "session int, y int, x int, r double, g double, b double")
    stars = spark.createDataFrame([(1, 15, 15)], "session int, y int, x int")
    assert colour.aperture_fluxes(stars, px, ["session"]).count() == 1
    assert colour.aperture_fluxes(stars, px, ["session"], 4, 6, 6).count() == 0  # twelve pixels in the annulus


def test_sizes_must_agree(spark):
    lum = spark.createDataFrame([(1, y, x, 0.5) for y in range(3) for x in range(3)], "session int, y int, x int, l double")
    rgb = spark.createDataFrame([(1, y, x, 0.5, 0.4, 0.3) for y in range(3) for x in range(2)], "session int, y int, x int, r double, g double, b double")
    with pytest.raises(Exception, match="differ in size"):
        colour.combined_lrgb(lum, rgb, ["session"]).collect()


def test_files_beside_frames(spark, tmp_path):
    assert session_files.shots_info(spark, f"{tmp_path}/*/shotsInfo.json") is None
    for i in (1, 2):
        (tmp_path / str(i)).mkdir()
        (tmp_path / str(i) / "shotsInfo.json").write_text(json.dumps({"exp": i, "target": "M31"}, indent=1))
    got = session_files.shots_info(spark, f"{tmp_path}/*/shotsInfo.json")
    assert sorted((r.exp, r.target) for r in got.collect()) == [(1, "M31"), (2, "M31")]
    one = {"source_path": "a", "reference_path": "b", "success": True, "error_message": "", "matrix": [[1.0, 0.0, 2.0]], "n_matches": 4}
    (tmp_path / "t.json").write_text(json.dumps({"version": "1", "reference": "b", "metadata": {"k": "v"}, "transforms": [one]}, indent=1))
    r = session_files.transforms(spark, f"{tmp_path}/t.json").first()
    assert (r.version, r.reference, r.metadata, r.source_path, r.success, r.matrix) == ("1", "b", {"k": "v"}, "a", True, [[1.0, 0.0, 2.0]])
    kept = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (2, 5, "q")], "session int, frame_id long, name string")
    session_files.write_frame_list(kept, f"{tmp_path}/lists", ["session"])
    text = {r.session: r.value for r in spark.read.text(f"{tmp_path}/lists", wholetext=True).collect()}
    assert text[1].split() == ["z", "b"] and text[2].split() == ["q"]


def test_all_reports_are_written(spark, tmp_path):
    scores = spark.createDataFrame([(1, "a", 1, 0.5, True), (1, "b", 2, 0.1, False)], "session int, name string, rank int, composite_score double, kept boolean")
    lost = spark.createDataFrame([(1, "c", "low_quality_score")], "session int, name string, reason string")
    stats = spark.createDataFrame([(1, 1, 15.0, 0.0, 3.0)], "session int, n_frames int, total_exposure_s double, mean_clipped_fraction double, snr_proxy double")
    where = report.write_all_reports(scores, lost, stats, ["session"], "name", "abc", str(tmp_path))
    assert set(where) == {"manifest", "json", "markdown"}
    assert json.loads(spark.read.text(where["json"], wholetext=True).first().value)["snr_proxy"] == 3.0
    assert json.loads(spark.read.text(where["manifest"], wholetext=True).first().value)["n_kept"] == 1


def test_palette_names():
    got = palette_names(("viridis", "cool"))
    assert got == sorted(set(got)) and "viridis" in got and len(got) == len(palette_names()) + 1


@pytest.mark.parametrize("tile_bytes", [1, 4000, 64 << 20])
def test_tiles_stack_as_pixel_rows_do(spark, tile_bytes):
    """Every reduction over tiles of one place, of some, and of whole frames, against the operators over pixel rows."""
    rng = np.random.default_rng(8)
    rows = []
    for s in ("a", "b"):
        for i in range(13 if s == "a" else 5):
            v, g = rng.normal(100, 5, (2, 42))
            v[rng.random(42) < 0.1] += 500
            g[rng.random(42) < 0.1] -= 300
            w = rng.choice([0.0, 0.3, 0.7, 1.0], 42)
            rows.append((s, i, 6, 7, [None if x < 92 else float(x) for x in v], g.tolist(), w.tolist()))
    rows.append(("c", 0, 6, 7, [1.0] * 42, [2.0] * 42, [0.0] * 42))
    frames = spark.createDataFrame(rows, "session string, frame_id int, height int, width int, v array<double>, g array<double>, w array<double>")
    px = to_pixels(frames, KEYS, {"v": "v", "g": "g", "w": "w"}).cache()
    own = tiles.with_span(frames, SESSION, 3, tile_bytes).withColumn("always", F.col("frame_id") == 2)
    cut = tiles.in_tiles(own, [*KEYS, "width", "span", "always"], ["v", "g", "w"])
    at = [*SESSION, "y", "x"]

    def same(reduction, results, plain, weight=None, always=None):
        got = tiles.tile_pixels(tiles.stacked_tiles(cut, SESSION, "frame_id", ["v", "g"], reduction, list(results), weight, always), SESSION, results)
        got, want = (d.select(*at, *results).toPandas().sort_values(at).reset_index(drop=True) for d in (got, plain))
        assert len(got) == 3 * 42
        for c in results:
            assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True), c

    means = {"v": "double", "g": "double"}
    for centre in ("median", "mean"):
        same(tiles.clip_mean(2.0, 5, centre), means | {"n": "long", "n_kept": "long"}, stack.sigma_clip_mean(px, at, ["v", "g"], 2.0, 5, centre))
    same(tiles.masked_clip_mean(2.0, 4), means | {"coverage": "long"}, stack.mask_aware_clip(px, at, ["v", "g"], "w", 2.0, 4), "w")
    filled = px.na.fill(0.0)
    cut = tiles.in_tiles(own.withColumn("v", F.transform("v", lambda x: F.coalesce(x, F.lit(0.0)))), [*KEYS, "width", "span", "always"], ["v", "g", "w"])
    same(tiles.two_pass(1.5), means | {"coverage": "long"}, stack.two_pass_clip(filled, at, ["v", "g"], "w", 1.5), "w")
    same(tiles.two_pass(1.2, strict=True), means | {"coverage": "long"}, stack.two_pass_clip(filled, at, ["v", "g"], "w", 1.2, strict=True, always=F.col("frame_id") == 2), "w", "always")


def test_tiled_plans_make_no_pixel_rows_of_frames(spark, data):
    """The only generator in the plan stands above the stack; each frame is warped once."""
    plan = align.full_resolution_stack(fx.frames(spark, data), qa.shifts(spark, data))._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("FlatMapGroupsInArrow")[0], plan.split("FlatMapGroupsInArrow")[1]
    assert before.count("Generate") == 1 and "posexplode" not in after and plan.count("MapInPandas") == 1
