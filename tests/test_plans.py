"""Order statistics by refined histograms, the session cache's published states, and mounts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import colour, stencil
from starloom.plans import align, order
from starloom.plans.session_cache import SessionCache

SHARES = {"a": 0.0, "b": 0.5, "c": 25.0, "d": 50.0, "e": 99.9, "f": 100.0}


@pytest.mark.parametrize("bins", [4096, 3])
def test_quantiles_of_odd_groups_are_exact(spark, bins):
    rng = np.random.default_rng(1)
    groups = {
        "normal": rng.normal(0, 1, 999), "tied": rng.integers(0, 3, 500).astype(float), "one": np.array([7.0]), "same": np.full(40, -2.5),
        "wide": np.concatenate([rng.normal(0, 1e-300, 50), rng.normal(0, 1e300, 50), [1.7e308, -1.7e308]]), "two": np.array([1.0, 2.0]),
        "close": 1 + np.arange(64) * 2.0**-52,
    }
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("one", None), ("one", float("nan")), ("one", float("inf")), ("none", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: [r[n] for n in SHARES] for r in order.exact_quantiles(df, ["k"], F.col("v"), SHARES, bins).collect()}
    assert set(got) == {*groups, None} and got[None] == [3.0] * 6
    for k, v in groups.items():
        s = np.sort(v)
        at = [p / 100 * (len(v) - 1) for p in SHARES.values()]
        want = [s[int(np.floor(x))] * (1 - (x - np.floor(x))) + s[int(np.ceil(x))] * (x - np.floor(x)) for x in at]
        assert np.allclose(got[k], want, rtol=1e-12, atol=0), k
    assert order.exact_quantiles(df.where("false"), ["k"], F.col("v"), SHARES).collect() == []
    assert order.exact_quantiles(df.where("k = 'two'"), [], F.col("v"), {"m": 50.0}).first().m == 1.5


def test_quantiles_of_a_large_image_take_few_rounds_and_no_large_group(spark, monkeypatch):
    written = []
    plain = order.cut
    monkeypatch.setattr(order, "cut", lambda df, name, done=(): written.append(name) or plain(df, name, done))
    px = spark.range(0, 2_000_000, 1, 8).select(F.lit(1).alias("i"), (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / (1 << 40)).alias("v"))
    got = order.exact_quantiles(px, ["i"], F.col("v"), {"low": 1.0, "mid": 50.0, "high": 99.5}).first()
    v = px.select("v").toPandas().v.to_numpy()
    assert np.allclose([got.low, got.mid, got.high], np.percentile(v, [1, 50, 99.5]), rtol=1e-12) and len(written) <= 5


def test_stretches_may_take_refined_quantiles(spark):
    px = spark.createDataFrame([(i, y, x, float((i + 3) * y * y + x)) for i in range(2) for y in range(9) for x in range(7)], "i int, y int, x int, v double")
    plain, refined = (colour.percentile_stretched(px, ["i"], "v", quantiles=q).sort("i", "y", "x").toPandas().v for q in (colour.percentiles, order.exact_quantiles))
    assert np.allclose(plain, refined)
    scale = {r.i: r for r in order.robust_scale(px, ["i"], F.col("v")).collect()}
    v = px.where("i = 1").toPandas().v
    assert scale[1].middle == v.median() and scale[1].noise == pytest.approx(1.4826 * (v - v.median()).abs().median())


# ---- cache


def table(spark, n):
    return spark.range(n).toDF("x")


def test_cached_steps_follow_frames_and_settings(spark, tmp_path):
    root, calls = str(tmp_path / "cache"), []
    first = SessionCache(spark, root)
    first.open("frames-1", "settings-1")

    def build(n):
        return lambda: calls.append(n) or table(spark, n)

    for step, n in (("scores", 3), ("transforms", 4), ("stack", 5)):
        assert first.fetch(step, build(n)).count() == n
    again = SessionCache(spark, root)
    again.open("frames-1", "settings-1")
    assert again.fetch("stack", build(99)).count() == 5 and calls == [3, 4, 5]
    again.open("frames-1", "settings-2")  # other settings: scores survive
    assert {s for s, there in again.status().items() if there is True} == {"scores"} and again.fetch("scores", build(98)).count() == 3
    again.open("frames-2", "settings-2")  # other frames: nothing does
    assert not any(v is True for v in again.status().values()) and again.fetch("scores", build(6)).count() == 6
    assert len([d for d in os.listdir(root) if d.startswith("scores-")]) == 1 and not [d for d in os.listdir(root) if d.startswith("stack-")]
    with pytest.raises(ValueError):
        again.save("anything", table(spark, 1))
    again.clear(keep=("scores",))
    assert again.has("scores")
    again.clear()
    assert not again.has("scores") and again.load("scores") is None


def test_a_run_that_breaks_off_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "cache")
    cache = SessionCache(spark, root)
    cache.open("f", "s")
    cache.save("stack", table(spark, 5))

    def lost(state):
        raise RuntimeError("lost")

    monkeypatch.setattr(cache, "_publish", lost)
    with pytest.raises(RuntimeError):
        cache.save("stack", table(spark, 7))  # written, not published
    after = SessionCache(spark, root)
    assert after.load("stack").count() == 5 and len([d for d in os.listdir(root) if d.startswith("stack-")]) == 2
    with pytest.raises(Exception):
        after.save("stack", table(spark, 4).select((F.col("x") / 0).alias("x"), F.expr("cast(raise_error('broken') as int)").alias("y")))
    assert SessionCache(spark, root).load("stack").count() == 5
    assert {n.split("-")[0] for n in after.sweep()} == {"stack"} and after.sweep() == []
    assert sorted(d for d in os.listdir(root) if not d.startswith(".")) == sorted([after.state["steps"]["stack"]["table"], "manifest.json"])
    assert after.load("stack").count() == 5
    (tmp_path / "cache" / "manifest.json").write_text("{ not json")
    assert SessionCache(spark, root).status()["frames_hash"] is None


# ---- mounts


def matrix(turn, dx, dy):
    c, s = np.cos(np.radians(turn)), np.sin(np.radians(turn))
    return [[float(c), float(-s), dx], [float(s), float(c), dy], [0.0, 0.0, 1.0]]


def test_each_session_is_registered_by_its_own_rotation(spark):
    rows = [("still", i, i != 4, matrix(0.01 * i, 3.2 + i, -1.0) if i != 4 else None) for i in range(8)]
    rows += [("turned", i, True, matrix(0.1 * i, 3.2, 5.1)) for i in range(8)] + [("failed", 0, False, None)]
    moves = spark.createDataFrame(rows, "session string, frame_id long, success boolean, matrix array<array<double>>")
    got = {(r.session, r.frame_id): r for r in align.mounted(moves, "eq").collect()}
    assert len(got) == 17 and {r.strategy for k, r in got.items() if k[0] == "turned"} == {"robust_affine"}
    for i in (0, 1, 5, 7):
        m = got["still", i].matrix
        assert got["still", i].strategy == "integer_shift" and m[0][:2] == [1.0, 0.0] and m[1][:2] == [0.0, 1.0]
        assert m[0][2] == 2 * np.rint((3.2 + i) / 2) and m[1][2] == 2 * np.rint(-0.5)
    assert got["turned", 3].matrix == matrix(0.1 * 3, 3.2, 5.1) and got["still", 4].matrix is None and got["failed", 0].rotation == 0
    for mount, name in (("altaz", "affine"), ("eq_robust", "robust_affine")):
        plain = align.mounted(moves, mount)
        assert {r.strategy for r in plain.collect()} == {name} and {(r.session, r.frame_id): r.matrix for r in plain.collect()} == {(r[0], r[1]): r[3] for r in rows}
    with pytest.raises(ValueError):
        align.mounted(moves, "dobson")


# ---- distances


@pytest.mark.parametrize("share", [0.0, 0.002, 0.05, 1.0])
def test_distances_match_all_pairs(spark, share):
    rng = np.random.default_rng(int(share * 1000))
    height, width = 70, 90
    on = rng.random((height, width)) < share
    if share == 0.002:
        on[:, 40:] = False  # columns without a set pixel
    rows = [("a", y, x, bool(on[y, x])) for y in range(height) for x in range(width)] + [("b", 0, 0, None)]
    mask = spark.createDataFrame(rows, "i string, y int, x int, m boolean").repartition(6)
    y, x = np.indices(on.shape)
    lit = np.argwhere(on)
    for metric in ("steps", "straight"):
        got = stencil.distances(mask, ["i"], "m", metric).toPandas().sort_values(["i", "y", "x"])
        own = got[got.i == "a"].d.to_numpy().reshape(on.shape)
        if not len(lit):
            assert np.isnan(own).all()
            continue
        dy, dx = np.abs(y[..., None] - lit[:, 0]), np.abs(x[..., None] - lit[:, 1])
        want = (dy + dx if metric == "steps" else np.hypot(dy, dx)).min(axis=-1)
        assert np.allclose(own, want) and np.isnan(got[got.i == "b"].d).all()
        if metric == "steps":
            for radius in (1, 9, 50):
                grown = stencil.dilated(mask, ["i"], "m", radius).where("i = 'a'").toPandas().sort_values(["y", "x"]).m.to_numpy().reshape(on.shape)
                assert np.array_equal(grown, want <= radius)


def test_growing_shuffles_the_same_whatever_the_radius(spark):
    mask = spark.createDataFrame([(1, y, x, x == y) for y in range(20) for x in range(20)], "i int, y int, x int, m boolean")
    plans = [stencil.dilated(mask, ["i"], "m", r)._jdf.queryExecution().executedPlan().toString() for r in (1, 50)]
    assert all("Generate" not in p and "Join" not in p for p in plans) and plans[0].count("Exchange") == plans[1].count("Exchange")
    with pytest.raises(ValueError):
        stencil.distances(mask, ["i"], "m", "crow")
