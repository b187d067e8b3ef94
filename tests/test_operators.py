"""Operators against their definitions in numpy or on small fixtures."""

import datetime as dt
import io
import math
import tarfile

import numpy as np
import pytest
from data import NOW, episode, frame, tables
from pyspark.sql import functions as F

from armlode.functions import camera as C
from armlode.functions import gripper as G
from armlode.functions import pose as P
from armlode.functions import text as X
from armlode.operators import boxes as B
from armlode.operators import export as E
from armlode.operators import frames as FR
from armlode.operators import joins as J
from armlode.operators import kinematics as K
from armlode.operators import pixels as PX
from armlode.operators import quality as Q
from armlode.operators import registration as R
from armlode.operators import sequence as S
from armlode.plans import acquire as A
from armlode.sources import adapters, files


def lits(v):
    return [F.lit(float(x)) for x in v]


def unit(rng, n):
    q = rng.normal(size=(n, 4))
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def matrix(q):
    return K._matrix(np.asarray(q, dtype=float))


# poses


def test_compose_and_invert_against_matrices(spark):
    rng = np.random.default_rng(0)
    a, b, pa, pb = unit(rng, 30), unit(rng, 30), rng.normal(size=(30, 3)), rng.normal(size=(30, 3))
    rows = [tuple(map(float, (*pa[i], *a[i], *pb[i], *b[i]))) for i in range(30)]
    names = [f"{k}{c}" for k in "ab" for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]
    d = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    get = lambda k: ([F.col(k + c) for c in "xyz"], [F.col(k + c) for c in ("qx", "qy", "qz", "qw")])
    p, q = P.compose(get("a"), get("b"))
    ip, iq = P.compose(get("a"), P.invert(get("a")))
    out = d.select(*[c.alias(f"p{i}") for i, c in enumerate(p)], *[c.alias(f"q{i}") for i, c in enumerate(q)], *[c.alias(f"i{i}") for i, c in enumerate([*ip, *iq])]).collect()
    for i, r in enumerate(out):
        assert np.allclose([r[f"p{k}"] for k in range(3)], pa[i] + matrix(a[i]) @ pb[i], atol=1e-12)
        assert np.allclose(matrix([r[f"q{k}"] for k in range(4)]), matrix(a[i]) @ matrix(b[i]), atol=1e-12)
        assert np.allclose(np.abs([r[f"i{k}"] for k in range(7)]), [0, 0, 0, 0, 0, 0, 1], atol=1e-12)


def test_scale_comes_before_the_base(spark):
    p, _ = P.transform((lits((1000, 0, 0)), lits((0, 0, 0, 1))), (lits((1, 0, 0)), lits((0, 0, 0, 1))), (lits((0, 0, 0)), lits((0, 0, 0, 1))), 0.001)
    assert spark.range(1).select(p[0].alias("x")).first()["x"] == 2.0


def test_euler_is_extrinsic_and_null_rotations_stay_null(spark):
    x, y, z = 0.2, 0.4, -1.0
    q = spark.range(1).select(*[c.alias(str(i)) for i, c in enumerate(P.euler_to_quaternion(*lits((x, y, z))))]).first()
    turn = lambda axis, a: K._turns(np.array([axis], dtype=float), np.array([[a]]))[0, 0]
    assert np.allclose(matrix(list(q)), turn([0, 0, 1], z) @ turn([0, 1, 0], y) @ turn([1, 0, 0], x), atol=1e-12)
    zero = spark.range(1).select(*[c.alias(str(i)) for i, c in enumerate(P.normalize(lits((0, 0, 0, 0))))]).first()
    assert list(zero) == [None] * 4


def test_orientation_error_takes_one_to_the_other(spark):
    rng = np.random.default_rng(1)
    a, b = unit(rng, 20), unit(rng, 20)
    d = spark.createDataFrame([tuple(map(float, (*a[i], *b[i]))) for i in range(20)], ", ".join(f"c{i} double" for i in range(8)))
    e = P.orientation_error([F.col(f"c{i}") for i in range(4)], [F.col(f"c{i}") for i in range(4, 8)])
    for i, r in enumerate(d.select(*[c.alias(str(k)) for k, c in enumerate(e)]).collect()):
        v = np.array(list(r))
        n = np.linalg.norm(v)
        turn = K._turns(np.array([v / n]), np.array([[n]]))[0, 0]
        assert n <= math.pi + 1e-9 and np.allclose(turn @ matrix(a[i]), matrix(b[i]), atol=1e-9)


def test_sign_continuity_equals_the_loop(spark):
    rng = np.random.default_rng(2)
    q = np.concatenate([unit(rng, 150), np.eye(4)[rng.integers(0, 4, 150)] * rng.choice([-1, 1], (150, 1))])
    rng.shuffle(q)
    rows = [(1, i, *map(float, v)) for i, v in enumerate(q)]
    d = spark.createDataFrame(rows, "e int, i int, qx double, qy double, qz double, qw double")
    got = np.array([[r[c] for c in ("qx", "qy", "qz", "qw")] for r in S.continuous_quaternions(d, ["e"], "i").orderBy("i").collect()])
    want = q / np.linalg.norm(q, axis=1, keepdims=True)
    want[want[:, 3] < 0] *= -1
    for i in range(1, len(want)):
        if sum(want[i, k] * want[i - 1, k] for k in range(4)) < 0:
            want[i] *= -1
    assert np.allclose(got, want)


# grippers, cameras, text


def test_gripper_geometry(spark):
    d = spark.createDataFrame([(i / 100 * G.MAX_ANGLE,) for i in range(101)], "a double")
    rows = d.select("a", G.aperture_of_angle(F.col("a")).alias("w"), G.angle_of_aperture(G.aperture_of_angle(F.col("a"))).alias("b")).collect()
    w = [r["w"] for r in rows]
    assert all(x < y for x, y in zip(w, w[1:])) and all(abs(r["a"] - r["b"]) < 1e-12 for r in rows)
    f = spark.range(1).select(*[c.alias(str(i)) for i, c in enumerate(G.finger_angles(F.lit(0.0), F.lit(1.0)))], G.clip(F.lit(None).cast("double"), 0.0, 1.0).alias("n")).first()
    assert list(f)[:4] == [-0.7854, -0.7854, 0.0, 0.0] and f["n"] is None


def test_pinch_centre_does_not_move(spark):
    d = spark.createDataFrame([(i / 4,) for i in range(5)], "g double")
    q = P.normalize(lits((0.1, 0.2, 0.3, 0.9)))
    moved, target = G.keep_pinch_centre((lits((0.1, 0.2, 0.3)), q), F.col("g"))
    now = [m + c for m, c in zip(moved, P.rotate(q, G.pinch_midpoint(F.col("g"))))]
    for r in d.select(*[(a - b).alias(str(i)) for i, (a, b) in enumerate(zip(now, target))]).collect():
        assert max(map(abs, r)) < 1e-12


def test_projection_colour_and_curve(spark):
    r = spark.range(1).select(
        C.project(lits((0.1, 0.2, 2.0)), 100, 100, 50, 60)[0].alias("u"), C.project(lits((0.1, 0.2, 0.0)), 100, 100, 50, 60)[0].alias("behind"), C.linear_to_srgb(C.srgb_to_linear(F.lit(0.5))).alias("s"),
        C.interpolate(F.lit(0.5), F.array(*lits((0, 1, 0.5, 2))), F.array(*lits((0, 10, 20, 30)))).alias("i"), C.interpolate(F.lit(9.0), F.array(*lits((0, 1))), F.array(*lits((0, 5)))).alias("end"), C.psnr(F.lit(0.0)).alias("p"),
    ).first()
    assert r["u"] == 55.0 and r["behind"] is None and abs(r["s"] - 0.5) < 1e-9 and r["i"] == 5.0 and r["end"] == 5.0 and abs(r["p"] - 168.13) < 0.01


def test_names_and_annotations(spark):
    lo, hi = X.archive_range(F.col("p"))
    d = spark.createDataFrame([("observations/410/648773-660695.tar", "30000/1001"), ("other.tar", "25")], "p string, f string")
    r = d.select(lo.alias("lo"), hi.alias("hi"), X.frame_rate(F.col("f")).alias("fps"), X.slug(F.lit("  Foo--Bar 2!")).alias("s"), X.start_frame(F.lit(2.5), F.lit(1.0)).alias("even")).collect()
    assert (r[0]["lo"], r[0]["hi"]) == (648773, 660695) and r[1]["lo"] is None and abs(r[0]["fps"] - 29.97002997) < 1e-6 and r[1]["fps"] == 25.0 and r[0]["s"] == "foo_bar_2" and r[0]["even"] == 2
    a = spark.createDataFrame([(([(0, 10), (10, 25)],),), (None,)], "l struct<action_config:array<struct<start_frame:int,end_frame:int>>>")
    assert [x[0] for x in a.select(X.action_frames(F.col("l"))).collect()] == [25, 0]


# sequences


def seq(spark, flags):
    return spark.createDataFrame([(1, i, f) for i, f in enumerate(flags)], "e int, i int, ok boolean")


def test_runs(spark):
    flags = [True] * 3 + [False] * 2 + [True] * 6 + [False] + [True] * 5
    out = [r["ok"] for r in S.drop_short_runs(seq(spark, flags), ["e"], ["i"], "ok", 6).orderBy("i").collect()]
    assert out == [False] * 5 + [True] * 6 + [False] * 6
    got = {(r["start"], r["end"]) for r in S.extract_runs(seq(spark, flags), ["e"], "i", "ok").collect()}
    assert got == {(0, 3), (5, 11), (12, 17)}


def test_held_states_become_smooth(spark):
    held = [0, 0, 0, 0.25, 0.25, 0.25, *[1.0] * 6]
    d = spark.createDataFrame([(1, i, i / 10, float(v)) for i, v in enumerate(held)], "e int, i int, t double, v double")
    out = [r["s"] for r in S.smoothstep_events(d, ["e"], "i", "t", "v", 1.0, 0.3, "s").orderBy("i").collect()]
    assert [out[i] for i in (0, 2, 5, 6, 11)] == [0, 0, 1, 1, 1] and 0 < out[3] < out[4] < 1


def test_balanced_ranges_budget_and_windows(spark):
    d = seq(spark, [True] * 10)
    assert [(r["start"], r["end"]) for r in S.balanced_ranges(d, ["e"], "i", 3).orderBy("part").collect()] == [(0, 4), (4, 7), (7, 10)]
    b = S.budget_prefix(d.withColumn("s", F.lit(3)), ["e"], ["i"], "s", 7)
    assert sorted(r["i"] for r in b.collect()) == [0, 1, 2]
    w = S.best_window(d.withColumn("step", F.when(F.col("i").between(4, 6), 5.0).otherwise(0.0)), ["e"], "i", "step", "ok", 4).first()
    assert (w["start"], w["end"], w["score"]) == (4, 8, 15.0)
    o = S.overlap_windows(d, ["e"], "i", 4, 3).orderBy("i").collect()
    assert [r["windows"] for r in o] == [1, 1, 1, 2, 1, 1, 2, 1, 1, 1]


def test_track_smoothing_equals_numpy(spark):
    rng = np.random.default_rng(3)
    v = [None if rng.random() < 0.3 else float(x) for x in rng.normal(size=40)]
    v[0] = v[39] = None
    d = spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "e int, i int, v double")
    got = [r["s"] for r in S.smooth_track(d, ["e"], "i", "v", "s").orderBy("i").collect()]
    have = [i for i, x in enumerate(v) if x is not None]
    f = np.interp(np.arange(40), have, [v[i] for i in have])
    m = np.array([np.median(np.pad(f, 3, mode="edge")[i : i + 7]) for i in range(40)])
    k = np.exp(-0.5 * (np.arange(-5, 6) / 1.25) ** 2)
    want = np.convolve(np.pad(m, 5, mode="edge"), k / k.sum(), mode="valid")
    assert np.allclose(got, want, atol=1e-12)


def test_rates_rebase_durations_and_slices(spark):
    d = spark.createDataFrame([(1, i, t, q) for i, (t, q) in enumerate([(0.0, 0.0), (0.1, 1.0), (0.3, 1.0), (0.4, 3.0)])], "e int, i int, t double, q double")
    r = S.rates(d, ["e"], "i", "t", ["q"]).orderBy("i").collect()
    assert np.allclose([x["v_q"] for x in r], [0, 10, 0, 20]) and np.allclose([x["a_q"] for x in r], [0, 0, -10 / 0.15, 20 / 0.15])
    u = S.durations(d, ["e"], "i", "t").first()
    assert u["increasing"] and abs(u["period"] - 0.1) < 1e-12 and abs(u["duration"] - 0.5) < 1e-12
    one = S.durations(d.limit(1), ["e"], "i", "t").first()
    assert abs(one["duration"] - 1 / 30) < 1e-12
    ns = spark.createDataFrame([(1, 1734693131578195000 + x) for x in (0, 33333333, 66666667)], "e int, ns long")
    assert sorted(x["s"] / 1e9 for x in S.rebase(ns, ["e"], "ns", "s").collect()) == [0.0, 0.033333333, 0.066666667]


def test_moving_sides(spark):
    at = lambda i, s: (0.3 + (0.01 * i if s else 0.0), 0.0, 0.2, 0.0, 0.0, 0.0, 1.0)
    f, e, _ = tables(spark, [frame(i=i, side=s, pose=at(i, s)) for i in range(20) for s in (0, 1)], [episode()])
    m = {r["side"]: r["moves"] for r in S.moving_sides(S.motion(FR.canonical(f), ["episode_id", "side"], "frame_idx")).collect()}
    assert m == {0: False, 1: True}


# joins and plans


def test_joins(spark):
    r = spark.createDataFrame([("a", 1, 5), ("b", 60, 70), ("c", 200, 190), ("d", 0, 1000)], "n string, lo int, hi int")
    p = spark.createDataFrame([(5,), (64,), (5,), (195,)], "p int")
    assert sorted(x["n"] for x in J.in_ranges(r, p, "lo", "hi", "p").collect()) == ["a", "b", "d"]
    left = spark.createDataFrame([(1, 10), (1, 25), (2, 5)], "k int, at int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 25, "y"), (2, 9, "z")], "k int, at int, v string")
    assert [r["v"] for r in J.as_of(left, right, ["k"], "at", ["v"]).orderBy("k", "at").collect()] == ["x", "y", None]
    seg = spark.createDataFrame([(1, 0, 12, "a"), (1, 10, 20, "b")], "k int, lo int, hi int, v string")
    out = J.within_segments(left, seg, ["k"], "at", "lo", "hi").orderBy("k", "at").collect()
    assert [(r["inside"], r["v"] if r["inside"] else None) for r in out] == [(True, "b"), (False, None), (False, None)]
    last = J.lookup_last(left, spark.createDataFrame([(1, 1, "old"), (1, 2, "new")], "k int, o int, v string"), ["k"], ["o"], ["v"]).orderBy("k", "at").collect()
    assert [r["v"] for r in last] == ["new", "new", None]


def test_plans(spark):
    d = spark.createDataFrame([("s", 1, ["Fold the Towel"]), ("s", 2, ["push"]), ("s", 3, None), ("t", 1, ["push"]), ("t", 2, [])], "k string, i int, tasks array<string>")
    assert sorted((r["k"], r["i"]) for r in A.keyword_select(d, ["k"], "tasks", ["towel"]).collect()) == [("s", 1), ("t", 1), ("t", 2)]
    with pytest.raises(ValueError):
        A.check_ceiling(A.CEILING + 1)
    names = spark.createDataFrame([("observations/1/10-20.tar",), ("observations/1/30-40.tar",), ("proprio_stats/a.tar",), ("readme",)], "name string")
    got = {r[0] for r in A.required_archives(names, spark.createDataFrame([(15,)], "e long"), "name", "e").collect()}
    assert got == {"observations/1/10-20.tar", "proprio_stats/a.tar"}


def test_files_are_hashed_verified_and_unpacked(spark, tmp_path):
    (tmp_path / "data.bin").write_bytes(b"sample")
    rec = files.file_records(spark, str(tmp_path), "*.bin").withColumn("file", F.element_at(F.split("file", "/"), -1))
    r = rec.first()
    plan = spark.createDataFrame([("data.bin", 6, r["sha256"]), ("gone.bin", 1, "x"), ("data.bin", 6, "0" * 64), ("data.bin", 7, r["sha256"])], "file string, bytes long, sha256 string")
    assert sorted((x["file"], x["problem"]) for x in A.verify_files(plan, rec).collect()) == [("data.bin", "hash mismatch"), ("data.bin", "size mismatch"), ("gone.bin", "missing")]
    with tarfile.open(tmp_path / "1-2.tar", "w") as t:
        for name in ("a/ok.txt", "a/../../climbs.txt", "b/other.txt"):
            info = tarfile.TarInfo(name)
            info.size = 2
            t.addfile(info, io.BytesIO(b"hi"))
        link = tarfile.TarInfo("a/link")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        t.addfile(link)
    m = files.tar_members(spark, str(tmp_path), ("a/",), strip=1).collect()
    assert [(x["member"], bytes(x["content"])) for x in m] == [("ok.txt", b"hi")]


def test_arrays_images_and_order(spark, tmp_path):
    (tmp_path / "d").mkdir()
    np.save(tmp_path / "d/000003.npy", np.full((2, 3), np.inf))
    np.savez(tmp_path / "d/000004.npz", other=np.zeros((1, 1)), depth_m=np.full((2, 2), 0.7))
    out = {r["frame_idx"]: r for r in files.depth_frames(spark, str(tmp_path / "d")).collect()}
    assert out[3]["depth_m"] == [math.inf] * 6 and (out[4]["h"], out[4]["w"]) == (2, 2) and abs(out[4]["depth_m"][0] - 0.7) < 1e-6
    a = np.arange(12, dtype=np.uint8).reshape(3, 4)
    layer = spark.createDataFrame([("c1", 7, 3, 4, 1, bytearray(a.tobytes()))], PX.LAYER)
    assert files.write_images(layer, str(tmp_path / "png")).count() == 1
    back = files.image_frames(spark, str(tmp_path / "png")).first()
    assert (back["clip"], back["frame_idx"], back["c"]) == ("c1", 7, 1) and bytes(back["data"]) == a.tobytes()
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "p/a.parquet"))
    spark.range(2).withColumn("extra", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "p/b.parquet"))
    d = files.ordered_parquet(spark, str(tmp_path / "p")).orderBy("_file", "_row")
    assert [r["id"] for r in d.collect()] == [0, 1, 2, 0, 1] and "extra" in d.columns
    t, pose = np.array([0.0, 0.1]), np.tile([0, 0, 0, 0, 0, 0, 1.0], (2, 2, 1))
    (tmp_path / "e").mkdir()
    np.savez(tmp_path / "e/e.npz", timestamp=t, ee_pose=pose, gripper=np.zeros((2, 2)), feasible=np.array([True, False]))
    rows = files.episode_npz(spark, str(tmp_path / "e")).orderBy("frame_idx", "side").collect()
    assert len(rows) == 4 and rows[0]["feasible"] and rows[3]["t"] == 0.1


# adapters


def test_adapters(spark):
    d = spark.createDataFrame([(0, 5.0, [0.0] * 6 + [99.0], [1.0] + [0.0] * 5 + [99.0], 0.2, 1.0), (0, 5.1, [0.0] * 7, [1.0] + [0.0] * 6, 0.4, 0.0), (1, 0.0, [0.0] * 3, None, None, None)], "episode_index int, timestamp double, left_pose array<double>, right_pose array<double>, left_gripper double, right_gripper double")
    s = adapters.SourceSettings("two", {"timestamp": "timestamp", "left_pose": "left_pose", "right_pose": "right_pose", "left_gripper": "left_gripper", "right_gripper": "right_gripper"}, rotation="euler", gripper_mode="signed")
    with pytest.raises(ValueError):
        adapters.to_frames(d, s)
    rows = {(r["episode_id"], r["frame_idx"], r["side"]): r for r in adapters.to_frames(d, s, allow_uncalibrated=True).collect()}
    assert rows[0, 0, 0]["pose"]["x"] == 1.0 and rows[0, 0, 0]["pose"]["qw"] == 1.0 and rows[0, 0, 0]["gripper"] == 1.0 and rows[0, 1, 0]["gripper"] == 0.0 and abs(rows[0, 1, 1]["t"] - 0.1) < 1e-9
    assert rows[1, 0, 1]["pose"] is None and rows[1, 0, 0]["gripper"] is None
    one = adapters.SourceSettings("one", {"timestamp": "timestamp", "pose": "right_pose", "gripper": "right_gripper"}, rotation="euler", sides=("right",), gripper_mode="width_mm", gripper_open=1.0, gripper_closed=0.0, calibrated=True, tool={"left": (0.0,) * 6 + (1.0,)})
    with pytest.raises(KeyError):
        adapters.to_frames(d, one)
    with pytest.raises(ValueError):
        adapters.closure(d, "right_gripper", ["episode_index"], adapters.SourceSettings("x", {}, gripper_mode="calibrated"), "g")


# registration


def test_rotation_means_and_rigid_fits(spark):
    rng = np.random.default_rng(4)
    q = unit(rng, 1)[0]
    near = q + 0.05 * rng.normal(size=(50, 4))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    d = spark.createDataFrame([(1, *map(float, v * s)) for v, s in zip(near, rng.choice([-1, 1], 50))], "k int, a double, b double, c double, d double")
    m = R.rotation_means(d, ["k"], [F.col(c) for c in "abcd"]).first()
    want = np.linalg.eigh(near.T @ near)[1][:, -1]
    assert abs(abs(np.dot([m["qx"], m["qy"], m["qz"], m["qw"]], want)) - 1) < 1e-9
    rot, t = matrix(q), np.array([0.4, -0.5, 0.2])
    a = rng.normal(size=(6, 3))
    b = a @ rot.T + t
    rows = [(1, *map(float, (*x, *y))) for x, y in zip(a, b)] + [(2, float(i), 0.0, 0.0, 0.0, float(i), 0.0) for i in range(3)] + [(3, 0.0, 0.0, 0.0, 0.0, None, 0.0)]
    f = {r["k"]: r for r in R.rigid_fits(spark.createDataFrame(rows, "k int, ax double, ay double, az double, bx double, by double, bz double"), ["k"], [F.col(f"a{c}") for c in "xyz"], [F.col(f"b{c}") for c in "xyz"]).collect()}
    p = f[1]["pose"]
    assert np.allclose([p["x"], p["y"], p["z"]], t, atol=1e-9) and np.allclose(matrix([p["qx"], p["qy"], p["qz"], p["qw"]]), rot, atol=1e-9) and f[1]["rms"] < 1e-6 and f[2]["pose"] is None


def test_registration_brings_the_workspace_home(spark):
    rng = np.random.default_rng(5)
    homes = {"right": (0.3, -0.2, 0.3, 0.0, 0.0, 0.0, 1.0), "left": (0.3, 0.2, 0.3, 0.0, 0.0, 0.0, 1.0)}
    turn = np.array([0, 0, math.sin(0.4), math.cos(0.4)])
    rows = []
    for s in (0, 1):
        for i in range(41):
            p = matrix(turn) @ (np.array([0.3, -0.2 if s == 0 else 0.2, 0.3]) + 0.05 * rng.normal(size=3)) + np.array([1.0, 2.0, 0.1])
            rows.append(frame(i=i, side=s, pose=tuple(map(float, (*p, *turn)))))
    f, e, _ = tables(spark, rows, [episode()])
    reg = R.auto_register(FR.canonical(f), homes)
    out = R.apply_registration(FR.canonical(f).select("episode_id", "side", "frame_idx", "pose"), reg, FR.active_sides(e))
    mid = out.groupBy("side").agg(F.percentile("pose.x", 0.5).alias("x"), F.percentile("pose.y", 0.5).alias("y"), F.avg(F.abs(F.col("pose.qw"))).alias("w")).collect()
    assert all(abs(r["x"] - 0.3) < 0.06 and abs(r["y"] - (-0.2 if r["side"] == 0 else 0.2)) < 0.06 and r["w"] > 0.999 for r in mid)
    right = R.apply_registration(FR.canonical(f).select("episode_id", "side", "frame_idx", "pose"), reg, FR.active_sides(e).filter("side = 0")).filter("side = 1")
    assert {tuple(r["pose"]) for r in right.collect()} == {r[5] for r in rows if r[2] == 1}


# export


def test_export_of_two_runs(spark):
    ok = [True, True, False, True]
    rows = [frame(i=i, side=s, gripper=1.0 if s == 0 else 0.5, pe=0.001 if ok[i] else 1.0) for i in range(4) for s in (0, 1)]
    f, e, _ = tables(spark, rows, [episode(task="t")])
    limits = Q.Limits(run_frames=1)
    out = E.export_rows(f, e, 30, limits).orderBy("index").collect()
    assert [(r["episode_index"], r["frame_index"], r["index"]) for r in out] == [(0, 0, 0), (0, 1, 1), (1, 0, 2)]
    assert out[0]["action"][7] == 0.0 and abs(out[0]["action"][15] - 0.3927) < 1e-6 and len(out[0]["action"]) == 16
    v = E.validate_export(E.export_rows(f, e, 30, limits), E.export_runs(f, e, limits)).first()
    assert v["ok"] and (v["frames"], v["episodes"]) == (3, 2)
    broken = E.export_rows(f, e, 30, limits).filter("index <> 1")
    assert not E.validate_export(broken, E.export_runs(f, e, limits)).first()["ok"]


# kinematics


def test_forward_jacobian_and_solver():
    chain = K.default_chain()
    rng = np.random.default_rng(6)
    q = rng.uniform(-1, 1, (20, 7))
    tip, rot, places, axes = K.forward(chain, q)
    j = K.jacobian(tip, places, axes)
    for k in range(7):
        d = np.zeros(7)
        d[k] = 1e-6
        assert np.allclose((K.forward(chain, q + d)[0] - tip) / 1e-6, j[:, :3, k], atol=1e-5)
    out = K.solve(chain, q + rng.uniform(-0.1, 0.1, q.shape), tip, rot, K.SolverSettings())
    assert out["ok"].all() and (out["ep"] < 1e-3).all()


def test_episodes_are_solved_and_smoothed(spark):
    chain = K.default_chain()
    rows = []
    for i in range(25):
        q = np.array([[0.2 + 0.02 * i, 0.5, -0.2, 0.8, 0.1, 0.3, 0.0]])
        tip, rot, _, _ = K.forward(chain, q)
        v = R._quaternion(rot)[0]
        rows.append(frame(i=i, pose=tuple(map(float, (*tip[0], *v)))))
    rows.append(frame(i=25, pose=(9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)))
    rows.append((1, 26, 0, "A b", 2.6, None, None, None, None, None, None, None, None, NOW))
    f, _, _ = tables(spark, rows)
    out = K.solve_episodes(f).orderBy("frame_idx").collect()
    assert all(r["ik_success"] for r in out[:25]) and not out[25]["ik_success"] and out[26]["q"] is None and math.isinf(out[26]["jacobian_condition"])
    s = K.smooth_trajectories(f).orderBy("frame_idx").collect()
    n = 26
    b = np.array([[x + 0.01 * i + 0.003 * math.sin(1.3 * i) for x in (0.0,) * 7] for i in range(n)])
    d2 = np.diff(np.eye(27), n=2, axis=0)
    w = np.diag([1.0] * n + [1e-9])
    want = np.linalg.solve(w + 3 * d2.T @ d2, w @ np.vstack([b, np.zeros(7)]))
    assert np.allclose([r["smooth"] for r in s], want, atol=1e-6)


def test_choices(spark):
    a = spark.createDataFrame([(1, True), (1, False), (2, True)], "k int, feasible boolean")
    b = spark.createDataFrame([(1, True), (1, True), (2, True)], "k int, feasible boolean")
    assert {r["k"]: r["chosen"] for r in K.choose_registration(a, b, ["k"]).collect()} == {1: "alternative", 2: "shared"}


# images


def layer(spark, arrays, clip="c"):
    return spark.createDataFrame([(clip, i, a.shape[0], a.shape[1], 1 if a.ndim == 2 else a.shape[2], bytearray(a.astype(np.uint8).tobytes())) for i, a in enumerate(arrays)], PX.LAYER)


def square(y, x, n, shape=(12, 12)):
    a = np.zeros(shape, dtype=np.uint8)
    a[y : y + n, x : x + n] = 255
    return a


def test_mask_operators(spark):
    a, b = square(2, 2, 4), square(2, 3, 4)
    o = PX.overlaps(layer(spark, [a]), layer(spark, [b])).first()
    assert abs(o["iou"] - 0.6) < 1e-12 and o["containment"] == 0.75
    empty = PX.overlaps(layer(spark, [a * 0]), layer(spark, [a * 0])).first()
    assert empty["iou"] == 1.0 and empty["containment"] == 0.0
    t = PX.temporal_max(layer(spark, [a * 0, a, a * 0, a * 0, a * 0]), 1).orderBy("frame_idx").collect()
    assert [sum(r["data"]) > 0 for r in t] == [True, True, True, False, False]
    near, far = square(2, 7, 2), square(9, 9, 3)
    fused = PX.fuse_masks(layer(spark, [a]), layer(spark, [near | far]), 2, 2).first()
    m = PX.image(bytes(fused["data"]), 12, 12, 1) > 0
    assert m[2, 7] and not m[10, 10]
    hole = square(2, 2, 6)
    hole[4, 4] = 0
    refined = PX.image(bytes(PX.refine_masks(layer(spark, [hole]), layer(spark, [square(2, 2, 1)]), 1, 1).first()["data"]), 12, 12, 1) > 0
    assert refined[4, 4] and refined[1, 3] and not refined[2, 2]
    corner = np.zeros((12, 12), dtype=np.uint8)
    corner[2:9, 2] = corner[8, 2:9] = 255
    hull = PX.image(bytes(PX.protect_hulls(layer(spark, [corner]), 0, 3).first()["data"]), 12, 12, 1) > 0
    assert hull[6, 3] and not hull[3, 8]
    label, n = PX.components(np.array([[1, 1, 0], [0, 0, 0], [0, 1, 1]], dtype=bool))
    assert n == 2 and label[0, 0] != label[2, 1]


def test_mask_audit_and_parity(spark):
    ok = PX.audit_masks(layer(spark, [square(2, 2 + (i % 2), 4) for i in range(6)])).first()
    assert ok["ok"] and ok["empty"] == 0
    assert not PX.audit_masks(layer(spark, [square(2, 2, 4), square(2, 2, 4) * 0])).first()["ok"]
    p = PX.parity(a=layer(spark, [square(0, 0, 1)] * 3), b=layer(spark, [square(0, 0, 1)] * 2)).first()
    assert p["missing"] == 1


def test_clean_plate_and_change(spark):
    rng = np.random.default_rng(7)
    back = (40 + 5 * np.arange(12)[None, :] + np.zeros((12, 1))).astype(np.uint8)
    video, masks = [], []
    for i in range(8):
        m = square(4, i, 4)
        video.append(np.where(m > 0, 220, back + rng.integers(0, 2, back.shape)).astype(np.uint8))
        masks.append(m)
    p = {(r["y"], r["x"]): r for r in PX.clean_plate(layer(spark, video), layer(spark, masks), tile=5).collect()}
    assert len(p) == 144 and max(abs(r["value"] - back[y, x]) for (y, x), r in p.items()) <= 1.0 and all(r["reliable"] for r in p.values())
    hidden = PX.clean_plate(layer(spark, video), layer(spark, [square(0, 0, 2)] * 8)).filter("y = 0 and x = 0").first()
    assert hidden["value"] is None and not hidden["reliable"]
    c = PX.change_metrics(layer(spark, [back]), layer(spark, [np.where(square(4, 4, 4) > 0, back + 90, back)]), layer(spark, [square(4, 4, 4)])).first()
    assert c["outside_sum"] == 0 and c["inside_sum"] / c["inside_count"] == 90 and c["copy_fraction"] == 0


def test_alpha_over_in_linear_light(spark):
    f = np.array([[[100, 200, 0, 128]]], dtype=np.uint8)
    b = np.full((1, 1), 10, dtype=np.uint8)
    lin = list(PX.alpha_over(layer(spark, [b]), layer(spark, [f])).first()["data"])
    dis = list(PX.alpha_over(layer(spark, [b]), layer(spark, [f]), linear=False).first()["data"])
    assert np.allclose(dis, [55, 105, 5], atol=1) and all(x >= y - 1 for x, y in zip(lin, dis))
    h = PX.harmonise(layer(spark, [np.dstack([square(2, 2, 8)] * 3 + [square(2, 2, 8)]), np.zeros((12, 12, 4), dtype=np.uint8)]), layer(spark, [square(0, 0, 12) // 2] * 2)).orderBy("frame_idx").collect()
    assert h[0]["gain"] == h[1]["gain"] and h[0]["shift"] is not None


def test_more_image_operators(spark):
    a, b = square(2, 2, 4), square(8, 0, 3)
    u = PX.union_masks(layer(spark, [a]).union(layer(spark, [b]))).first()
    assert sum(bytes(u["data"])) == (16 + 9) * 255
    e = PX.image(bytes(PX.edge_components(layer(spark, [a | b])).first()["data"]), 12, 12, 1)
    assert e[9, 1] and not e[3, 3]
    v = [np.full((12, 12), 10 * i, dtype=np.uint8) for i in range(3)]
    o = [x.copy() for x in v]
    o[2] = o[2] + 4
    t = PX.temporal_change(layer(spark, v), layer(spark, o), layer(spark, [square(0, 0, 6)] * 3)).orderBy("frame_idx").collect()
    assert [r["count"] for r in t] == [108, 108] and [r["changed_sum"] / r["count"] for r in t] == [0.0, 4.0]
    small = square(2, 2, 1)
    rest = PX.restore_protected(layer(spark, [x + 100 for x in v]), layer(spark, v), layer(spark, [a, a, small])).orderBy("frame_idx").collect()
    assert [PX.image(bytes(r["data"]), 12, 12, 1)[2, 2] for r in rest] == [100, 110, 20]
    rgba = [np.dstack([a] * 4), np.zeros((12, 12, 4), dtype=np.uint8)]
    rep = PX.render_report(layer(spark, rgba)).first()
    assert not rep["ok"] and rep["empty"] == 1 and abs(rep["visible_fraction"] - 8 / 144) < 1e-12
    z = np.where(a > 0, 0.7, np.inf)
    depth = spark.createDataFrame([("c", 0, 12, 12, z.ravel().tolist())], "clip string, frame_idx long, h int, w int, depth_m array<float>")
    assert PX.depth_report(depth, layer(spark, rgba[:1])).first()["ok"] and not PX.depth_report(depth, layer(spark, rgba)).first()["ok"]
    other = [np.dstack([a, a, a, b]), rgba[1]]
    assert PX.same_alpha(layer(spark, rgba), layer(spark, other)).first()["different"] == 1
    p = PX.panels(x=layer(spark, [a]), y=layer(spark, [rgba[0]])).first()
    assert (p["h"], p["w"], p["c"]) == (12, 24, 3)
    l = {r["layer"]: r["levels"] for r in PX.light_samples(layer(spark, rgba), layer(spark, [a * 0 + 40] * 2)).collect()}  # noqa: E741
    assert l["front"] == [255.0] * 3 and l["back"] == [40.0] * 3


def test_lens(spark):
    a = np.zeros((40, 60, 4), dtype=np.uint8)
    a[10:30, 15:45] = (200, 100, 50, 255)
    k, none, lens = (50.0, 50.0, 29.5, 19.5), (0.0,) * 5, (-0.2, 0.05, 0.001, -0.001, 0.0)
    same = PX.image(bytes(PX.through_lens(layer(spark, [a]), k, none).first()["data"]), 40, 60, 4)
    assert (same == a).all()
    v, u = PX._lens_map(40, 60, k, lens)
    x, y = (u - k[2]) / k[0], (v - k[3]) / k[1]
    r2 = x * x + y * y
    f = 1 + r2 * (lens[0] + r2 * lens[1])
    xd, yd = x * f + 2 * lens[2] * x * y + lens[3] * (r2 + 2 * x * x), y * f + lens[2] * (r2 + 2 * y * y) + 2 * lens[3] * x * y
    yy, xx = np.mgrid[:40, :60]
    assert np.abs(xd * k[0] + k[2] - xx).max() < 1e-2 and np.abs(yd * k[1] + k[3] - yy).max() < 1e-2
    bent = PX.image(bytes(PX.through_lens(layer(spark, [a]), k, lens).first()["data"]), 40, 60, 4)
    on = bent[..., 3] > 8
    assert bent[..., 3].sum() < a[..., 3].astype(int).sum() and np.abs(bent[on][:, :3].astype(int) - [200, 100, 50]).max() <= 16
    z = np.where(a[..., 3] > 0, 0.7, np.inf)
    d = spark.createDataFrame([("c", 0, 40, 60, z.ravel().tolist())], "clip string, frame_idx long, h int, w int, depth_m array<float>")
    out = np.array(PX.depth_through_lens(d, k, lens).first()["depth_m"])
    assert np.allclose(out[np.isfinite(out)], 0.7, atol=1e-6) and 300 < np.isfinite(out).sum() <= 600


def test_boxes(spark):
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    rows = [(0, 0, 0.9, (0.0, 0.0, 640.0, 480.0)), (0, 1, 0.8, (10.0, 100.0, 200.0, 300.0)), (0, 2, 0.7, (400.0, 100.0, 600.0, 300.0)), (0, 3, 0.7, (410.0, 100.0, 600.0, 300.0)), (0, 4, 0.99, (5.0, 5.0, 4.0, 9.0))]
    d = spark.createDataFrame(rows, f"frame_idx int, place int, score double, box {box}")
    out = {r["half"]: r for r in B.robot_boxes(d, ["frame_idx"], 640, 480, 0.1).collect()}
    assert set(out) == {"left", "right"} and out["left"]["box"]["xmin"] == 0.0 and out["right"]["box"]["xmin"] == 380.0
    assert [r["rank"] for r in B.prompt_boxes(d, ["frame_idx"], 640, 480, 1).collect()] == [1]


# quality


def test_feasibility_needs_every_active_side(spark):
    rows = [frame(i=i, side=s, pe=0.02 if (s == 1 and i == 9) else 0.001) for i in range(20) for s in (0, 1)]
    f, e, _ = tables(spark, rows, [episode()])
    r = Q.feasibility_report(f, e).first()
    assert (r["frames"], r["feasible_frames"], r["runs"]) == (20, 19, 2)
    f, e, _ = tables(spark, rows, [episode(sides=("right",))])
    assert Q.feasibility_report(f, e).first()["feasible_frames"] == 20
    a = Q.audit(f, e).first()
    assert a["ok"] and a["errors"] == "" and a["used_rows"] == 20
    assert {r["problem"] for r in FR.violations(FR.canonical(tables(spark, [frame(), frame(i=1, gripper=1.5), frame(i=2, t=0.05)])[0])).collect()} == {"gripper out of range", "time not increasing"}
