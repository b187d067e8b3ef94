import math

from data import NOW, config, episode, frame, tables
from pyspark.sql import functions as F

from armlode.operators import regrid


def grid(spark, rows, episodes=None, configs=None):
    return regrid.regular_grid(*tables(spark, rows, [episode()] if episodes is None else episodes, [config()] if configs is None else configs))


def test_missing_slots_of_each_side(spark):
    rows = [frame(i=i) for i in range(10) if i not in (3, 4)] + [frame(i=i, side=1, t=i / 10 + 0.02) for i in range(6)]
    got = {tuple(r) for r in grid(spark, rows).filter("missing").select("episode_id", "side", "slot").collect()}
    assert got == {(1, 0, 3), (1, 0, 4), (1, 1, 6), (1, 1, 7), (1, 1, 8), (1, 1, 9)}


def test_rate_of_the_source_null_times_and_late_rows(spark):
    rows = [frame(i=i, t=i / 5) for i in (0, 1, 3)] + [frame(i=2, t=None) for _ in range(1)]
    rows = [r if r[1] != 2 else (*r[:4], None, *r[5:]) for r in rows][::-1] + [frame(i=0, t=0.0)]
    got = {tuple(r) for r in grid(spark, rows, [episode(fps=None)], [config(fps=5.0)]).filter("missing").select("side", "slot").collect()}
    assert got == {(0, 2)}
    assert grid(spark, rows, [episode(fps=None)], []).count() == 0


def test_filled_values_follow_held_out_readings(spark):
    at = lambda i: (0.3 + 0.1 * math.sin(i / 10), 0.2 + 0.05 * math.cos(i / 8), 0.2, 0.0, 0.0, math.sin(i / 40), math.cos(i / 40))
    held = {20, 21, 22, 50, 51, 77}
    rows = [frame(i=i, pose=at(i), gripper=0.5 + 0.3 * math.sin(i / 15)) for i in range(100) if i not in held]
    out = {r["slot"]: r for r in grid(spark, rows).filter("side = 0").collect()}
    assert {s for s, r in out.items() if r["missing"]} == held
    for i in held:
        p = at(i)
        assert abs(out[i]["x"] - p[0]) < 2e-3 and abs(out[i]["y"] - p[1]) < 2e-3 and abs(abs(out[i]["qw"]) - abs(p[6])) < 2e-3 and abs(out[i]["gripper"] - (0.5 + 0.3 * math.sin(i / 15))) < 5e-3
        assert out[i]["pose_sd_m"] > out[10]["pose_sd_m"] > 0


def test_smoother_equals_the_dense_solution():
    import numpy as np

    rng = np.random.default_rng(0)
    t = np.cumsum(rng.uniform(0.05, 0.3, 12))[:, None]
    z = rng.normal(size=(12, 1, 1))
    z[[3, 7, 8]] = np.nan
    r, q = np.array([[0.04]]), np.array([[0.5]])
    level, var = regrid._smooth(t, z, r, q)
    # the same model written as one Gaussian: covariance of all levels, conditioned on the readings
    T = len(t)
    first = z[0, 0, 0]
    m, cov = np.zeros(2 * T), np.zeros((2 * T, 2 * T))
    m[:2] = (first, 0.0)
    cov[:2, :2] = np.eye(2) * 1e2
    for i in range(1, T):
        d = float(t[i, 0] - t[i - 1, 0])
        f = np.array([[1, d], [0, 1]])
        n = q[0, 0] * np.array([[d**3 / 3, d**2 / 2], [d**2 / 2, d]])
        m[2 * i : 2 * i + 2] = f @ m[2 * i - 2 : 2 * i]
        cov[2 * i : 2 * i + 2, : 2 * i] = f @ cov[2 * i - 2 : 2 * i, : 2 * i]
        cov[: 2 * i, 2 * i : 2 * i + 2] = cov[2 * i : 2 * i + 2, : 2 * i].T
        cov[2 * i : 2 * i + 2, 2 * i : 2 * i + 2] = f @ cov[2 * i - 2 : 2 * i, 2 * i - 2 : 2 * i] @ f.T + n
    seen = [i for i in range(T) if not np.isnan(z[i, 0, 0])]
    h = np.zeros((len(seen), 2 * T))
    for k, i in enumerate(seen):
        h[k, 2 * i] = 1
    s = h @ cov @ h.T + r[0, 0] * np.eye(len(seen))
    gain = cov @ h.T @ np.linalg.inv(s)
    post = m + gain @ (z[seen, 0, 0] - h @ m)
    left = cov - gain @ h @ cov
    assert np.allclose(level[:, 0, 0], post[::2], atol=1e-8)
    assert np.allclose(var[:, 0, 0], np.diag(left)[::2], atol=1e-7)


def test_blocks_agree_with_one(spark, monkeypatch):
    rows = [frame(i=i) for i in range(200) if i % 17]
    whole = {(r["side"], r["slot"], r["missing"]) for r in grid(spark, rows).collect()}
    x = {r["slot"]: r["x"] for r in grid(spark, rows).collect()}
    monkeypatch.setattr(regrid, "BLOCK", 50)
    monkeypatch.setattr(regrid, "HALO", 30)
    out = grid(spark, rows).collect()
    assert {(r["side"], r["slot"], r["missing"]) for r in out} == whole
    assert max(abs(r["x"] - x[r["slot"]]) for r in out) < 1e-3


def test_empty_nulls_and_extra_columns(spark):
    assert grid(spark, [], [], []).count() == 0
    rows = [frame(i=i) for i in range(4)] + [(2, 0, 0, None, None, None, None, None, None, None, None, None, None, None), (None, 0, 0, None, 1.0, None, None, None, None, None, None, None, None, NOW)]
    f, e, c = tables(spark, rows, [episode(), episode(), episode(e=2)], [config(), config()])
    for n in ("slot", "kind", "_block", "t0", "source", "first"):
        f, e, c = f.withColumn(n, F.lit(1)), e.withColumn(n, F.lit(1)), c.withColumn(n, F.lit(1))
    assert regrid.regular_grid(f, e, c).count() == 4
    odd = [frame(i=0), frame(i=1, t=math.nan), frame(i=2, t=math.inf), frame(i=3)]
    assert sorted(r["slot"] for r in grid(spark, odd).filter("missing").collect()) == [1, 2]
    only_null = [(1, i, 0, "A b", i / 10, None, None, None, None, None, None, None, None, NOW) for i in range(3)]
    assert [r["missing"] for r in grid(spark, only_null).collect()] == [False] * 3
