"""A gap over a block's edge is filled as in one block."""

import math

import numpy as np
from data import frame
from test_regrid import grid

from armlode.operators import regrid


def test_gap_across_blocks_equals_one_block(spark, monkeypatch):
    at = lambda i: (0.3 + 0.002 * i, 0.2 - 0.001 * i, 0.2, 0.0, 0.0, 0.0, 1.0 if i % 2 else -1.0)
    rows = [frame(i=i, pose=at(i), gripper=0.2 + 0.002 * i) for i in (*range(40), *range(160, 220))]
    names = ("x", "y", "qw", "gripper", "pose_sd_m", "gripper_sd")
    whole = {r["slot"]: [r[n] for n in names] for r in grid(spark, rows).collect()}
    monkeypatch.setattr(regrid, "BLOCK", 50)
    monkeypatch.setattr(regrid, "HALO", 10)
    out = {r["slot"]: [r[n] for n in names] for r in grid(spark, rows).collect()}
    assert sorted(out) == sorted(whole) == list(range(220))
    a, b = (np.abs(np.array([d[k] for k in sorted(d)], dtype=float)) for d in (whole, out))
    assert np.isfinite(b).all()
    assert np.abs(a - b)[:, :4].max() < 2e-3 and np.allclose(a[:, 4:], b[:, 4:], rtol=0.1)


def test_long_series_equal_the_smoother_over_all_of_it(spark, monkeypatch):
    """9,300 slots in blocks of 4096, with gaps across both edges and sparse readings between, against one pass over the series."""
    n = 9300
    turn = lambda i: (math.sin(i / 300), math.cos(i / 300))
    at = lambda i: (0.3 + 0.1 * math.sin(i / 90) + 0.001 * math.sin(7.3 * i), 0.2 + 0.05 * math.cos(i / 70), 0.2, 0.0, 0.0, *turn(i))
    kept = [i for i in range(n) if not (3900 <= i < 4400 or 7000 <= i < 8500) and (i < 8500 or i % 60 == 0 or i > 9000)]
    rows = [frame(i=i, t=i / 10, pose=tuple(v * (-1 if k > 2 and i % 3 == 0 else 1) for k, v in enumerate(at(i))), gripper=0.5 + 0.3 * math.sin(i / 50)) for i in kept]
    names = ["pose_r", "pose_q", "rot_r", "rot_q", "grip_r", "grip_q"]
    monkeypatch.setattr(regrid, "noise", lambda _: spark.createDataFrame([("ab", 2e-3, 1e-2, 1e-3, 1e-2, 5e-3, 1e-2)], ["source", *names]))
    out = grid(spark, rows).toPandas().sort_values("slot").reset_index(drop=True)
    assert list(out["slot"]) == list(range(n)) and out.drop(columns="missing").notna().all().all()
    monkeypatch.setattr(regrid, "BLOCK", 1 << 20)
    whole = grid(spark, rows).toPandas().sort_values("slot").reset_index(drop=True)
    for name in ("x", "y", "z", "qz", "qw", "gripper", "pose_sd_m", "rotation_sd", "gripper_sd"):
        assert np.abs(out[name] - whole[name]).max() < 1e-6, name
