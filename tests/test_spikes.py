import math

from data import config, episode, frame, tables
from pyspark.sql import functions as F

from armlode.operators import spikes


def found(spark, rows, sides=("right",)):
    f, e, _ = tables(spark, rows, [episode(sides=sides)])
    return {tuple(r) for r in spikes.implausible_readings(f, e).collect()}


def base(n=60):
    return [list(frame(i=i)) for i in range(n)]


def test_clean_rows_have_no_case(spark):
    assert found(spark, [tuple(r) for r in base()]) == set()


def test_bounds_spikes_and_stuck(spark):
    rows = base()
    rows[10][5] = (0.3, 9999.0, 0.2, 0.0, 0.0, 0.0, 1.0)  # out of reach
    rows[12][5] = (*rows[12][5][:3], 0.0, 0.0, 0.0, 0.5)  # norm
    rows[14][5] = (*rows[14][5][:3], 0.0, 0.0, 0.0, -1.0)  # a whole sign change is none
    rows[20][8] = [*rows[20][8][:3], 7.0, *rows[20][8][4:]]  # beyond a turn
    rows[25][10] = -0.1
    rows[26][11] = 4.0
    rows[27][12] = math.inf  # with q
    rows[30][8], rows[30][12] = None, math.inf  # no solution: none
    for i in (35, 36):
        rows[i][5] = (rows[i][5][0] + 0.4, *rows[i][5][1:])
    rows[40][8] = [rows[40][8][0] + 1.0, *rows[40][8][1:]]
    rows[45][10] *= 50
    got = found(spark, [tuple(r) for r in rows])
    assert got == {(1, 10, 0, "pose"), (1, 12, 0, "pose"), (1, 20, 0, "q"), (1, 25, 0, "position_error_m"), (1, 26, 0, "orientation_error_rad"), (1, 27, 0, "jacobian_condition"), (1, 35, 0, "pose"), (1, 36, 0, "pose"), (1, 40, 0, "q"), (1, 45, 0, "position_error_m")}


def test_stuck_flags_all_but_the_first_from_seven_on(spark):
    rows = base()
    for i in range(20, 27):
        rows[i][5] = rows[20][5]
    for i in range(40, 46):  # six are no case
        rows[i][5] = rows[40][5]
    assert found(spark, [tuple(r) for r in rows]) == {(1, i, 0, "pose") for i in range(21, 27)}


def test_level_shift_is_no_spike_and_burst_of_three_is(spark):
    rows = base()
    for i in range(30, 60):
        rows[i][5] = (rows[i][5][0] + 0.5, *rows[i][5][1:])
    assert found(spark, [tuple(r) for r in rows]) == set()
    rows = base()
    for i in (30, 31, 32):
        rows[i][5] = (rows[i][5][0], rows[i][5][1] + 0.5, *rows[i][5][2:])
    assert found(spark, [tuple(r) for r in rows]) == {(1, i, 0, "pose") for i in (30, 31, 32)}


def test_parked_sides_copies_and_late_rows(spark):
    rows = base()
    rows[10][5] = (0.3, 9999.0, 0.2, 0.0, 0.0, 0.0, 1.0)
    again = list(rows[10])
    again[8] = None
    parked = [list(frame(i=i, side=1, pose=(9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0))) for i in range(20)]
    shuffled = [tuple(r) for r in (rows + [again] + parked)][::-1]
    assert found(spark, shuffled) == {(1, 10, 0, "pose")}
    assert found(spark, shuffled, sides=None) == set()


def test_blocks_of_a_long_series_agree_with_one(spark, monkeypatch):
    rows = base(300)
    for i in (15, 16, 100, 255):
        rows[i][5] = (rows[i][5][0] + 0.6, *rows[i][5][1:])
    for i in range(120, 140):
        rows[i][8] = rows[120][8]
    rows = [tuple(r) for r in rows]
    whole = found(spark, rows)
    monkeypatch.setattr(spikes, "BLOCK", 16)
    monkeypatch.setattr(spikes, "HALO", 12)
    assert found(spark, rows) == whole and len(whole) == 23


def test_rows_beyond_a_block_edge_count_however_far(spark, monkeypatch):
    rows = base(60)
    rows[30][5] = (rows[30][5][0] + 0.6, *rows[30][5][1:])
    for i in range(27, 36):
        rows[i][8] = rows[27][8]
    for i, r in enumerate(rows):  # rows in pairs, far apart: no block holds the neighbours of its own rows
        r[1] = i // 2 * 1000 + i % 2
    rows = [tuple(r) for r in rows]
    monkeypatch.setattr(spikes, "BLOCK", 1 << 20)
    whole = found(spark, rows)
    monkeypatch.setattr(spikes, "BLOCK", 256)
    assert found(spark, rows) == whole and len(whole) == 9


def test_empty_nulls_and_extra_columns(spark):
    f, e, _ = tables(spark)
    assert spikes.implausible_readings(f, e).count() == 0
    null = (1, 3, 0, None, None, None, None, None, None, None, None, None, None, None)
    nokey = (None, 3, 0, "A", 0.0, None, None, None, None, None, None, None, None, None)
    f, e, _ = tables(spark, [null, nokey, *[tuple(r) for r in base(10)]], [episode(), episode()])
    for c in ("_block", "w", "source", "s_pose", "v"):
        f, e = f.withColumn(c, F.lit(1)), e.withColumn(c, F.lit(1))
    assert spikes.implausible_readings(f, e).count() == 0


def test_against_brute_force_on_the_smallest_tables(spark):
    """Runs, bounds and spikes by plain loops over every side of the smallest tables."""
    import collections
    import os

    import numpy as np
    import pytest

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    read = lambda n: spark.read.parquet(f"{folder}/{n}.parquet")
    rows, active = {}, collections.defaultdict(set)
    for r in read("frames").collect():
        k = (r.episode_id, r.side, r.frame_idx)
        if k not in rows or (rows[k].q is None and r.q is not None):
            rows[k] = r
    for r in read("episodes").collect():
        active[r.episode_id] |= {("right", "left").index(s) for s in r.active_sides or []}
    sides = collections.defaultdict(list)
    for k in sorted(rows):
        sides[k[:2]].append(rows[k])

    def rotation(p):
        x, y, z, w = p.qx, p.qy, p.qz, p.qw
        return np.array([w * w + x * x - y * y - z * z, 2 * (x * y + w * z), 2 * (x * z - w * y), 2 * (x * y - w * z), w * w - x * x + y * y - z * z, 2 * (y * z + w * x)])

    def log(v):
        return np.array([math.log(v)]) if v is not None and 0 < v < math.inf else None

    quantities = {"pose": [(lambda r: np.array([r.pose.x, r.pose.y, r.pose.z]), 11.0, 0.0), (lambda r: rotation(r.pose), 14.0, 0.3)]}
    quantities["q"] = [(lambda r, j=j: None if r.q is None else np.array([r.q[j]]), 14.0, 0.0) for j in range(7)]
    for c in spikes.DIAGNOSTICS:
        quantities[c] = [(lambda r, c=c: log(r[c]), 7.0, math.log(5.0))]
    want = set()
    for name, parts in quantities.items():
        for get, times, least in parts:
            steps = collections.defaultdict(list)
            series = {s: [get(r) for r in rs] for s, rs in sides.items()}
            for s, rs in sides.items():
                for i in range(1, len(rs)):
                    a, b = series[s][i - 1], series[s][i]
                    if a is not None and b is not None and (d := np.linalg.norm(b - a)) > 0:
                        steps["".join(ch for ch in rs[i].source_dataset.lower() if ch.isalnum())].append(d)
            for s, rs in sides.items():
                kept = [(v, r) for v, r in zip(series[s], rs) if name != "q" or r.q is not None]
                for i, (v, r) in enumerate(kept):
                    if v is None:
                        continue
                    near = [x for x, _ in kept[max(0, i - 3) : i + 4] if x is not None]
                    mid = np.array([sorted(x[k] for x in near)[len(near) // 2] for k in range(len(v))])
                    key = "".join(ch for ch in r.source_dataset.lower() if ch.isalnum())
                    limit = max(times * float(np.median(steps[key])), least)
                    off = np.linalg.norm(v - mid)
                    back = max(limit, 0.3 * off)
                    close = lambda part: any(x is not None and np.linalg.norm(x - mid) <= back for x, _ in part)
                    if off > limit and close(kept[max(0, i - 3) : i]) and close(kept[i + 1 : i + 4]):
                        want.add((*s, r.frame_idx, name))
    readings = {"pose": [lambda r: (r.pose.x, r.pose.y, r.pose.z)], "q": [lambda r, j=j: None if r.q is None else r.q[j] for j in range(7)]} | {c: [lambda r, c=c: r[c] if r[c] < math.inf else None] for c in spikes.DIAGNOSTICS}
    for s, rs in sides.items():
        for name, gets in readings.items():
            for get in gets:
                start = 0
                for i in range(1, len(rs) + 1):
                    if i == len(rs) or get(rs[i]) is None or get(rs[i]) != get(rs[start]):
                        if i - start >= 7:
                            want |= {(*s, r.frame_idx, name) for r in rs[start + 1 : i]}
                        start = i
        for r in rs:
            p = r.pose
            bad = {
                "pose": math.dist((0, 0, 0), (p.x, p.y, p.z)) >= 1.5 or abs(math.sqrt(p.qx**2 + p.qy**2 + p.qz**2 + p.qw**2) - 1) > 1e-3, "q": r.q is not None and max(map(abs, r.q)) > 2 * math.pi,
                "position_error_m": r.position_error_m < 0, "orientation_error_rad": not 0 <= r.orientation_error_rad <= math.pi, "jacobian_condition": r.jacobian_condition < 1 or (r.jacobian_condition == math.inf and r.q is not None),
            }
            want |= {(*s, r.frame_idx, n) for n, b in bad.items() if b}
    want = {(e, i, s, n) for e, s, i, n in want if s in active[e]}
    got = {tuple(r) for r in spikes.implausible_readings(read("frames"), read("episodes")).collect()}
    assert len(want) > 50 and got == want
