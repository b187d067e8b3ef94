"""Rotations of recorded poses are taken as declared, whatever the array's length."""

import math

from data import CONFIG, NOW, config

from armlode.queries import poses

RAW = "record_id long, source_dataset string, episode_index long, frame_index long, arm string, t double, pose array<double>, gripper string, unit_text string, received_at timestamp"
H = math.sqrt(0.5)


def _write(spark, folder):
    turn = {"wxyz": [H, 0.0, 0.0, H], "xyzw": [0.0, 0.0, H, H], "euler": [0.0, 0.0, math.pi / 2], "degrees": [0.0, 0.0, 90.0], "rotvec": [0.0, 0.0, math.pi / 2]}
    rows = [(10 * i + extra, name, 1, 0, "right", 0.0, [0.3, 0.1, 0.2, *v, *[99.0] * extra], "0.5", None, NOW) for i, (name, v) in enumerate(turn.items()) for extra in (0, 1)]
    rows += [(90, "xyzw", 1, 0, "right", 0.0, [0.3, 0.1, 0.2, H, 0.0, 0.0, H, 99.0], "0.5", "quaternion w, x, y, z", NOW), (91, "wxyz", 1, 0, "right", 0.0, None, "0.5", None, NOW)]
    kinds = [config(name="wxyz", order="wxyz"), config(name="xyzw", order="xyzw"), config(name="euler", rot="euler"), config(name="degrees", rot="euler", notes="Euler angles are in degrees."), config(name="rotvec", rot="rotvec")]
    spark.createDataFrame(rows + rows[:1], RAW).write.parquet(f"{folder}/raw_frames.parquet")
    spark.createDataFrame(kinds, CONFIG).write.parquet(f"{folder}/source_config.parquet")
    return str(folder)


def test_every_record_comes_out_by_its_declared_rotation(spark, tmp_path):
    base = _write(spark, tmp_path)
    want = {"quat_order": [0, 1, 10, 11, 90], "euler_to_quat": [20, 21, 30, 31], "rotvec_to_quat": [40, 41]}
    for name, ids in want.items():
        got = {r["record_id"]: (r["qx"], r["qy"], r["qz"], r["qw"]) for r in poses.QUERIES[name](spark, base).collect()}
        assert sorted(got) == ids
        for q in got.values():
            assert all(abs(a - b) < 1e-6 for a, b in zip(q, (0.0, 0.0, H, H)))
