"""Small tables in the shape of the test data, made in tests."""

import datetime as dt
import math

FRAMES = (
    "episode_id long, frame_idx long, side byte, source_dataset string, t double, pose struct<x:double,y:double,z:double,qx:double,qy:double,qz:double,qw:double>, "
    "gripper double, gripper_width_m double, q array<double>, feasible boolean, position_error_m double, orientation_error_rad double, jacobian_condition double, received_at timestamp"
)
EPISODES = "episode_id long, source_dataset string, source_episode string, task string, fps double, calibrated boolean, active_sides array<string>, metadata string, recorded_at timestamp, received_at timestamp"
CONFIG = "name string, repo_id string, fps double, rotation_representation string, rotation_euler_order string, quaternion_order string, position_scale double, gripper_mode string, gripper_open_value double, gripper_closed_value double, notes string"
NOW = dt.datetime(2025, 1, 1)


def frame(e=1, i=0, side=0, source="A b", t=None, pose=None, gripper=0.5, q=(0.0,) * 7, pe=0.001, oe=0.01, jc=10.0, feasible=True, **kw):
    t = i / 10 if t is None else t
    pose = pose or (0.3 + 0.01 * math.sin(i * 0.7) + 0.001 * i, 0.1 + 0.001 * i, 0.2, 0.0, 0.0, 0.0, 1.0)
    q = None if q is None else [x + 0.01 * i + 0.003 * math.sin(1.3 * i) for x in q]
    wob = 1 + 0.1 * math.sin(2.1 * i)
    return (e, i, side, source, t, pose, gripper, None, q, feasible, pe * wob, oe * wob, jc * wob, kw.get("at", NOW + dt.timedelta(seconds=i)))


def episode(e=1, source="A b", rec=None, task=None, fps=10.0, sides=("right", "left")):
    return (e, source, rec, task, fps, True, None if sides is None else list(sides), "{}", NOW, NOW)


def config(name="A-B", repo="lab/x", fps=10.0, rot="quaternion", order=None, scale=None, mode="normalized", lo=None, hi=None, notes=None):
    return (name, repo, fps, rot, "xyz", order, scale, mode, lo, hi, notes)


def tables(spark, frames=(), episodes=(), configs=()):
    return spark.createDataFrame(list(frames), FRAMES), spark.createDataFrame(list(episodes), EPISODES), spark.createDataFrame(list(configs), CONFIG)
