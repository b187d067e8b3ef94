"""The episode solver: restarts, choice of answers, smoothing and re-evaluation."""

import numpy as np
from data import frame, tables

from armlode.operators import kinematics as K
from armlode.operators import registration as R


def test_a_success_beats_a_failure_of_smaller_error():
    settings = K.SolverSettings()
    answer = lambda ep, er, ok, q=0.0: {"q": np.full((1, 7), q), "ep": np.array([ep]), "er": np.array([er]), "cond": np.ones(1), "ok": np.array([ok])}
    last = np.zeros((1, 7))
    assert K.best_answers([answer(0.0, 0.06, False), answer(0.0049, 0.03, True)], last, settings)["ok"].all()
    assert K.best_answers([answer(0.004, 0.03, True), answer(0.002, 0.03, True)], last, settings)["ep"] == 0.002
    assert K.best_answers([answer(0.0, 0.0, True, 0.5), answer(0.0, 0.0, True, 0.1)], last, settings)["q"][0, 0] == 0.1


def test_restarts_turn_the_elbow_both_ways():
    chain, settings = K.default_chain(), K.SolverSettings()
    assert settings.iterations == 120
    assert np.allclose(K.restart_postures(chain, settings)[:, 3] - chain.neutral[3], [0.0, -0.45, 0.45])


def test_solved_joints_are_smoothed_and_judged_again(spark):
    chain, settings = K.default_chain(), K.SolverSettings()
    rng = np.random.default_rng(3)
    pose, targets = [], []
    for i in range(30):
        tip, rot, _, _ = K.forward(chain, np.array([[0.2 + 0.02 * i, 0.5, -0.2, 0.8, 0.1, 0.3, 0.0]]))
        tip = tip + rng.normal(0, 0.004, tip.shape)
        targets.append((tip, K._matrix(R._quaternion(rot))))
        pose.append(tuple(map(float, (*tip[0], *R._quaternion(rot)[0]))))
    last = before = chain.neutral[None]
    raw = []
    for tip, rot in targets:
        a = K.solve(chain, np.clip(last + settings.carry * (last - before), chain.lower, chain.upper), tip, rot, settings)
        assert a["ok"].all()
        before, last = last, a["q"]
        raw.append(a["q"][0])
    d2 = np.diff(np.eye(30), n=2, axis=0)
    want = np.linalg.solve(np.eye(30) + 3 * d2.T @ d2, np.array(raw))
    f, _, _ = tables(spark, [frame(i=i, pose=p) for i, p in enumerate(pose)])
    out = K.solve_episodes(f, smooth=True).orderBy("frame_idx").collect()
    assert np.allclose([r["q"] for r in out], want, atol=1e-6)
    judged = K.evaluate(chain, want, np.concatenate([t for t, _ in targets]), np.concatenate([r for _, r in targets]), settings)
    assert np.allclose([r["position_error_m"] for r in out], judged["ep"], atol=1e-6)
    assert [r["ik_success"] for r in out] == judged["ok"].tolist()
