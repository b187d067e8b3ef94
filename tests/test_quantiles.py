"""Quantiles by steps and ranks equal numpy's, for hot, null, tied, negative and single values."""

import math

import numpy as np

from armlode.operators import quality


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=700), "b": np.round(rng.normal(size=90), 1), None: rng.lognormal(sigma=9, size=41), "one": np.array([3.0]), "zero": np.array([0.0, 0.0, -1e-300, 1e300])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("a", None), ("a", math.nan), ("none", None)]
    shares = {"q0": 0.0, "q1": 0.01, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    out = {r["k"]: r for r in quality.exact_quantiles(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", shares).collect()}
    assert set(out) == set(groups)
    for k, v in groups.items():
        for n, p in shares.items():
            want = float(np.quantile(v, p))
            assert abs(out[k][n] - want) <= 1e-12 * max(1.0, abs(want)), (k, n)
    assert quality.exact_quantiles(spark.createDataFrame([], "k string, x double"), ["k"], "x", shares).count() == 0
    assert quality.exact_quantiles(spark.createDataFrame(rows, "k string, x double"), [], "x", {"m": 0.5}).first()["m"] == np.median(np.concatenate(list(groups.values())))
