"""Queries of pose algebra, grippers and cameras, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from armlode.functions import camera as C
from armlode.functions import gripper as G
from armlode.functions import pose as P
from armlode.operators import frames as FR
from armlode.operators import units as U
from armlode.queries.problems import UNIT_RULE
from armlode.queries.sequence import ONE
from armlode.sources.tables import source_key, table

KEYS = ["episode_id", "side", "frame_idx"]
#: Added before rounding: the readings are multiples of powers of two, so results may lie half way, where two engines differ.
TIE = 1.1e-9
#: Constant transforms of the queries: a base turned by 90 degrees about z, a tool offset.
HALF = 0.7071067811865476


def _lits(v):
    return [F.lit(float(x)) for x in v]


def _base():
    return _lits((0.1, -0.2, 0.3)), _lits((0.0, 0.0, HALF, HALF))


def _tool():
    return _lits((0.0, 0.0, 0.05)), _lits((HALF, 0.0, 0.0, HALF))


def _frames(spark, base):
    return FR.canonical(table(spark, base, "frames"))


def _unit(spark, base):
    """Frames whose quaternion has norm 1, as scalar columns."""
    d = _frames(spark, base).select(*KEYS, "pose", "gripper").withColumn("n", P.norm(P.fields("pose")[1])).filter("abs(n - 1) < 0.001")
    q = P.normalize(P.fields("pose")[1])
    return d.select(*KEYS, "gripper", *[F.col(f"pose.{k}").alias(k) for k in "xyz"], *[c.alias(k) for k, c in zip(("qx", "qy", "qz", "qw"), q)])


def _cols():
    return [F.col(k) for k in "xyz"], [F.col(k) for k in ("qx", "qy", "qz", "qw")]


def _out(p, q, digits=6):
    names = ("x", "y", "z", "qx", "qy", "qz", "qw")
    return [(F.round(c + TIE, digits) + 0.0).alias(n) for c, n in zip([*p, *q], names)]


def quat_normalize(spark, base):
    q = P.normalize(P.fields("pose")[1])
    return _frames(spark, base).select(*KEYS, *[(F.round(c + TIE, 6) + 0.0).alias(n) for c, n in zip(q, ("qx", "qy", "qz", "qw"))])


def pose_compose(spark, base):
    return _unit(spark, base).select(*KEYS, *_out(*P.compose(_base(), _cols())))


def pose_inverse(spark, base):
    return _unit(spark, base).select(*KEYS, *_out(*P.invert(_cols())))


def pose_transform(spark, base):
    """The position scaled by half, then base and tool applied."""
    return _unit(spark, base).select(*KEYS, *_out(*P.transform(_cols(), _base(), _tool(), 0.5)))


def orientation_error(spark, base):
    """Rotation vector from the frame before to each frame."""
    w = FR.side_window()
    d = _unit(spark, base).withColumns({f"p{k}": F.lag(k).over(w) for k in ("qx", "qy", "qz", "qw")}).filter("pqx is not null")
    e = P.orientation_error([F.col(f"p{k}") for k in ("qx", "qy", "qz", "qw")], _cols()[1])
    return d.select(*KEYS, *[(F.round(c + TIE, 5) + 0.0).alias(n) for c, n in zip(e, ("ex", "ey", "ez"))])


def _rotations(spark, base, *units):
    return U.recorded_rotations(table(spark, base, "raw_frames"), table(spark, base, "source_config")).filter(F.col("rotation_unit").isin(*units))


def euler_to_quat(spark, base):
    """Records declared as Euler angles, degrees as radians."""
    angles = [F.when(F.col("rotation_unit") == "euler_deg", F.radians(v)).otherwise(v) for v in (F.get("pose", F.lit(i)) for i in (3, 4, 5))]
    q = P.euler_to_quaternion(*angles)
    return _rotations(spark, base, "euler_rad", "euler_deg").select("record_id", *[(F.round(c + TIE, 6) + 0.0).alias(n) for c, n in zip(q, ("qx", "qy", "qz", "qw"))])


def rotvec_to_quat(spark, base):
    """Records declared as rotation vectors."""
    q = P.rotvec_to_quaternion(*[F.get("pose", F.lit(i)) for i in (3, 4, 5)])
    return _rotations(spark, base, "rotvec_rad").select("record_id", *[(F.round(c + TIE, 6) + 0.0).alias(n) for c, n in zip(q, ("qx", "qy", "qz", "qw"))])


def quat_order(spark, base):
    """Records declared as quaternions, as xyzw: those declared wxyz are reordered."""
    v = lambda i: F.get("pose", F.lit(i))
    q = [F.when(F.col("rotation_unit") == "quat_wxyz", v(w)).otherwise(v(x)).alias(n) for w, x, n in ((4, 3, "qx"), (5, 4, "qy"), (6, 5, "qz"), (3, 6, "qw"))]
    return _rotations(spark, base, "quat_wxyz", "quat_xyzw").select("record_id", *q)


def aperture_closure(spark, base):
    d = _frames(spark, base).filter("gripper is not null")
    a = G.aperture_of_closure(F.col("gripper"))
    return d.select(*KEYS, F.round(a, 7).alias("aperture"), F.round(G.closure_of_aperture(a), 6).alias("closure"), (F.round(G.finger_angle(F.col("side"), F.col("gripper")), 6) + 0.0).alias("finger"))


def pinch_centre(spark, base):
    d = _unit(spark, base).filter("gripper is not null")
    moved, target = G.keep_pinch_centre(_cols(), F.col("gripper"))
    names = ("x", "y", "z", "target_x", "target_y", "target_z")
    return d.select(*KEYS, *[(F.round(c + TIE, 6) + 0.0).alias(n) for c, n in zip([*moved, *target], names)])


def gripper_calibrated(spark, base):
    """Linear closure between a source's declared values."""
    cfg = table(spark, base, "source_config").filter("gripper_open_value is not null and gripper_closed_value is not null").select(source_key("name").alias("source"), "gripper_open_value", "gripper_closed_value")
    raw = table(spark, base, "raw_frames").dropDuplicates(["record_id"]).select("record_id", source_key("source_dataset").alias("source"), F.col("gripper").try_cast("double").alias("g")).filter("g is not null")
    return raw.join(cfg, "source").select("record_id", (F.round(G.linear_closure(F.col("g"), F.col("gripper_open_value"), F.col("gripper_closed_value")) + TIE, 6) + 0.0).alias("closure"))


def gripper_percentile(spark, base):
    """Closure between the 1st and 99th percentile of each episode's side."""
    raw = table(spark, base, "raw_frames").dropDuplicates(["record_id"]).select("record_id", source_key("source_dataset").alias("source"), "episode_index", "arm", F.col("gripper").try_cast("double").alias("g")).filter("g is not null")
    ends = raw.groupBy("source", "episode_index", "arm").agg(F.percentile("g", F.array(F.lit(0.01), F.lit(0.99))).alias("e"))
    return raw.join(ends, ["source", "episode_index", "arm"]).select("record_id", F.round(G.percentile_closure(F.col("g"), F.col("e")[0], F.col("e")[1]), 5).alias("closure"))


def width_closure(spark, base):
    """Physical widths to closure by the finger's geometry."""
    d = _frames(spark, base).filter("gripper_width_m is not null")
    return d.select(*KEYS, F.round(G.closure_of_aperture(F.col("gripper_width_m")), 6).alias("closure"))


def mean_of_fingers(spark, base):
    """Five of the first six joint values as fingers, as a hand's closure."""
    d = _frames(spark, base).filter("q is not null")
    return d.select(*KEYS, F.round(G.mean_of_fingers(F.col("q"), [0, 2, 3, 4, 5]) + TIE, 6).alias("closure"))


def pinhole(spark, base):
    """The gripper in a camera looking along x from two metres behind."""
    camera = _lits((-2.0, 0.0, 0.4)), _lits((-0.5, 0.5, -0.5, 0.5))
    point = C.into_camera(_cols()[0], camera)
    u, v, seen = C.project(point, 600.0, 600.0, 320.0, 240.0)
    return _unit(spark, base).select(*KEYS, F.round(u + TIE, 3).alias("u"), F.round(v + TIE, 3).alias("v"), seen.alias("visible"))


def camera_mapped(spark, base):
    """Each pose taken as a camera's and carried through a similarity."""
    return _unit(spark, base).select(*KEYS, *_out(*C.map_camera(_cols(), _base(), 0.5)))


def colour_levels(spark, base):
    """Closures as sRGB levels: to linear light and back, and a piecewise curve."""
    g = F.col("gripper")
    lin = C.srgb_to_linear(g)
    curve = C.interpolate(g, F.array(*_lits((0.0, 0.3, 0.25, 1.0))), F.array(*_lits((0.0, 0.1, 0.4, 1.0))))
    return _frames(spark, base).filter("gripper is not null").select(*KEYS, F.round(lin, 6).alias("linear"), F.round(C.linear_to_srgb(lin), 5).alias("back"), F.round(curve, 6).alias("curve"))


QUERIES = {
    f.__name__: f
    for f in (
        quat_normalize, pose_compose, pose_inverse, pose_transform, orientation_error, euler_to_quat, rotvec_to_quat, quat_order, aperture_closure, pinch_centre, gripper_calibrated, gripper_percentile, width_closure,
        mean_of_fingers, pinhole, camera_mapped, colour_levels,
    )
}

_N = "sqrt(pose.qx*pose.qx + pose.qy*pose.qy + pose.qz*pose.qz + pose.qw*pose.qw)"
UNIT = f"{ONE}, un AS (SELECT episode_id, side, frame_idx, gripper, pose.x AS x, pose.y AS y, pose.z AS z, pose.qx / {_N} * s AS qx, pose.qy / {_N} * s AS qy, pose.qz / {_N} * s AS qz, pose.qw / {_N} * s AS qw FROM (SELECT *, CASE WHEN pose.qw < 0 THEN -1.0 ELSE 1.0 END AS s FROM one) WHERE abs({_N} - 1) < 0.001)"


def _mul(a, b):
    ax, ay, az, aw = (f"({v})" for v in a)
    bx, by, bz, bw = (f"({v})" for v in b)
    return [f"{aw}*{bx}+{ax}*{bw}+{ay}*{bz}-{az}*{by}", f"{aw}*{by}-{ax}*{bz}+{ay}*{bw}+{az}*{bx}", f"{aw}*{bz}+{ax}*{by}-{ay}*{bx}+{az}*{bw}", f"{aw}*{bw}-{ax}*{bx}-{ay}*{by}-{az}*{bz}"]


def _rot(q, v):
    """A vector turned by the rotation matrix of a quaternion, in SQL."""
    x, y, z, w = (f"({c})" for c in q)
    a, b, c = (f"({k})" for k in v)
    return [
        f"(1-2*({y}*{y}+{z}*{z}))*{a}+2*({x}*{y}-{z}*{w})*{b}+2*({x}*{z}+{y}*{w})*{c}",
        f"2*({x}*{y}+{z}*{w})*{a}+(1-2*({x}*{x}+{z}*{z}))*{b}+2*({y}*{z}-{x}*{w})*{c}",
        f"2*({x}*{z}-{y}*{w})*{a}+2*({y}*{z}+{x}*{w})*{b}+(1-2*({x}*{x}+{y}*{y}))*{c}",
    ]


def _sel(exprs, names, digits=6):
    return ", ".join(f"round({e} + {TIE}, {digits}) + 0.0 AS {n}" for e, n in zip(exprs, names))


_PN = ("x", "y", "z", "qx", "qy", "qz", "qw")
_Q = ("qx", "qy", "qz", "qw")
_BP, _BQ = ("0.1", "-0.2", "0.3"), ("0.0", "0.0", str(HALF), str(HALF))
_TP, _TQ = ("0.0", "0.0", "0.05"), (str(HALF), "0.0", "0.0", str(HALF))


def _compose(ap, aq, bp, bq):
    r = _rot(aq, bp)
    return [f"({a})+({m})" for a, m in zip(ap, r)], _mul(aq, bq)


_c1 = _compose(_BP, _BQ, ("x", "y", "z"), _Q)
_half = _compose(_BP, _BQ, ("x*0.5", "y*0.5", "z*0.5"), _Q)
_full = _compose(_half[0], _half[1], _TP, _TQ)
_inv_q = ("-qx", "-qy", "-qz", "qw")
_inv_p = [f"-({e})" for e in _rot(_inv_q, ("x", "y", "z"))]
_K = "episode_id, side, frame_idx"
_ANG = f"((1 - least(greatest(gripper, 0), 1)) * {G.MAX_ANGLE})"
_AP = lambda a: f"(2 * ({G.PIVOT_OFFSET} - {G.PIVOT_OFFSET} * cos({a}) + {G.PAD_REACH} * sin({a})))"
_CL = lambda ap: f"(1 - least(greatest(asin(least(greatest((least(greatest({ap}, 0), {G.MAX_APERTURE}) / 2 - {G.PIVOT_OFFSET}) / sqrt({G.PIVOT_OFFSET}*{G.PIVOT_OFFSET} + {G.PAD_REACH}*{G.PAD_REACH}), -1), 1)) + atan2({G.PIVOT_OFFSET}, {G.PAD_REACH}), 0), {G.MAX_ANGLE}) / {G.MAX_ANGLE})"
_NOWZ = f"({G.PIVOT_Z} - ({G.PIVOT_OFFSET} * sin({_ANG}) + {G.PAD_REACH} * cos({_ANG})))"
_TARGET = [f"({a})+({b})" for a, b in zip(("x", "y", "z"), _rot(_Q, (str(G.PIVOT_X), "0.0", str(G.CLOSED_Z))))]
_MOVED = [f"({a})+({b})" for a, b in zip(("x", "y", "z"), _rot(_Q, ("0.0", "0.0", f"{G.CLOSED_Z} - {_NOWZ}")))]
_CAM = _rot(("0.5", "-0.5", "0.5", "0.5"), ("x + 2.0", "y", "z - 0.4"))
_KEY = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
_RAW = f"raw AS (SELECT record_id, any_value({_KEY.format('source_dataset')}) AS source, any_value(episode_index) AS episode_index, any_value(arm) AS arm, any_value(pose) AS pose, any_value(gripper) AS gripper FROM raw_frames GROUP BY 1)"
_E = [f"pose[{i}]" for i in (4, 5, 6)]
_c, _s = [f"cos({e}/2)" for e in _E], [f"sin({e}/2)" for e in _E]
_EULER = [
    f"{_s[0]}*{_c[1]}*{_c[2]}-{_c[0]}*{_s[1]}*{_s[2]}", f"{_c[0]}*{_s[1]}*{_c[2]}+{_s[0]}*{_c[1]}*{_s[2]}",
    f"{_c[0]}*{_c[1]}*{_s[2]}-{_s[0]}*{_s[1]}*{_c[2]}", f"{_c[0]}*{_c[1]}*{_c[2]}+{_s[0]}*{_s[1]}*{_s[2]}",
]
_VN = "sqrt(pose[4]*pose[4] + pose[5]*pose[5] + pose[6]*pose[6])"

SQL = {
    "quat_normalize": f"WITH {ONE} SELECT {_K}, " + ", ".join(f"CASE WHEN {_N} >= 1e-12 THEN round(pose.{n} / {_N} * (CASE WHEN pose.qw < 0 THEN -1.0 ELSE 1.0 END) + {TIE}, 6) + 0.0 END AS {n}" for n in _Q) + " FROM one",
    "pose_compose": f"WITH {UNIT} SELECT {_K}, {_sel(_c1[0] + _c1[1], _PN)} FROM un",
    "pose_inverse": f"WITH {UNIT} SELECT {_K}, {_sel(_inv_p + list(_inv_q), _PN)} FROM un",
    "pose_transform": f"WITH {UNIT} SELECT {_K}, {_sel(_full[0] + _full[1], _PN)} FROM un",
    "orientation_error": f"""WITH {UNIT}, p AS (SELECT *, lag(qx) OVER w AS px, lag(qy) OVER w AS py, lag(qz) OVER w AS pz, lag(qw) OVER w AS pw FROM un WINDOW w AS (PARTITION BY episode_id, side ORDER BY frame_idx)),
m AS (SELECT {_K}, {', '.join(f'{e} AS m{n}' for e, n in zip(_mul(_Q, ('-px', '-py', '-pz', 'pw')), 'xyzw'))} FROM p WHERE px IS NOT NULL),
s AS (SELECT {_K}, CASE WHEN mw < 0 THEN -1.0 ELSE 1.0 END AS s, mx, my, mz, mw, sqrt(mx*mx + my*my + mz*mz) AS n FROM m), k AS (SELECT *, CASE WHEN n < 1e-9 THEN 2.0 ELSE 2 * atan2(n, mw * s) / n END * s AS k FROM s)
SELECT {_K}, round(mx * k + {TIE}, 5) + 0.0 AS ex, round(my * k + {TIE}, 5) + 0.0 AS ey, round(mz * k + {TIE}, 5) + 0.0 AS ez FROM k""",
    "euler_to_quat": f"WITH {UNIT_RULE}, eu AS (SELECT record_id, CASE WHEN ru = 'euler_deg' THEN list_transform(pose, lambda v: radians(v)) ELSE pose END AS pose FROM o WHERE ru IN ('euler_rad', 'euler_deg') AND len(pose) >= 6) SELECT record_id, {_sel(_EULER, _Q)} FROM eu",
    "rotvec_to_quat": f"WITH {UNIT_RULE}, v AS (SELECT record_id, pose, {_VN} AS n FROM o WHERE ru = 'rotvec_rad' AND len(pose) >= 6) SELECT record_id, {_sel([f'pose[{i}] * (CASE WHEN n < 1e-9 THEN 0.5 ELSE sin(n / 2) / n END)' for i in (4, 5, 6)] + ['cos(n / 2)'], _Q)} FROM v",
    "quat_order": f"WITH {UNIT_RULE} SELECT record_id, " + ", ".join(f"CASE WHEN ru = 'quat_wxyz' THEN pose[{w}] ELSE pose[{x}] END AS {n}" for w, x, n in ((5, 4, "qx"), (6, 5, "qy"), (7, 6, "qz"), (4, 7, "qw"))) + " FROM o WHERE ru IN ('quat_wxyz', 'quat_xyzw') AND len(pose) >= 7",
    "aperture_closure": f"WITH {ONE} SELECT {_K}, round({_AP(_ANG)}, 7) AS aperture, round({_CL(_AP(_ANG))}, 6) AS closure, round(CASE WHEN side = 0 THEN -{_ANG} ELSE {_ANG} END, 6) + 0.0 AS finger FROM one WHERE gripper IS NOT NULL",
    "pinch_centre": f"WITH {UNIT} SELECT {_K}, {_sel(_MOVED + _TARGET, ('x', 'y', 'z', 'target_x', 'target_y', 'target_z'))} FROM un WHERE gripper IS NOT NULL",
    "gripper_calibrated": f"WITH {_RAW}, c AS (SELECT {_KEY.format('name')} AS source, gripper_open_value AS o, gripper_closed_value AS k FROM source_config WHERE gripper_open_value IS NOT NULL AND gripper_closed_value IS NOT NULL), g AS (SELECT record_id, source, try_cast(gripper AS DOUBLE) AS g FROM raw) SELECT record_id, CASE WHEN abs(k - o) >= 1e-9 THEN round(least(greatest((g - o) / (k - o), 0.0), 1.0) + {TIE}, 6) + 0.0 END AS closure FROM g JOIN c ON g.source = c.source WHERE g IS NOT NULL",
    "gripper_percentile": f"WITH {_RAW}, g AS (SELECT record_id, source, episode_index, arm, try_cast(gripper AS DOUBLE) AS g FROM raw), e AS (SELECT source, episode_index, arm, quantile_cont(g, 0.01) AS lo, quantile_cont(g, 0.99) AS hi FROM g WHERE g IS NOT NULL GROUP BY 1, 2, 3) SELECT record_id, round(least(greatest((g - lo) / greatest(hi - lo, 1e-6), 0.0), 1.0), 5) AS closure FROM g JOIN e ON g.source = e.source AND g.episode_index = e.episode_index AND g.arm = e.arm WHERE g IS NOT NULL",
    "width_closure": f"WITH {ONE} SELECT {_K}, round({_CL('gripper_width_m')}, 6) AS closure FROM one WHERE gripper_width_m IS NOT NULL",
    "mean_of_fingers": f"WITH {ONE} SELECT {_K}, round(least(greatest((q[1] + q[3] + q[4] + q[5] + q[6]) / 5, 0.0), 1.0) + {TIE}, 6) AS closure FROM one WHERE q IS NOT NULL",
    "pinhole": f"WITH {UNIT}, c AS (SELECT {_K}, {_CAM[0]} AS cx, {_CAM[1]} AS cy, {_CAM[2]} AS cz FROM un) SELECT {_K}, CASE WHEN cz > 1e-6 THEN round(cx / cz * 600.0 + 320.0 + {TIE}, 3) END AS u, CASE WHEN cz > 1e-6 THEN round(cy / cz * 600.0 + 240.0 + {TIE}, 3) END AS v, cz > 1e-6 AS visible FROM c",
    "camera_mapped": f"WITH {UNIT} SELECT {_K}, {_sel(_half[0] + _half[1], _PN)} FROM un",
    "colour_levels": f"""WITH {ONE}, l AS (SELECT {_K}, gripper AS g, CASE WHEN gripper <= 0.04045 THEN gripper / 12.92 ELSE power((gripper + 0.055) / 1.055, 2.4) END AS lin FROM one WHERE gripper IS NOT NULL)
SELECT {_K}, round(lin, 6) AS linear, round(CASE WHEN lin <= 0.0031308 THEN lin * 12.92 ELSE 1.055 * power(lin, 1 / 2.4) - 0.055 END, 5) AS back,
round(CASE WHEN g < 0 THEN 0.0 WHEN g < 0.3 THEN g / 0.3 * 0.1 WHEN g < 1 THEN 0.4 + (g - 0.3) / 0.7 * 0.6 ELSE 1.0 END, 6) AS curve FROM l""",
}
