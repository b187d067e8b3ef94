"""Pose algebra as Column expressions: quaternions are (x, y, z, w), poses structs of metres and a unit quaternion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = list[Column]


def fields(pose: str | Column) -> tuple[Vec, Vec]:
    """Position and quaternion columns of a pose struct."""
    get = (lambda k: F.col(f"{pose}.{k}")) if isinstance(pose, str) else (lambda k: pose[k])
    return [get(k) for k in ("x", "y", "z")], [get(k) for k in ("qx", "qy", "qz", "qw")]


def make_pose(p: Vec, q: Vec) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip([*p, *q], ("x", "y", "z", "qx", "qy", "qz", "qw"))])


def dot(a: Vec, b: Vec) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        out = out + x * y
    return out


def cross(a: Vec, b: Vec) -> Vec:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def normalize(q: Vec) -> Vec:
    """Unit quaternion with w >= 0; null where the norm is below 1e-12 or not finite."""
    n = norm(q)
    ok = (n >= 1e-12) & (n < float("inf"))
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    return [F.when(ok, c / n * sign) for c in q]


def multiply(a: Vec, b: Vec) -> Vec:
    """Quaternion product: first ``b``, then ``a``."""
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return [aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz]


def conjugate(q: Vec) -> Vec:
    return [-q[0], -q[1], -q[2], q[3]]


def rotate(q: Vec, v: Vec) -> Vec:
    """The vector turned by the unit quaternion."""
    t = [2 * c for c in cross(q[:3], v)]
    u = cross(q[:3], t)
    return [v[i] + q[3] * t[i] + u[i] for i in range(3)]


def compose(a: tuple[Vec, Vec], b: tuple[Vec, Vec]) -> tuple[Vec, Vec]:
    """The pose ``b`` given in the frame of ``a``, in the frame that ``a`` is given in."""
    moved = rotate(a[1], b[0])
    return [a[0][i] + moved[i] for i in range(3)], multiply(a[1], b[1])


def invert(a: tuple[Vec, Vec]) -> tuple[Vec, Vec]:
    q = conjugate(a[1])
    return [-c for c in rotate(q, a[0])], q


def transform(pose: tuple[Vec, Vec], base: tuple[Vec, Vec], tool: tuple[Vec, Vec], scale: Column | float) -> tuple[Vec, Vec]:
    """Scales the position, then puts the pose between a base and a tool transform."""
    return compose(compose(base, ([c * scale for c in pose[0]], pose[1])), tool)


def rotation_vector(q: Vec) -> Vec:
    """Axis times angle of a unit quaternion, the angle at most pi."""
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    v, w = [c * sign for c in q[:3]], q[3] * sign
    n = norm(v)
    k = F.when(n < 1e-9, F.lit(2.0)).otherwise(2 * F.atan2(n, w) / F.when(n < 1e-9, F.lit(1.0)).otherwise(n))
    return [c * k for c in v]


def orientation_error(actual: Vec, wanted: Vec) -> Vec:
    """Rotation vector that takes ``actual`` to ``wanted``."""
    return rotation_vector(multiply(wanted, conjugate(actual)))


def angle(a: Vec, b: Vec) -> Column:
    """Angle between two unit quaternions, whatever their signs."""
    return 2 * F.acos(F.least(F.abs(dot(a, b)), F.lit(1.0)))


def euler_to_quaternion(x: Column, y: Column, z: Column) -> Vec:
    """Extrinsic rotations about x, then y, then z, in radians."""
    cx, sx, cy, sy, cz, sz = F.cos(x / 2), F.sin(x / 2), F.cos(y / 2), F.sin(y / 2), F.cos(z / 2), F.sin(z / 2)
    return [sx * cy * cz - cx * sy * sz, cx * sy * cz + sx * cy * sz, cx * cy * sz - sx * sy * cz, cx * cy * cz + sx * sy * sz]


def rotvec_to_quaternion(x: Column, y: Column, z: Column) -> Vec:
    n = F.sqrt(x * x + y * y + z * z)
    k = F.when(n < 1e-9, F.lit(0.5)).otherwise(F.sin(n / 2) / F.when(n < 1e-9, F.lit(1.0)).otherwise(n))
    return [x * k, y * k, z * k, F.cos(n / 2)]
