"""Gripper geometry and closure modes as Column expressions. Closure is 0 open, 1 closed."""

from __future__ import annotations

from math import atan2, cos, hypot, sin

from pyspark.sql import Column
from pyspark.sql import functions as F

from armlode.functions import pose as P

# The target gripper's finger geometry, metres and radians.
MAX_ANGLE = 0.7854
PIVOT_X = -0.00143
PIVOT_OFFSET = 0.018
PIVOT_Z = -0.068
PAD_REACH = 0.09534

MAX_APERTURE = 2 * (PIVOT_OFFSET - PIVOT_OFFSET * cos(MAX_ANGLE) + PAD_REACH * sin(MAX_ANGLE))
CLOSED_Z = PIVOT_Z - PAD_REACH


def clip(c: Column, low: float, high: float) -> Column:
    """Kept within low and high; null stays null, which least and greatest alone would pass over."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def aperture_of_angle(angle: Column) -> Column:
    """Distance between the pads at an opening angle."""
    a = clip(angle, 0.0, MAX_ANGLE)
    return 2 * (PIVOT_OFFSET - PIVOT_OFFSET * F.cos(a) + PAD_REACH * F.sin(a))


def angle_of_aperture(aperture: Column) -> Column:
    """The opening angle of a distance between the pads; out of reach is clipped."""
    half = clip(aperture, 0.0, MAX_APERTURE) / 2 - PIVOT_OFFSET
    return clip(F.asin(clip(half / hypot(PIVOT_OFFSET, PAD_REACH), -1.0, 1.0)) + atan2(PIVOT_OFFSET, PAD_REACH), 0.0, MAX_ANGLE)


def opening_angle(closure: Column) -> Column:
    return (1 - clip(closure, 0.0, 1.0)) * MAX_ANGLE


def closure_of_aperture(aperture: Column) -> Column:
    return 1 - angle_of_aperture(aperture) / MAX_ANGLE


def aperture_of_closure(closure: Column) -> Column:
    return aperture_of_angle(opening_angle(closure))


def finger_angles(right: Column, left: Column) -> list[Column]:
    """The four finger joints: the right ones close from below zero, the left ones from above."""
    r, k = opening_angle(right), opening_angle(left)
    return [-r, -r, k, k]


def finger_angle(side: Column, closure: Column) -> Column:
    """The finger joint of one side: not positive on the right (0), not negative on the left (1)."""
    return F.when(side == 0, -opening_angle(closure)).otherwise(opening_angle(closure))


def pinch_midpoint(closure: Column) -> list[Column]:
    """The middle between the pads in the gripper's own frame."""
    a = opening_angle(closure)
    return [F.lit(PIVOT_X), F.lit(0.0), PIVOT_Z - (PIVOT_OFFSET * F.sin(a) + PAD_REACH * F.cos(a))]


def keep_pinch_centre(pose: tuple[list[Column], list[Column]], closure: Column, offset: list[Column] | None = None) -> tuple[list[Column], list[Column]]:
    """(moved position, target): the position that keeps the middle between the pads where it is when closed."""
    p, q = pose
    wanted = [F.lit(PIVOT_X), F.lit(0.0), F.lit(CLOSED_Z)]
    if offset is not None:
        wanted = [a + b for a, b in zip(wanted, offset)]
    now = pinch_midpoint(closure)
    target = [a + b for a, b in zip(p, P.rotate(q, wanted))]
    moved = [a + b for a, b in zip(p, P.rotate(q, [a - b for a, b in zip(wanted, now)]))]
    return moved, target


def linear_closure(value: Column, open_value: Column, closed_value: Column) -> Column:
    """Closure between two declared values; null where they are equal."""
    span = closed_value - open_value
    return F.when(F.abs(span) >= 1e-9, clip(F.try_divide(value - open_value, span), 0.0, 1.0))


def percentile_closure(value: Column, low: Column, high: Column) -> Column:
    """Closure between the 1st and 99th percentile of an episode."""
    return clip((value - low) / F.greatest(high - low, F.lit(1e-6)), 0.0, 1.0)


def mean_of_fingers(values: Column, places: list[int] | None = None) -> Column:
    """Closure as the mean of the fingers at ``places`` (all when None)."""
    chosen = F.array(*[F.get(values, F.lit(i)) for i in places]) if places else values
    return clip(F.aggregate(chosen, F.lit(0.0), lambda a, x: a + x) / F.size(chosen), 0.0, 1.0)
