"""Cameras and colour as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from armlode.functions import pose as P


def project(point: list[Column], fx: Column | float, fy: Column | float, cx: Column | float, cy: Column | float) -> tuple[Column, Column, Column]:
    """(u, v, visible) of a point in the camera's frame; nothing is visible at or behind 1e-6 m."""
    x, y, z = point
    ok = z > 1e-6
    return F.when(ok, F.try_divide(x, z) * fx + cx), F.when(ok, F.try_divide(y, z) * fy + cy), ok


def into_camera(point: list[Column], camera: tuple[list[Column], list[Column]]) -> list[Column]:
    """A point of the world in the frame of a camera given by its pose."""
    p, q = camera
    return P.rotate(P.conjugate(q), [a - b for a, b in zip(point, p)])


def map_camera(camera: tuple[list[Column], list[Column]], base: tuple[list[Column], list[Column]], scale: Column | float) -> tuple[list[Column], list[Column]]:
    """A camera's pose carried through a similarity: its position scaled, then both moved by the base."""
    return P.compose(base, ([c * scale for c in camera[0]], camera[1]))


def scale_intrinsics(fx: Column, fy: Column, cx: Column, cy: Column, across: Column, down: Column) -> list[Column]:
    """Intrinsics of an image resized by the two factors."""
    return [fx * across, fy * down, cx * across, cy * down]


def lens_and_shift(fx: Column, fy: Column, cx: Column, cy: Column, width: int, height: int, sensor_mm: float = 36.0) -> dict[str, Column]:
    """A renderer's lens, pixel aspect and shifts for pinhole intrinsics."""
    return {"lens_mm": fx * sensor_mm / width, "pixel_aspect": fx / fy, "shift_x": (width / 2 - cx) / width, "shift_y": (cy - height / 2) / width}


def srgb_to_linear(c: Column) -> Column:
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def linear_to_srgb(c: Column) -> Column:
    return F.when(c <= 0.0031308, c * 12.92).otherwise(1.055 * F.pow(F.greatest(c, F.lit(0.0)), F.lit(1 / 2.4)) - 0.055)


def psnr(mse: Column) -> Column:
    return 10 * F.log10(255.0 * 255.0 / F.greatest(mse, F.lit(1e-12)))


def interpolate(x: Column, knots: Column, values: Column) -> Column:
    """Piecewise linear between knots made non-decreasing, held at the ends."""
    rising = F.slice(F.aggregate(knots, F.array(F.lit(float("-inf"))), lambda a, k: F.array_append(a, F.greatest(F.element_at(a, -1), k))), F.lit(2), F.size(knots))
    n = F.size(rising)
    at = F.size(F.filter(rising, lambda k: k <= x))
    x0, x1, y0, y1 = F.get(rising, at - 1), F.get(rising, at), F.get(values, at - 1), F.get(values, at)
    return F.when(at == 0, F.get(values, F.lit(0))).when(at >= n, F.get(values, n - 1)).otherwise(y0 + (y1 - y0) * F.coalesce(F.try_divide(x - x0, x1 - x0), F.lit(0.0)))
