"""Renders as tables: objects of a scene by side, their centres in the image, side images, runtimes, plane placements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlode.operators.scale import union_rows

#: The bounds of a placement's scale, by whether it is fitted to one frame or to an image border.
FRAME_SCALE, BORDER_SCALE = (0.35, 4.0), (0.35, 2.2)


def of_side(name: Column, side: Column | str) -> Column:
    """Whether an object's name names the side."""
    return name.contains(F.concat(F.lit("_"), F.lit(side) if isinstance(side, str) else side, F.lit("_")))


def scene_objects(objects: DataFrame, active: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Adds ``scene``: the objects of each scene without those of parked sides.

    ``active`` has (keys, sides: array<string>), one row per scene. Every object that stays is in scene 'both'; where both sides
    are active, the objects that name a side are again in the scene of that side. Scenes without a row keep all objects; a null
    name names no side.
    """
    d = objects.join(active.select(*keys, F.col("sides").alias("_on")), list(keys), "left").withColumn("_on", F.coalesce("_on", F.array(F.lit("right"), F.lit("left"))))
    names = F.coalesce(F.col(name), F.lit(""))
    parked = [of_side(names, s) & ~F.array_contains("_on", s) for s in ("right", "left")]
    both = F.array_contains("_on", "right") & F.array_contains("_on", "left")
    scenes = F.array_compact(F.array(F.lit("both"), *[F.when(both & of_side(names, s), F.lit(s)) for s in ("right", "left")]))
    return d.filter(~(parked[0] | parked[1])).withColumn("scene", F.explode(scenes)).drop("_on")


def framed(objects: DataFrame, frames: DataFrame, keys: Sequence[str], frame: str = "frame_idx") -> DataFrame:
    """The objects at every frame: those with a frame at that frame, those with a null frame (they do not move) at all frames."""
    fixed = objects.filter(F.col(frame).isNull()).drop(frame).join(frames.select(*keys, frame), list(keys))
    return union_rows(objects.filter(F.col(frame).isNotNull()), fixed.select(*objects.columns))


def side_centres(points: DataFrame, keys: Sequence[str], name: str, u: str, v: str) -> DataFrame:
    """(keys, base_u, base_v, tool_u, tool_v, links, centre_u, centre_v) from projected points of one side per key.

    The base is the object whose name begins with 'base_link_', the tool the point 'pinch' and, without one, the object whose name begins
    with 'ee_base_link_'. Each link counts once, by its part '_00'; ``centre`` is the mean of those that are visible.
    """
    n = F.col(name)
    at = lambda c, cond: F.max(F.when(cond, F.col(c)))
    link = n.endswith("_00") & F.col(u).isNotNull()
    return points.groupBy(*keys).agg(
        *[at(c, n.startswith("base_link_") & n.endswith("_00")).alias(f"base_{o}") for c, o in ((u, "u"), (v, "v"))],
        *[F.coalesce(at(c, n == "pinch"), at(c, n.startswith("ee_base_link_") & n.endswith("_00"))).alias(f"tool_{o}") for c, o in ((u, "u"), (v, "v"))],
        F.count_if(link).alias("links"), *[F.avg(F.when(link, F.col(c))).alias(f"centre_{o}") for c, o in ((u, "u"), (v, "v"))],
    )


def own_or_split(expected: DataFrame, own: DataFrame, combined: DataFrame, keys: Sequence[str], side: str, value: str) -> DataFrame:
    """(keys, side, value, origin): each expected side's own value, else its part of the combined one, else null.

    ``own`` and ``combined`` have one row per (keys, side); a null of ``own`` counts as missing.
    """
    on = [*keys, side]
    d = expected.select(*on).distinct().join(own.select(*on, F.col(value).alias("_own")), on, "left").join(combined.select(*on, F.col(value).alias("_part")), on, "left")
    origin = F.when(F.col("_own").isNotNull(), "own").when(F.col("_part").isNotNull(), "split").otherwise("none")
    return d.select(*on, F.coalesce("_own", "_part").alias(value), origin.alias("origin"))


def preferred_runtimes(manifests: DataFrame, keys: Sequence[str], kinds: Sequence[str], kind: str = "kind", seconds: str = "seconds") -> DataFrame:
    """(keys, kind, seconds): the runtime of the first of ``kinds`` that a clip has a manifest of; of repeats the longest."""
    place = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col(kind))
    known = manifests.filter(F.col(kind).isin(*kinds))
    return known.groupBy(*keys).agg(F.min_by(F.struct(F.col(kind), F.col(seconds)), F.struct(place, -F.col(seconds))).alias("r")).select(*keys, f"r.{kind}", f"r.{seconds}")


def render_runtimes(scenes: DataFrame, manifests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, seconds, error): the longest of a clip's renders, where all are there, of the present scene and whole; else why not.

    ``scenes`` has (keys, side, signature), ``manifests`` (keys, side, signature, seconds, missing), one row per side each;
    a combined render has side 'both'. Errors in order: 'incomplete sides' (one of two side scenes only), 'no render',
    'stale render', 'incomplete render'.
    """
    d = scenes.select(*keys, "side", F.col("signature").alias("_now")).join(manifests.select(*keys, "side", "signature", "seconds", "missing"), [*keys, "side"], "left")
    one = d.groupBy(*keys).agg(
        F.count_if(F.col("side") != "both").alias("_sides"), F.count_if(F.col("seconds").isNull()).alias("_none"), F.count_if(F.col("seconds").isNotNull() & ~F.col("_now").eqNullSafe(F.col("signature"))).alias("_stale"),
        F.count_if(F.col("missing") > 0).alias("_lost"), F.max("seconds").alias("_s"),
    )
    error = F.when(F.col("_sides") == 1, "incomplete sides").when(F.col("_none") > 0, "no render").when(F.col("_stale") > 0, "stale render").when(F.col("_lost") > 0, "incomplete render")
    return one.select(*keys, F.when(error.isNull(), F.col("_s")).alias("seconds"), error.alias("error"))


Point = tuple[Column, Column]


def _length(p: Point) -> Column:
    return F.sqrt(p[0] * p[0] + p[1] * p[1])


def _axis(base: Point, tool: Point) -> Point:
    return tool[0] - base[0], tool[1] - base[1]


def turn_between(a: Point, b: Point) -> Column:
    """The angle from one axis to another, in -pi..pi."""
    return F.atan2(a[0] * b[1] - a[1] * b[0], a[0] * b[0] + a[1] * b[1])


def _placed(scale: Column, angle: Column, source: Point, target: Point) -> dict[str, Column]:
    c, s = scale * F.cos(angle), scale * F.sin(angle)
    return {"scale": scale, "angle": angle, "dx": target[0] - (c * source[0] - s * source[1]), "dy": target[1] - (s * source[0] + c * source[1])}


def frame_similarity(base: Point, tool: Point, to_base: Point, to_tool: Point) -> dict[str, Column]:
    """scale, angle, dx, dy that take base to base and the axis to the axis; null where either axis has no length."""
    a, b = _axis(base, tool), _axis(to_base, to_tool)
    ok = (_length(a) >= 1e-6) & (_length(b) >= 1e-6)
    scale = F.when(ok, F.least(F.greatest(F.try_divide(_length(b), _length(a)), F.lit(FRAME_SCALE[0])), F.lit(FRAME_SCALE[1])))
    return _placed(scale, F.when(ok, turn_between(a, b)), base, to_base)


def fixed_scale_similarity(base: Point, tool: Point, to_base: Point, to_tool: Point, scale: Column) -> dict[str, Column]:
    """The same with a given scale, taking tool to tool: the source arm may be seen in part only."""
    a, b = _axis(base, tool), _axis(to_base, to_tool)
    ok = (_length(a) >= 1e-6) & (_length(b) >= 1e-6)
    return _placed(F.when(ok, scale), F.when(ok, turn_between(a, b)), tool, to_tool)


def border_similarities(pixels: DataFrame, keys: Sequence[str], x: str, y: str, base: Point, tool: Point, entry: Point, to_tool: Point, width: int, height: int) -> DataFrame:
    """(keys, scale, angle, dx, dy): tool to tool, scaled so that the silhouette reaches the border where the target enters.

    ``pixels`` has a row per silhouette pixel (``x``, ``y``), with the four points repeated within a key. The reach is the 0.2 % quantile
    of the turned pixels towards that border; where it points the other way, the silhouette's span is scaled to the axis. A key is
    one image of one side, which bounds its rows.
    """
    a, b = _axis(base, tool), _axis(entry, to_tool)
    ok = (_length(a) >= 1e-6) & (_length(b) >= 1e-6)
    names = {"_ang": F.when(ok, turn_between(a, b)), "_tx": tool[0], "_ty": tool[1], "_gx": to_tool[0], "_gy": to_tool[1], "_ex": entry[0], "_ey": entry[1], "_len": _length(b)}
    d = pixels.withColumns(names)
    rx, ry = F.col(x) - F.col("_tx"), F.col(y) - F.col("_ty")
    c, s = F.cos("_ang"), F.sin("_ang")
    d = d.withColumns({"_rx": c * rx - s * ry, "_ry": s * rx + c * ry})
    one = d.groupBy(*keys).agg(*[F.first(n).alias(n) for n in names], *[F.percentile(f"_r{k}", q).alias(f"_{k}{n}") for k in "xy" for n, q in (("lo", 0.002), ("hi", 0.998))], *[(F.max(f"_r{k}") - F.min(f"_r{k}")).alias(f"_span{k}") for k in "xy"])
    far = {"left": F.col("_ex"), "right": width - 1 - F.col("_ex"), "top": F.col("_ey"), "bottom": height - 1 - F.col("_ey")}
    near = F.least(*far.values())
    reach = F.when(far["left"] == near, F.col("_xlo")).when(far["right"] == near, F.col("_xhi")).when(far["top"] == near, F.col("_ylo")).otherwise(F.col("_yhi"))
    wanted = F.when((far["left"] == near) | (far["right"] == near), F.col("_ex") - F.col("_gx")).otherwise(F.col("_ey") - F.col("_gy"))
    raw = F.when((F.abs(reach) < 1e-6) | (wanted * reach <= 0), F.col("_len") / F.greatest("_spanx", "_spany", F.lit(1.0))).otherwise(F.try_divide(wanted, reach))
    scale = F.when(F.col("_ang").isNotNull(), F.least(F.greatest(raw, F.lit(BORDER_SCALE[0])), F.lit(BORDER_SCALE[1])))
    return one.select(*keys, *[c.alias(n) for n, c in _placed(scale, F.col("_ang"), (F.col("_tx"), F.col("_ty")), (F.col("_gx"), F.col("_gy"))).items()])
