"""Image layers as rows: masks, plates, composites and their metrics.

A layer is (clip, frame_idx, h, w, c, data): rows of bytes. Layers are joined by clip and frame number in Spark;
what happens within one image is numpy on an Arrow batch, what happens over images is aggregates and windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["clip", "frame_idx"]
LAYER = "clip string, frame_idx long, h int, w int, c int, data binary"
#: Limits of a mask audit.
AREA_JUMP_P95, TEMPORAL_IOU_P05, RECALL, OVERLAP = 0.08, 0.35, 0.98, 0.01


def image(data: bytes, h: int, w: int, c: int) -> np.ndarray:
    a = np.frombuffer(data, dtype=np.uint8)
    return a.reshape(h, w) if c == 1 else a.reshape(h, w, c)


def dilate(m: np.ndarray, r: int) -> np.ndarray:
    """Grown by a square of radius r, by shifted ors along each axis."""
    for axis in (0, 1):
        out = m.copy()
        for k in range(1, r + 1):
            lead, trail = [slice(None)] * 2, [slice(None)] * 2
            lead[axis], trail[axis] = slice(k, None), slice(None, -k)
            if m.shape[axis] > k:
                out[tuple(lead)] |= m[tuple(trail)]
                out[tuple(trail)] |= m[tuple(lead)]
        m = out
    return m


def close(m: np.ndarray, r: int) -> np.ndarray:
    """Grown then shrunk; the image's edge counts as unset outside."""
    padded = np.pad(m, r)
    grown = dilate(padded, r)
    return ~dilate(~grown, r)[r : r + m.shape[0], r : r + m.shape[1]]


def components(m: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels of 4-connected parts: the least index spreads until nothing changes."""
    label = np.where(m, np.arange(1, m.size + 1).reshape(m.shape), 0)
    big = m.size + 1
    while True:
        p = np.pad(np.where(m, label, big), 1, constant_values=big)
        new = np.where(m, np.minimum.reduce([p[1:-1, 1:-1], p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]]), 0)
        if (new == label).all():
            break
        label = new
    values, inverse = np.unique(label, return_inverse=True)
    first = int(values[0] == 0)
    return inverse.reshape(m.shape) + (1 - first), len(values) - first


def hull(m: np.ndarray) -> np.ndarray:
    """The convex hull of set pixels, filled."""
    ys, xs = np.nonzero(m)
    if len(xs) < 3:
        return m
    pts = sorted(set(zip(xs.tolist(), ys.tolist())))

    def half(points):
        out = []
        for p in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    poly = half(pts) + half(pts[::-1])
    if len(poly) < 3:
        return m
    yy, xx = np.mgrid[: m.shape[0], : m.shape[1]]
    inside = np.ones(m.shape, dtype=bool)
    for (x0, y0), (x1, y1) in zip(poly, poly[1:] + poly[:1]):
        inside &= (x1 - x0) * (yy - y0) - (y1 - y0) * (xx - x0) >= 0
    return inside | m


def per_frame(df: DataFrame, fn: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """A row for a row: ``fn`` takes a dict of the row's values and gives the new row, or None for none."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [r for r in (fn(d) for d in f.to_dict("records")) if r is not None]
            yield pd.DataFrame(rows, columns=names)

    return df.mapInPandas(run, schema)


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*KEYS, *[F.col(c).alias(f"{name}_{c}") for c in ("h", "w", "c", "data")])


def joined(how: str = "inner", **layers: DataFrame) -> DataFrame:
    """Layers side by side by clip and frame; with 'full' a frame that any layer lacks shows as null."""
    out = None
    for name, df in layers.items():
        out = _side(df, name) if out is None else out.join(_side(df, name), KEYS, how)
    return out


def _get(d: dict, name: str, threshold: int | None = None) -> np.ndarray:
    a = image(d[f"{name}_data"], int(d[f"{name}_h"]), int(d[f"{name}_w"]), int(d[f"{name}_c"]))
    return a if threshold is None else a > threshold


def _layer(d: dict, a: np.ndarray) -> dict:
    a = (a * np.uint8(255)) if a.dtype == bool else a.astype(np.uint8)
    return {"clip": d["clip"], "frame_idx": d["frame_idx"], "h": a.shape[0], "w": a.shape[1], "c": 1 if a.ndim == 2 else a.shape[2], "data": a.tobytes()}


# masks


def refine_masks(masks: DataFrame, protected: DataFrame | None = None, closing: int = 2, dilation: int = 3, margin: int = 0, threshold: int = 0) -> DataFrame:
    """Masks closed and grown; protected pixels (with a margin) are taken out where a layer of them is given."""
    if protected is None:
        return per_frame(_side(masks, "m"), lambda d: _layer(d, dilate(close(_get(d, "m", threshold), closing), dilation)), LAYER)
    return per_frame(joined(m=masks, p=protected), lambda d: _layer(d, dilate(close(_get(d, "m", threshold), closing), dilation) & ~dilate(_get(d, "p", threshold), margin)), LAYER)


def protect_hulls(masks: DataFrame, dilation: int = 1, least: int = 8, threshold: int = 0) -> DataFrame:
    """Each part of at least ``least`` pixels filled to its convex hull, then grown."""

    def fill(d: dict) -> dict:
        m = _get(d, "m", threshold)
        label, n = components(m)
        out = m.copy()
        for k in range(1, n + 1):
            if (label == k).sum() >= least:
                out |= hull(label == k)
        return _layer(d, dilate(out, dilation))

    return per_frame(_side(masks, "m"), fill, LAYER)


def fuse_masks(robot: DataFrame, gripper: DataFrame, radius: int = 4, least: int = 4, threshold: int = 0) -> DataFrame:
    """Robot masks with those gripper parts that touch the robot grown by ``radius`` and are large enough."""

    def fuse(d: dict) -> dict:
        a, b = _get(d, "r", threshold), _get(d, "g", threshold)
        near = dilate(a, radius)
        label, n = components(b)
        for k in range(1, n + 1):
            part = label == k
            if part.sum() >= least and (part & near).any():
                a = a | part
        return _layer(d, a)

    return per_frame(joined(r=robot, g=gripper), fuse, LAYER)


def mask_counts(masks: DataFrame, threshold: int = 0) -> DataFrame:
    """(clip, frame_idx, size, area, shared): pixels, set pixels, and pixels set here and in the frame before."""
    w = Window.partitionBy("clip").orderBy("frame_idx")
    d = _side(masks, "m").withColumn("before", F.lag("m_data").over(w))

    def count(d: dict) -> dict:
        m = _get(d, "m", threshold)
        b = None if d["before"] is None else np.frombuffer(d["before"], dtype=np.uint8).reshape(m.shape) > threshold
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "size": m.size, "area": int(m.sum()), "shared": None if b is None else int((m & b).sum()), "before": None if b is None else int(b.sum())}

    return per_frame(d, count, "clip string, frame_idx long, size long, area long, shared long, before long")


def audit_masks(masks: DataFrame, threshold: int = 0) -> DataFrame:
    """Per clip: empty frames, the 95th percentile of area jumps, the 5th of overlap with the frame before, and ``ok``.

    Two empty masks overlap fully.
    """
    d = mask_counts(masks, threshold)
    union = F.col("area") + F.col("before") - F.col("shared")
    iou = F.when(F.col("before").isNull(), None).when(union == 0, 1.0).otherwise(F.col("shared") / union)
    jump = F.abs(F.col("area") - F.col("before")) / F.col("size")
    agg = d.groupBy("clip").agg(F.count("*").alias("frames"), F.count_if(F.col("area") == 0).alias("empty"), F.percentile(jump, 0.95).alias("area_jump_p95"), F.percentile(iou, 0.05).alias("temporal_iou_p05"))
    return agg.withColumn("ok", (F.col("empty") == 0) & (F.coalesce("area_jump_p95", F.lit(0.0)) <= AREA_JUMP_P95) & (F.coalesce("temporal_iou_p05", F.lit(1.0)) >= TEMPORAL_IOU_P05))


def overlaps(a: DataFrame, b: DataFrame, threshold: int = 0) -> DataFrame:
    """(clip, frame_idx, iou, containment, recall) of mask a against b; empty unions overlap fully, an empty a contains nothing."""

    def count(d: dict) -> dict:
        x, y = _get(d, "a", threshold), _get(d, "b", threshold)
        both, either = int((x & y).sum()), int((x | y).sum())
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "iou": both / either if either else 1.0, "containment": both / x.sum() if x.any() else 0.0, "recall": both / y.sum() if y.any() else 1.0}

    return per_frame(joined(a=a, b=b), count, "clip string, frame_idx long, iou double, containment double, recall double")


def temporal_max(masks: DataFrame, radius: int = 2) -> DataFrame:
    """Each mask with those up to ``radius`` frames away, by a window that collects them."""
    w = Window.partitionBy("clip").orderBy("frame_idx").rowsBetween(-radius, radius)
    d = _side(masks, "m").withColumn("near", F.collect_list("m_data").over(w))
    return per_frame(d, lambda d: _layer(d, np.maximum.reduce([image(x, int(d["m_h"]), int(d["m_w"]), int(d["m_c"])) for x in d["near"]])), LAYER)


# plates and composites


def clean_plate(video: DataFrame, masks: DataFrame, least: int = 3, most_mad: float = 12.0, tile: int = 32, threshold: int = 0) -> DataFrame:
    """(clip, y, x, value, mad, seen, reliable): the background of a fixed camera, per pixel of a grey video.

    The median over the frames in which the pixel is not masked, and the median deviation from it. Images
    are cut into tiles of rows that are grouped in Spark; within a tile's group medians are vectorised. A group
    holds ``tile`` rows of all frames of one clip.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for d in f.to_dict("records"):
                v, m = _get(d, "v"), _get(d, "m", threshold)
                for y in range(0, v.shape[0], tile):
                    rows.append((d["clip"], y, d["frame_idx"], v.shape[1], v[y : y + tile].tobytes(), m[y : y + tile].tobytes()))
            yield pd.DataFrame(rows, columns=["clip", "y0", "frame_idx", "w", "v", "m"])

    def medians(f: pd.DataFrame) -> pd.DataFrame:
        w = int(f["w"].iloc[0])
        v = np.stack([np.frombuffer(x, dtype=np.uint8).reshape(-1, w) for x in f["v"]]).astype(float)
        hidden = np.stack([np.frombuffer(x, dtype=bool).reshape(-1, w) for x in f["m"]])
        seen = (~hidden).sum(axis=0)
        v[hidden] = np.nan
        with np.errstate(all="ignore"):
            import warnings

            warnings.simplefilter("ignore")
            mid = np.nanmedian(v, axis=0)
            mad = np.nanmedian(np.abs(v - mid), axis=0)
        yy, xx = np.mgrid[: mid.shape[0], :w]
        return pd.DataFrame({"clip": f["clip"].iloc[0], "y": (yy + int(f["y0"].iloc[0])).ravel(), "x": xx.ravel(), "value": mid.ravel(), "mad": mad.ravel(), "seen": seen.ravel()})

    tiles = joined(v=video, m=masks).mapInPandas(cut, "clip string, y0 int, frame_idx long, w int, v binary, m binary")
    out = tiles.groupBy("clip", "y0").applyInPandas(medians, "clip string, y int, x int, value double, mad double, seen int")
    nanless = lambda c: F.when(~F.isnan(c), F.col(c))
    return out.withColumns({"value": nanless("value"), "mad": nanless("mad")}).withColumn("reliable", F.coalesce((F.col("seen") >= least) & (F.col("mad") <= most_mad), F.lit(False)))


def alpha_over(background: DataFrame, rgba: DataFrame, linear: bool = True) -> DataFrame:
    """RGBA frames over grey or RGB ones, in linear light or as displayed."""
    to_linear = lambda x: np.where(x <= 0.04045, x / 12.92, ((x + 0.055) / 1.055) ** 2.4)
    to_display = lambda x: np.where(x <= 0.0031308, x * 12.92, 1.055 * np.maximum(x, 0) ** (1 / 2.4) - 0.055)

    def over(d: dict) -> dict:
        b, f = _get(d, "b").astype(float) / 255, _get(d, "f").astype(float) / 255
        b = b[..., None].repeat(3, axis=2) if b.ndim == 2 else b
        a = f[..., 3:]
        mixed = to_display(to_linear(f[..., :3]) * a + to_linear(b) * (1 - a)) if linear else f[..., :3] * a + b * (1 - a)
        return _layer(d, np.clip(np.rint(mixed * 255), 0, 255))

    return per_frame(joined(b=background, f=rgba), over, LAYER)


def change_metrics(source: DataFrame, output: DataFrame, masks: DataFrame, threshold: int = 0, copied: float = 3.0) -> DataFrame:
    """(clip, frame_idx, outside_sum, outside_count, inside_sum, inside_count, copy_fraction): sums, so ratios can be taken over all frames."""

    def measure(d: dict) -> dict:
        a, b, m = _get(d, "s").astype(float), _get(d, "o").astype(float), _get(d, "m", threshold)
        diff = np.abs(a - b) if a.ndim == 2 else np.abs(a - b).mean(axis=2)
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "outside_sum": diff[~m].sum(), "outside_count": int((~m).sum()), "inside_sum": diff[m].sum(), "inside_count": int(m.sum()), "copy_fraction": float((diff[m] <= copied).mean()) if m.any() else 0.0}

    return per_frame(joined(s=source, o=output, m=masks), measure, "clip string, frame_idx long, outside_sum double, outside_count long, inside_sum double, inside_count long, copy_fraction double")


def parity(**layers: DataFrame) -> DataFrame:
    """(clip, missing): frames that some of the layers lack, per clip."""
    d = joined("full", **layers)
    lacks = F.greatest(*[F.col(f"{n}_data").isNull().cast("int") for n in layers])
    return d.groupBy("clip").agg(F.sum(lacks).alias("missing"))


def harmonise(rgba: DataFrame, background: DataFrame, keep: float = 0.9) -> DataFrame:
    """(clip, frame_idx, gain, shift): per frame how a grey foreground's median and spread map to those of its background.

    Averaged over frames with weight ``keep`` for what was before; frames with fewer than 32 set pixels pass it on.
    The statistics are per frame, the average folds over a clip's frames in order.
    """

    def stats(d: dict) -> dict:
        f, b = _get(d, "f").astype(float), _get(d, "b").astype(float)
        on = f[..., 3] >= 8
        g, b = f[..., :3].mean(axis=2), b if b.ndim == 2 else b.mean(axis=2)
        spread = lambda x: max(float(np.subtract(*np.percentile(x, [75, 25]))), 1.0)
        usable = int(on.sum()) >= 32
        gain = float(np.clip(spread(b) / spread(g[on]), 0.5, 2.0)) if usable else None
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "gain": gain, "shift": float(np.median(b) - gain * np.median(g[on])) if usable else None}

    raw = per_frame(joined(f=rgba, b=background), stats, "clip string, frame_idx long, gain double, shift double")
    w = Window.partitionBy("clip").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.array_compact(F.collect_list(F.struct("gain", "shift")).over(w))
    used = F.filter(so_far, lambda s: s["gain"].isNotNull())
    fold = lambda n: F.when(F.size(used) > 0, F.aggregate(used, F.get(used, F.lit(0))[n], lambda c, s: keep * c + (1 - keep) * s[n]))
    return raw.select(*KEYS, fold("gain").alias("gain"), fold("shift").alias("shift"))


def harmonised(rgba: DataFrame, background: DataFrame, keep: float = 0.9) -> DataFrame:
    """RGBA frames with the gain and shift of :func:`harmonise` on the colours of their set pixels; alpha stays."""

    def adjust(d: dict) -> dict:
        out = _get(d, "f").copy()
        if pd.notna(d["gain"]):
            on = out[..., 3] >= 8
            out[on, :3] = np.clip(np.rint(out[on, :3] * d["gain"] + d["shift"]), 0, 255)
        return _layer(d, out)

    return per_frame(_side(rgba, "f").join(harmonise(rgba, background, keep), KEYS, "left"), adjust, LAYER)


def union_masks(layers: DataFrame, threshold: int = 0) -> DataFrame:
    """One mask per frame from any number of layers of it (one row per object), by a grouped or."""
    rows = layers.groupBy(*KEYS).agg(F.first("h").alias("m_h"), F.first("w").alias("m_w"), F.first("c").alias("m_c"), F.collect_list("data").alias("all"))
    return per_frame(rows, lambda d: _layer(d, np.logical_or.reduce([image(x, int(d["m_h"]), int(d["m_w"]), int(d["m_c"])) > threshold for x in d["all"]])), LAYER)


def temporal_change(source: DataFrame, output: DataFrame, masks: DataFrame, threshold: int = 0) -> DataFrame:
    """(clip, frame_idx, changed_sum, count): how far the change from the frame before differs between output and source, where neither frame is masked.

    The frame before comes from a window over the clip; sums allow a ratio over all frames.
    """
    w = Window.partitionBy("clip").orderBy("frame_idx")
    d = joined(s=source, o=output, m=masks)
    d = d.withColumns({f"{n}_before": F.lag(f"{n}_data").over(w) for n in ("s", "o", "m")}).filter("s_before is not null")

    def measure(d: dict) -> dict:
        now = {n: _get(d, n).astype(float) for n in ("s", "o")}
        was = {n: image(d[f"{n}_before"], int(d[f"{n}_h"]), int(d[f"{n}_w"]), int(d[f"{n}_c"])).astype(float) for n in ("s", "o")}
        free = ~(_get(d, "m", threshold) | (image(d["m_before"], int(d["m_h"]), int(d["m_w"]), int(d["m_c"])) > threshold))
        diff = np.abs((now["o"] - was["o"]) - (now["s"] - was["s"]))
        diff = diff if diff.ndim == 2 else diff.mean(axis=2)
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "changed_sum": float(diff[free].sum()), "count": int(free.sum())}

    return per_frame(d, measure, "clip string, frame_idx long, changed_sum double, count long")


def restore_protected(source: DataFrame, clean: DataFrame, protected: DataFrame, least_share: float = 0.25, threshold: int = 0) -> DataFrame:
    """Clean frames with the protected pixels of the source put back, but in frames whose mask is far smaller than the clip's median non-empty one."""
    usual = mask_counts(protected, threshold).filter("area > 0").groupBy("clip").agg(F.percentile("area", 0.5).alias("usual"))
    d = joined(s=source, o=clean, m=protected).join(usual, "clip", "left")

    def restore(d: dict) -> dict:
        m, out = _get(d, "m", threshold), _get(d, "o").copy()
        if d["usual"] is not None and m.sum() >= least_share * d["usual"]:
            out[m] = _get(d, "s")[m]
        return _layer(d, out)

    return per_frame(d, restore, LAYER)


def render_report(rgba: DataFrame, least_visible: float = 0.0, seen_from: int = 8) -> DataFrame:
    """Per clip: frames, frames without anything visible, and the mean visible part; ``ok`` when none is empty."""
    d = per_frame(_side(rgba, "f"), lambda d: {"clip": d["clip"], "frame_idx": d["frame_idx"], "visible": float((_get(d, "f")[..., 3] >= seen_from).mean())}, "clip string, frame_idx long, visible double")
    agg = d.groupBy("clip").agg(F.count("*").alias("frames"), F.count_if(F.col("visible") <= least_visible).alias("empty"), F.avg("visible").alias("visible_fraction"))
    return agg.withColumn("ok", F.col("empty") == 0)


def depth_report(depth: DataFrame, rgba: DataFrame) -> DataFrame:
    """Per clip the part of visible pixels that have a finite positive depth. ``depth`` holds (clip, frame_idx, h, w, depth_m)."""
    d = _side(rgba, "f").join(depth.select(*KEYS, F.col("depth_m").alias("z")), KEYS, "left")

    def cover(d: dict) -> dict:
        on = _get(d, "f")[..., 3] > 0
        z = None if d["z"] is None else np.asarray(d["z"], dtype=float).reshape(on.shape)
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "on": int(on.sum()), "hit": 0 if z is None else int((on & np.isfinite(z) & (z > 0)).sum()), "given": z is not None}

    rows = per_frame(d, cover, "clip string, frame_idx long, on long, hit long, given boolean")
    agg = rows.groupBy("clip").agg(F.count("*").alias("frames"), F.count_if(~F.col("given")).alias("missing"), (F.sum("hit") / F.greatest(F.sum("on"), F.lit(1))).alias("coverage"))
    return agg.withColumn("ok", (F.col("missing") == 0) & (F.col("coverage") >= 0.99))


def same_alpha(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per clip the frames that both hold and those whose alpha differs anywhere."""
    d = per_frame(joined(a=a, b=b), lambda d: {"clip": d["clip"], "frame_idx": d["frame_idx"], "differs": int((_get(d, "a")[..., 3] != _get(d, "b")[..., 3]).sum())}, "clip string, frame_idx long, differs long")
    return d.groupBy("clip").agg(F.count("*").alias("frames"), F.count_if(F.col("differs") > 0).alias("different"))


def edge_components(masks: DataFrame, least: int = 1, threshold: int = 0) -> DataFrame:
    """Only the parts of a mask that touch the image's left, right or lower edge and are large enough."""

    def keep(d: dict) -> dict:
        m = _get(d, "m", threshold)
        label, n = components(m)
        out = np.zeros_like(m)
        for k in range(1, n + 1):
            part = label == k
            if part.sum() >= least and (part[:, 0].any() or part[:, -1].any() or part[-1].any()):
                out |= part
        return _layer(d, out)

    return per_frame(_side(masks, "m"), keep, LAYER)


def panels(**layers: DataFrame) -> DataFrame:
    """Layers of equal height side by side, as RGB."""
    names = list(layers)

    def put(d: dict) -> dict:
        parts = [_get(d, n) for n in names]
        return _layer(d, np.concatenate([p[..., None].repeat(3, axis=2) if p.ndim == 2 else p[..., :3] for p in parts], axis=1))

    return per_frame(joined(**layers), put, LAYER)


def light_samples(rgba: DataFrame, background: DataFrame, stride: int = 8, opaque: int = 224, masks: DataFrame | None = None) -> DataFrame:
    """Per clip the 10th, 50th and 90th percentile of grey levels of opaque foreground and of background, over every ``stride``-th frame.

    With ``masks`` only the background's masked pixels count. Each frame gives its levels with their counts.
    """

    masked = masks is not None

    def counted(x: np.ndarray) -> list[dict]:
        v, n = np.unique(x, return_counts=True)
        return [{"v": float(a), "n": int(k)} for a, k in zip(v, n)]

    def sample(d: dict) -> dict:
        f, b = _get(d, "f").astype(float), _get(d, "b").astype(float)
        b = b if b.ndim == 2 else b.mean(axis=2)
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "front": counted(f[..., :3].mean(axis=2)[f[..., 3] >= opaque]), "back": counted(b[_get(d, "m", 0)] if masked else b)}

    d = joined(f=rgba, b=background, **({"m": masks} if masked else {})).filter(F.col("frame_idx") % stride == 0)
    long = per_frame(d, sample, "clip string, frame_idx long, front array<struct<v:double,n:long>>, back array<struct<v:double,n:long>>")
    layers = F.explode(F.array(*[F.struct(F.lit(n).alias("layer"), F.col(n).alias("levels")) for n in ("front", "back")]))
    levels = long.select("clip", layers.alias("l")).select("clip", "l.layer", F.explode("l.levels").alias("p")).groupBy("clip", "layer", F.col("p.v").alias("v")).agg(F.sum("p.n").alias("n"))
    return levels.groupBy("clip", "layer").agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)), F.col("n")).alias("levels"))


def _lens_map(h: int, w: int, k: tuple[float, float, float, float], lens: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """For every pixel of the image through the lens, where it lies in the ideal image: the lens model solved by fixed-point steps."""
    fx, fy, cx, cy = k
    k1, k2, p1, p2, k3 = lens
    yy, xx = np.mgrid[:h, :w].astype(float)
    xd, yd = (xx - cx) / fx, (yy - cy) / fy
    x, y = xd.copy(), yd.copy()
    for _ in range(12):
        r2 = x * x + y * y
        radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
        dx, dy = 2 * p1 * x * y + p2 * (r2 + 2 * x * x), p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
        x, y = (xd - dx) / radial, (yd - dy) / radial
    return y * fy + cy, x * fx + cx


def _bilinear(a: np.ndarray, v: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Values [h, w, c] at (v, u); nothing lies outside."""
    y0, x0 = np.floor(v).astype(int), np.floor(u).astype(int)
    out = np.zeros((*v.shape, a.shape[2]))
    for dy in (0, 1):
        for dx in (0, 1):
            yy, xx = y0 + dy, x0 + dx
            weight = (1 - np.abs(v - yy)) * (1 - np.abs(u - xx))
            inside = (yy >= 0) & (yy < a.shape[0]) & (xx >= 0) & (xx < a.shape[1])
            out[inside] += weight[inside][:, None] * a[yy[inside], xx[inside]]
    return out


def through_lens(rgba: DataFrame, intrinsics: tuple[float, float, float, float], lens: tuple[float, float, float, float, float]) -> DataFrame:
    """Ideal RGBA renders as the lens (k1, k2, p1, p2, k3) shows them; colours are sampled times alpha, so edges do not darken."""

    def bend(d: dict) -> dict:
        a = _get(d, "f").astype(float)
        v, u = _lens_map(*a.shape[:2], intrinsics, lens)
        s = _bilinear(np.concatenate([a[..., :3] * a[..., 3:] / 255, a[..., 3:]], axis=2), v, u)
        alpha = s[..., 3:]
        return _layer(d, np.clip(np.rint(np.concatenate([np.divide(s[..., :3] * 255, alpha, out=np.zeros_like(s[..., :3]), where=alpha > 0.5), alpha], axis=2)), 0, 255))

    return per_frame(_side(rgba, "f"), bend, LAYER)


def depth_through_lens(depth: DataFrame, intrinsics: tuple[float, float, float, float], lens: tuple[float, float, float, float, float], least_valid: float = 0.5) -> DataFrame:
    """Ideal depth as the lens shows it: the mean of hits, where at least ``least_valid`` of the sample hits; elsewhere infinity."""

    def bend(d: dict) -> dict:
        z = np.asarray(d["depth_m"], dtype=float).reshape(int(d["h"]), int(d["w"]))
        hit = np.isfinite(z)
        v, u = _lens_map(*z.shape, intrinsics, lens)
        s = _bilinear(np.stack([np.where(hit, z, 0.0), hit.astype(float)], axis=2), v, u)
        out = np.where(s[..., 1] >= least_valid, s[..., 0] / np.maximum(s[..., 1], 1e-9), np.inf)
        return {"clip": d["clip"], "frame_idx": d["frame_idx"], "h": d["h"], "w": d["w"], "depth_m": out.ravel().tolist()}

    return per_frame(depth.select(*KEYS, "h", "w", "depth_m"), bend, "clip string, frame_idx long, h int, w int, depth_m array<float>")
