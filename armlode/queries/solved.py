"""Queries that SQL cannot express: kinematics, smoothing, image layers. Tested by definition instead."""

from __future__ import annotations

from pyspark.sql import functions as F

from armlode.operators import boxes as B
from armlode.operators import frames as FR
from armlode.operators import kinematics as K
from armlode.operators import pixels as PX
from armlode.operators.rasters import HEIGHT, WIDTH, rasters
from armlode.queries.sequence import ONE
from armlode.sources.tables import table


def _frames(spark, base):
    return FR.canonical(table(spark, base, "frames"))


def solve_chain(spark, base):
    s = K.solve_episodes(_frames(spark, base), smooth=True)
    return s.select("episode_id", "side", "frame_idx", "ik_success", *[F.round(c, 4).alias(c) for c in ("position_error_m", "orientation_error_rad")], F.round("jacobian_condition", 1).alias("jacobian_condition"))


def smooth_joints(spark, base):
    s = K.smooth_trajectories(_frames(spark, base)).filter("smooth is not null")
    return s.select("episode_id", "side", "frame_idx", F.transform("smooth", lambda x: F.round(x, 5)).alias("smooth"))


def side_clearance(spark, base):
    d = K.side_clearance(_frames(spark, base))
    return d.select("episode_id", "frame_idx", F.round(F.col("distance") + 1.1e-9, 6).alias("distance"), "collides")


def registration_choice(spark, base):
    """Keeps the feasible flag as recorded unless a limit on the errors alone leaves strictly more frames."""
    d = _frames(spark, base)
    return K.choose_registration(d, d.withColumn("feasible", F.col("position_error_m") <= 0.01), ["episode_id"])


def accepted_contacts(spark, base):
    d = _frames(spark, base).withColumn("ik_success", F.col("q").isNotNull())
    return K.accepted_rows(d, ["episode_id", "side"]).groupBy("episode_id", "side").agg(F.count("*").alias("rows"))


def mask_audit(spark, base):
    a = PX.audit_masks(rasters(_frames(spark, base), "mask"))
    return a.select("clip", "frames", "empty", F.round("area_jump_p95", 6).alias("area_jump_p95"), F.round("temporal_iou_p05", 6).alias("temporal_iou_p05"), "ok")


def mask_overlap(spark, base):
    """Refined masks against those they come from: everything is kept, so recall is 1."""
    m = rasters(_frames(spark, base), "mask")
    o = PX.overlaps(PX.refine_masks(m), m)
    return o.groupBy("clip").agg(F.count("*").alias("frames"), F.round(F.avg("iou"), 5).alias("iou"), F.round(F.min("recall"), 6).alias("least_recall"))


def clean_plates(spark, base):
    d = _frames(spark, base)
    p = PX.clean_plate(rasters(d, "video"), rasters(d, "mask"))
    return p.groupBy("clip").agg(F.count("*").alias("pixels"), F.count_if("reliable").alias("reliable"), F.round(F.avg("value"), 4).alias("level"))


def composite_change(spark, base):
    """How composites differ from the video within and outside the masks, over all pixels and as a mean of frames."""
    d = _frames(spark, base)
    v, m = rasters(d, "video"), rasters(d, "mask")
    c = PX.change_metrics(v, PX.per_frame(PX._side(PX.alpha_over(v, rasters(d, "rgba")), "o"), lambda r: PX._layer(r, PX._get(r, "o").mean(axis=2).round()), PX.LAYER), m)
    return c.groupBy("clip").agg(F.round(F.sum("outside_sum") / F.greatest(F.sum("outside_count"), F.lit(1)), 5).alias("outside"), F.round(F.sum("inside_sum") / F.greatest(F.sum("inside_count"), F.lit(1)), 5).alias("inside"), F.round(F.avg("copy_fraction"), 5).alias("copied"))


def plate_change(spark, base):
    """How far a video whose masked pixels are greyed changes from frame to frame against the video itself, over free pixels."""
    d = _frames(spark, base)
    v, m = rasters(d, "video"), rasters(d, "mask")
    grey = PX.per_frame(PX.joined(v=v, m=m), lambda r: PX._layer(r, _greyed(PX._get(r, "v"), PX._get(r, "m", 0))), PX.LAYER)
    return PX.temporal_change(v, grey, m).groupBy("clip").agg(F.count("*").alias("frames"), F.sum("count").alias("pixels"), F.round(F.sum("changed_sum") / F.greatest(F.sum("count"), F.lit(1)), 6).alias("change"))


def _greyed(v, m):
    out = v.copy()
    out[m] = 128
    return out


def render_checks(spark, base):
    """What renders show of the grippers, and the frames whose alpha harmonising them with the video changes."""
    d = _frames(spark, base)
    r = rasters(d, "rgba")
    return PX.render_report(r).join(PX.same_alpha(r, PX.harmonised(r, rasters(d, "video"))).select("clip", "different"), "clip").select("clip", "frames", "empty", F.round("visible_fraction", 6).alias("visible_fraction"), "ok", "different")


def light_levels(spark, base):
    """Levels of the render and of the video under the mask, over all frames."""
    d = _frames(spark, base)
    return PX.light_samples(rasters(d, "rgba"), rasters(d, "video"), stride=1, masks=rasters(d, "mask")).select("clip", "layer", F.transform("levels", lambda x: F.round(x, 3)).alias("levels"))


def detection_boxes(spark, base):
    """Boxes around each gripper as seen from above, scored by closeness; the best per half of the image."""
    d = _frames(spark, base).filter("position_error_m >= 0")
    cx, cy, r = (F.col("pose.y") + 0.6) / 1.2 * WIDTH, F.col("pose.x") / 0.8 * HEIGHT, 2.0 + 2.0 * (1 - F.coalesce("gripper", F.lit(0.0)))
    box = F.struct((cx - r).alias("xmin"), (cy - r).alias("ymin"), (cx + r).alias("xmax"), (cy + r).alias("ymax"))
    det = d.select("episode_id", "frame_idx", F.col("side").alias("place"), (-F.col("position_error_m")).alias("score"), box.alias("box"))
    b = B.robot_boxes(det, ["episode_id", "frame_idx"], WIDTH, HEIGHT)
    return b.select("episode_id", "frame_idx", "half", *[F.round(F.col(f"box.{k}") + 1.1e-9, 4).alias(k) for k in ("xmin", "ymin", "xmax", "ymax")])


QUERIES = {f.__name__: f for f in (solve_chain, smooth_joints, side_clearance, registration_choice, accepted_contacts, mask_audit, mask_overlap, clean_plates, composite_change, plate_change, render_checks, light_levels, detection_boxes)}

_R = "(2.0 + 2.0 * (1 - coalesce(gripper, 0.0)))"
_CX, _CY = f"((pose.y + 0.6) / 1.2 * {WIDTH})", f"(pose.x / 0.8 * {HEIGHT})"
SQL = {
    "side_clearance": f"WITH {ONE}, d AS (SELECT a.episode_id, a.frame_idx, sqrt((a.pose.x-b.pose.x)*(a.pose.x-b.pose.x) + (a.pose.y-b.pose.y)*(a.pose.y-b.pose.y) + (a.pose.z-b.pose.z)*(a.pose.z-b.pose.z)) AS distance FROM one a JOIN one b ON a.episode_id = b.episode_id AND a.frame_idx = b.frame_idx AND a.side = 0 AND b.side = 1) SELECT episode_id, frame_idx, round(distance + 1.1e-9, 6) AS distance, distance < 0.1 AS collides FROM d",
    "registration_choice": f"WITH {ONE}, c AS (SELECT episode_id, count(*) FILTER (feasible) AS shared, count(*) FILTER (position_error_m <= 0.01) AS alternative FROM one GROUP BY 1) SELECT *, CASE WHEN alternative > shared THEN 'alternative' ELSE 'shared' END AS chosen FROM c",
    "accepted_contacts": f"WITH {ONE}, c AS (SELECT episode_id, side, count(*) FILTER (feasible) AS f, count(*) FILTER (q IS NOT NULL) AS s, count(*) AS n FROM one GROUP BY 1, 2) SELECT episode_id, side, CASE WHEN f > 0 THEN f WHEN s > 0 THEN s ELSE n END AS rows FROM c",
    "detection_boxes": f"""WITH {ONE}, b AS (SELECT episode_id, frame_idx, side, -position_error_m AS score, {_CX} - {_R} AS x0, {_CY} - {_R} AS y0, {_CX} + {_R} AS x1, {_CY} + {_R} AS y1 FROM one WHERE position_error_m >= 0),
p AS (SELECT *, CASE WHEN (x0 + x1) / 2 < {WIDTH / 2} THEN 'left' ELSE 'right' END AS half FROM b WHERE (x1 - x0) * (y1 - y0) / ({WIDTH} * {HEIGHT}) BETWEEN 0.01 AND 0.35 QUALIFY row_number() OVER (PARTITION BY episode_id, frame_idx, half ORDER BY score DESC, side) = 1)
SELECT episode_id, frame_idx, half, round(greatest(x0 - (x1 - x0) * 0.05, 0.0) + 1.1e-9, 4) AS xmin, round(greatest(y0 - (y1 - y0) * 0.05, 0.0) + 1.1e-9, 4) AS ymin, round(least(x1 + (x1 - x0) * 0.05, {float(WIDTH)}) + 1.1e-9, 4) AS xmax, round(least(y1 + (y1 - y0) * 0.05, {float(HEIGHT)}) + 1.1e-9, 4) AS ymax FROM p""",
}
